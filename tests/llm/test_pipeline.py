"""The pipeline against plain versions of its stages' decisions, and the guard that lets it be left out."""

import os
import shutil
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from fieldtally.llm import credentials, decontaminate, packing, toxicity
from fieldtally.llm.shared import saved
from tests.llm.test_matching import plain_hits, plain_join
from tests.llm.test_models import toxic_world

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    import random

    draw = random.Random(12)
    path = str(tmp_path_factory.mktemp("corpus"))
    world = toxic_world(draw, 700)
    benchmark = [(i, " ".join(draw.choice(["river", "stone", "letter"]) + str(draw.randint(0, 50)) for _ in range(15))) for i in range(4)]
    rows = [(i, t) for i, t, _ in world]
    plain = [t for _, t, y in world if not y and len(t) > 200]
    rows += [(2000 + i, t + " tail") for i, t in enumerate(plain[:20])]  # near copies
    rows += [(3000 + i, "green house. " + b) for i, (_, b) in enumerate(benchmark)]
    rows += [(4000, "bread password=0123456789abcdef01 letter"), (4001, None), (4002, ""), (None, "no id"), (4003, "x"), (4003, "x")]
    spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows],
                          "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, 1, y) for i, _, y in world if i % 3], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(benchmark, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, rows, {i for i, _, y in world if y}, benchmark


def texts_of(frame):
    return [(r.doc_id, r.text) for r in frame.collect()]


def test_stages(spark, corpus):
    path, rows, toxic, benchmark = corpus
    docs = spark.read.parquet(f"{path}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, saved(stage(spark, docs, path), "stage")
        kept[name] = docs
        if stage is not corpus_pipeline.pack:
            assert docs.columns == before.columns
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "n-gram Jaccard join", "benchmark decontamination", "secret scans", "best-fit packing"]

    # toxicity: all that the model finds, and nothing of the clean documents
    clean = texts_of(kept[names[0]])
    gone = {i for i, _ in rows} - {i for i, _ in clean}
    assert gone <= toxic and len(gone) >= 0.97 * len(toxic) and len(clean) == len(rows) - len(gone)
    # near copies: the smallest id of each class
    classes = plain_join(clean, 5, 0.8)
    single = texts_of(kept[names[1]])
    assert sorted(i for i, _ in single if i is not None) == sorted({i for i, c, _, _ in classes if i == c})
    assert (None, "no id") in single and not any(i is not None and 2000 <= i < 2020 for i, _ in single)
    # contamination
    free = texts_of(kept[names[2]])
    assert sorted(free, key=str) == sorted((r for r in single if not (lambda h: h[1] and 20 * h[1] >= h[0])(plain_hits(r[1], benchmark, 13))), key=str)
    assert len(free) == len(single) - len(benchmark)
    # secrets: same documents, marks in place of what the patterns find
    marked = dict(texts_of(kept[names[3]]))
    for i, t in free:
        want = t
        for _, s, e, _ in reversed(credentials.base_spans(t or "")):
            want = want[:s] + "[SECRET]" + want[e:]
        assert marked[i] == want
    assert "[SECRET]" in marked[4000] and len(marked) == len(free)
    # packing: every token of every document once
    pieces = kept[names[4]].collect()
    assert {r.doc_id for r in pieces} == set(marked)
    assert sum(r.length for r in pieces) == packing.cut(kept[names[3]]).agg(F.sum("length")).first()[0]


def test_run_returns_the_last_stage(spark, corpus):
    got = corpus_pipeline.run(spark, corpus[0])
    assert got.columns == ["doc_id", "piece", "start", "length", "ids", "sequence_id", "offset", "fixed"]
    assert got.count() > 400
    assert corpus_pipeline.ORACLE_SQL is None


def test_stages_on_nothing(spark, corpus, docs):
    frame = docs().select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in corpus_pipeline.STAGES:
        frame = stage(spark, frame, corpus[0])
        assert frame.collect() == []
        if stage is not corpus_pipeline.pack:
            frame = docs().select("doc_id", "text", "lang", "source", "n_chars")


def test_learning_is_repeatable(spark, corpus):
    docs = spark.read.parquet(f"{corpus[0]}/documents.parquet")
    labels = spark.read.parquet(f"{corpus[0]}/labels.parquet")
    one, two = toxicity.learn(docs, labels), toxicity.learn(docs.repartition(7), labels)
    assert (one[0] == two[0]).all() and one[1] == pytest.approx(two[1]) and one[2] == pytest.approx(two[2])
    assert decontaminate.words_of("A-Z z9") == ["a", "z", "z9"]


def test_entry_point_without_this_part(tmp_path):
    """The registered queries of the rest remain when this folder and the pipeline are left out."""
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__", "spark-warehouse"))
    run = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; q = e.queries(); print(len(q), any('op' == k[:2] for k in q), set(e.oracle_sql()) <= set(q))"],
                         cwd=copy, capture_output=True, text=True, timeout=120, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})
    assert run.stdout.split()[1:] == ["False", "True"] and int(run.stdout.split()[0]) >= 88, run.stderr


def test_near_copies_keep_columns_of_any_name(spark):
    import corpus_pipeline
    rows = spark.createDataFrame(
        [(1, "a b c d e f g", "x", 7, "r"), (1, "a b c d e f g", "x", 7, "r"), (2, "other words are here and there", "y", 8, "s")],
        "doc_id long, text string, _text_hash string, id int, `row` string")
    kept = corpus_pipeline.drop_near_copies(spark, rows, "")
    assert kept.schema == rows.schema
    assert sorted(map(tuple, kept.collect())) == sorted({tuple(r) for r in rows.collect()})


def test_secrets_are_learnt_from_all_documents(spark, docs, monkeypatch):
    used = []
    plain = credentials.redact
    monkeypatch.setattr(credentials, "redact", lambda rows, formats: used.append(formats) or plain(rows, formats))
    rows = [(i, f"password={i * 7919:08d}ab text") for i in range(2_100)] + [(5_000, None), (None, "password=00000000ab")]
    kept = corpus_pipeline.redact_secrets(spark, docs(*rows), "").collect()
    assert used[0].automata["assign"].came[0] == 2_100
    assert sum(r.text == "[SECRET] text" for r in kept) == 2_100 and len(kept) == 2_102
