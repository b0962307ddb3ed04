"""Learned partitions, hard negatives and ranked lexical search against brute force."""

import math
import os
import random
import subprocess
import sys
from collections import Counter

import numpy as np
import pytest

from conftest import rows
from fieldtally.llm import hard_negatives, learned_partitions, stratified
from fieldtally.llm.shared import clear, saved, session_dir
from fieldtally.llm.vectors import matrix
from tests.llm.conftest import odd_texts

VECTORS = "vec_id long, embedding array<double>, label long, score string, part string, n long, list string"


def vectors(spark, *rows_, parts=3):
    return spark.createDataFrame([(i, v, label, "s", "p", 1, "l") for i, v, label in rows_], VECTORS).repartition(parts)


ODD = [(None, [1.0, 2.0], 1), (901, None, 1), (902, [1.0, None], 1), (903, [float("nan"), 1.0], 1),
       (904, [float("inf"), 1.0], 1), (905, [], 1), (906, [0.0] * 8, 1), (907, [0.3], 2), (908, [0.1] * 12, 2),
       (909, [0.2] * 8, None), (910, [1e300] * 8, 3)]


def clustered(seed, n, d=8, centres=6):
    rng = random.Random(seed)
    centre = [[rng.gauss(0, 1) for _ in range(d)] for _ in range(centres)]
    return [(i, [c + rng.gauss(0, 0.35) for c in centre[i % centres]], rng.randrange(4)) for i in range(n)]


# ---------------------------------------------------------------- hard negatives

def plain_negatives(data, every=5, scale=256, positives=5, negatives=3):
    seen = {}
    for i, v, label in data:
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x * scale) for x in v):
            continue
        seen[i, tuple(math.floor(scale * x) for x in v), str(label)] = True
    out = []
    for a, av, al in seen:
        if a % every:
            continue
        scored = [(sum(x * y for x, y in zip(av, v)), i, label) for i, v, label in seen if i != a]
        scored.sort(key=lambda r: (-r[0], r[1]))
        for ps, p, _ in [r for r in scored if r[2] == al][:positives]:
            fits = [r for r in scored if r[2] != al and 50 * ps <= 100 * r[0] <= 95 * ps][:negatives]
            out += [(a, p, rank + 1, i, ps, s) for rank, (s, i, _) in enumerate(fits)]
    return sorted(out, key=repr)


def mined(spark, data, every=5, **options):
    whole = hard_negatives.whole(vectors(spark, *data))
    return rows(hard_negatives.mine(whole, whole.where(f"vec_id % {every} = 0"), **options))


def test_negatives_equal_brute_force_on_odd_rows_copies_and_several_blocks(spark):
    data = clustered(3, 240)
    data += [(1000 + i, [0.5, 0.25, -0.125, 0.5, 0.0, 0.0, 0.0, 0.0], i % 2) for i in range(60)]  # one vector, many copies
    data += ODD[:-1] + data[:7]  # repeated rows
    want = plain_negatives(data)
    assert len(want) > 300
    assert mined(spark, data) == want
    assert mined(spark, data, block_bytes=2_000) == want


def test_negatives_of_large_components_are_exact(spark):
    data = [(i, [v * 2.0**20 for v in vector], label) for i, vector, label in clustered(5, 40)]
    assert mined(spark, data) == plain_negatives(data)


def test_negatives_by_passes_with_thresholds_lowered_in_many_batches(spark):
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "17")
    try:
        data = clustered(11, 300, d=24)
        assert mined(spark, data) == plain_negatives(data)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_index_leaves_out_rows_and_groups_that_cannot_reach_the_threshold():
    rng = np.random.default_rng(0)
    weights = np.floor(rng.normal(0, 40, (200, 32)) * (0.8 ** np.arange(32)))
    weights[::2] *= 0.05
    groups = hard_negatives._groups(weights)
    block = hard_negatives._Rows(np.arange(200), np.zeros(200, int), weights, groups)
    anchor = weights[1:2]
    rest = hard_negatives._rest_norms(anchor, groups)
    edge = np.array([0.5 * rest[0, 0] * block.rest[:, 0].max()])
    index = hard_negatives._Index(block, rest, edge)
    assert len(index.order) <= 100 and index.postings[0] > index.postings[-1]
    found = [r for _, r, _ in hard_negatives._reaching(block, anchor, rest, edge, np.zeros(1, int), True)]
    assert sorted(np.concatenate(found)) == np.flatnonzero(weights @ anchor[0] >= edge[0]).tolist()


def test_negatives_of_empty_tables(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(0, [1.0], 1)]) == []


# ---------------------------------------------------------------- learned partitions

def inner(a, b):
    total = 0.0
    for x, y in zip(a, b):  # in order, as the operator adds; sum() rounds otherwise
        total += x * y
    return total


def exact_nearest(data, every, k):
    usable = {(i, tuple(v)) for i, v, _ in data if i is not None and v and all(x is not None and math.isfinite(x) for x in v)
              and any(v)}
    out = set()
    for i, v in usable:
        if i % every == 0:
            best = sorted((-inner(v, w), j) for j, w in usable if j != i)[:k]
            out |= {(i, rank + 1, j, -s) for rank, (s, j) in enumerate(best)}
    return out


def nearest(spark, data, every=5, k=10, **options):
    usable = learned_partitions.usable(vectors(spark, *data))
    block_bytes = options.pop("block_bytes", 32_000_000)
    model, index = learned_partitions.learn(learned_partitions.candidates(usable, k), k, **options)
    found = learned_partitions.search(model, index, usable.where(f"vec_id % {every} = 0"), k, block_bytes)
    return model, index, found


def test_partitions_reach_the_recall_and_score_exactly(spark):
    data = clustered(2, 900, d=12, centres=16)
    model, index, found = nearest(spark, data, sample=512, parts=8)
    assert model.parts == 8 and 1 <= model.probes < 8
    assert index.count() == 900 and index.select("part").distinct().count() > 4
    got = {tuple(r) for r in found.collect()}
    want = exact_nearest(data, 5, 10)
    assert len(got) == len(want)
    assert len({(q, i) for q, _, i, _ in got} & {(q, i) for q, _, i, _ in want}) >= 0.9 * len(want)
    scores = {i: v for i, v, _ in data}
    assert all(s == inner(scores[q], scores[i]) for q, _, i, s in got)
    frame = spark.createDataFrame([(q, i) for q, _, i, _ in want], "query_id long, vec_id long")
    assert learned_partitions.measured_recall(found, frame) >= 0.9


def test_partitions_of_odd_rows_and_copies(spark):
    data = clustered(4, 120) + [(1000 + i, [0.5] * 8, 1) for i in range(70)] + ODD[:-1] + clustered(4, 5)
    for options in ({"parts": 1}, {"block_bytes": 1_000, "parts": 2, "target": 1.0}):
        model, _, found = nearest(spark, data, **options)
        got, want = {tuple(r) for r in found.collect()}, exact_nearest(data, 5, 10)
        if model.probes == model.parts:
            assert got == want
        else:
            assert len({r[:3] for r in got} & {r[:3] for r in want}) > 0.8 * len(want)


def test_partitions_of_empty_tables(spark):
    for data in ([], [(5, None, 1)], [(5, [1.0], 1)]):
        assert nearest(spark, data)[2].collect() == []


def test_parts_are_balanced_and_cut_few_edges():
    rng = np.random.default_rng(1)
    centres = rng.normal(0, 3, (8, 16))
    x = centres[rng.integers(0, 8, 640)] + rng.normal(0, 0.3, (640, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    edges = learned_partitions.neighbours(x, 10)
    part = learned_partitions.balanced_parts(x, edges, 4)
    assert np.bincount(part).max() <= np.ceil(1.1 * 160)
    cut = (part[:, None] != part[edges]).mean()
    assert cut < 0.35


def test_width_of_matrices(spark):
    import pyarrow as pa
    lists = pa.array([[1.0, 2.0], [], [3.0]])
    assert matrix(lists).tolist() == [[1, 2], [0, 0], [3, 0]]
    assert matrix(lists, 1).tolist() == [[1], [0], [3]] and matrix(lists, 3).shape == (3, 3)
    assert matrix(lists.slice(1)).tolist() == [[0], [3]]


# ---------------------------------------------------------------- lexical search

def plain_ranking(docs, items, k):
    docs = [(i, Counter(stratified.terms_of(t))) for i, t in docs]
    docs = [(i, c) for i, c in docs if c]
    n_docs, n_terms = len(docs), sum(c.total() for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    asked = {}
    for i, text in items:
        asked.setdefault(i, set()).update(stratified.terms_of(text))
    out = []
    for item, terms in asked.items():
        scored = []
        for i, c in docs:
            m = 50 + (50 * c.total() * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m))
                        for t in terms if c[t])
            if score > 0:
                scored.append((-score, i is None, i))
        scored.sort(key=lambda r: (r[0], r[1], r[2] or 0))
        out += [(item, rank + 1, i, -s) for rank, (s, _, i) in enumerate(scored[:k])]
    return sorted(out, key=repr)


def lexical(rng):
    vocabulary = [f"w{i}" for i in range(400)] + ["Éa", "İx", "42", "can't", "漢字"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    docs = [(i, " ".join(rng.choices(vocabulary, weights, k=rng.choice([3, 3, 20, 21, 80])))) for i in range(250)]
    docs += list(enumerate(odd_texts(), 1000)) + [(None, "w1 w2 w399"), (7, "w1 W2, w399"), (7, "w1 W2, w399")]
    items = [(f"item{i}", " ".join(rng.choices(vocabulary, k=rng.choice([1, 5, 30])))) for i in range(40)]
    return docs, items + [(None, "w3 w5"), ("none", None), ("empty", " ."), ("missing", "zzz"), ("item0", "w8 w9")]


def ranked(spark, docs, data, items, k, **options):
    table = spark.createDataFrame([(i, t, 1, 1) for i, t in items], "item_id string, text string, n long, score long")
    return rows(stratified.rank(stratified.index(docs(*data)), stratified.items(table), k, **options),
                "item_id", "rank", "doc_id", "score")


def test_ranking_equals_brute_force(spark, docs, monkeypatch):
    data, items = lexical(random.Random(9))
    want = plain_ranking(data, items, 20)
    assert len(want) > 500
    assert ranked(spark, docs, data, items, 20) == want
    assert ranked(spark, docs, data, items, 20, block_bytes=9_000) == want


def test_strata_keep_all_postings_in_rows_of_bounded_size(spark, docs, monkeypatch):
    data, _ = lexical(random.Random(4))
    forward = [r for r in stratified.forward(docs(*data)).collect()]
    assert sorted((str(r.doc_id), sorted(zip(r.terms, r.tfs))) for r in forward) == sorted(
        (str(i), sorted(Counter(stratified.terms_of(t)).items())) for i, t in data if stratified.terms_of(t))
    import pyarrow as pa
    m = {r.n: 50 + r.n for r in forward}
    ordered = sorted(forward, key=lambda r: (m[r.n], r.doc_id or 0))
    batch = pa.RecordBatch.from_pydict({
        "doc_id": pa.array([r.doc_id for r in ordered], pa.int64()), "m": [m[r.n] for r in ordered],
        "terms": [r.terms for r in ordered], "tfs": pa.array([r.tfs for r in ordered], pa.list_(pa.int32()))})
    monkeypatch.setattr(stratified, "ROW_POSTINGS", 100)
    got = Counter()
    for part in stratified._strata(iter([batch.slice(0, 40), batch.slice(40)])):
        for r in part.to_pylist():
            assert len(r["members"]) <= 100 or len(r["docs"]) == 1
            at, seen = 0, []
            for t, tf, n in zip(r["run_term"], r["run_tf"], r["run_length"]):
                seen.append((t, -tf))
                for d in r["members"][at: at + n]:
                    got[r["docs"][d], r["m"], r["terms"][t], tf] += 1
                at += n
            assert seen == sorted(seen)
    assert got == Counter((r.doc_id, m[r.n], t, tf) for r in ordered for t, tf in zip(r.terms, r.tfs))


def test_ranking_of_empty_tables(spark, docs):
    assert ranked(spark, docs, [], [("a", "b")], 5) == []
    assert ranked(spark, docs, [(1, None), (2, "")], [("a", "b")], 5) == []
    assert ranked(spark, docs, [(1, "b")], [], 5) == []


# ---------------------------------------------------------------- the shared folder

def test_operators_need_no_configured_folder_on_one_machine(tmp_path):
    (tmp_path / "spark-defaults.conf").write_text("")
    code = ("from fieldtally.session import local_session; from fieldtally.llm.shared import saved, session_dir, clear\n"
            "s = local_session(1); d = saved(s.range(3), 'x'); assert d.count() == 3; print('kept', session_dir(s)); clear(s)\n"
            "import os; assert not os.path.exists(session_dir(s).removeprefix('file:'))")
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    done = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=300,
                          env={**os.environ, "SPARK_CONF_DIR": str(tmp_path)})
    assert "kept file:" in done.stdout, done.stderr[-2000:]


def test_a_cluster_without_a_shared_folder_is_an_error(spark, monkeypatch):
    from fieldtally.llm import shared

    class Context:
        master = "spark://host:7077"
        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = type("Conf", (), {"get": staticmethod(lambda key, default=None: default)})()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared.shared_dir(Session())
    assert session_dir(spark).split("/")[-1].startswith("fieldtally-")
    assert saved(spark.range(2), "two").count() == 2
    assert clear is not None
