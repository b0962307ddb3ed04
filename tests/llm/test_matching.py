"""op2, op7 and op10 against plain versions."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldtally.llm import bwt, bytescan, components, decontaminate, jaccard, repeats
from tests.llm.conftest import odd_texts

ITEMS = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType()),
                      T.StructField("row", T.StringType())])


def plain_hits(text, items, window):
    w = decontaminate.words_of(text)
    hit, found = set(), set()
    for item, t in items:
        iw = decontaminate.words_of(t)
        for k in range(max(1, len(iw) - window + 1) if iw else 0):
            part = iw[k: k + window]
            for i in range(len(w) - len(part) + 1):
                if w[i: i + len(part)] == part:
                    hit.update(range(i, i + len(part)))
                    found.add("" if item is None else str(item))
    return len(w), len(hit), sorted(found)


@pytest.mark.parametrize("block_words", [1_000_000, 20])
def test_decontamination(spark, docs, block_words):
    draw = random.Random(3)
    vocabulary = ["a", "B", "the", "é", "ñu", "x1", "und", "漢", "q-r"]

    def words(n):
        return " ".join(draw.choice(vocabulary) for _ in range(n))

    items = [(1, words(20)), (10, words(13)), (2, words(3)), (3, ""), (4, None), (None, words(14)), (5, "the"), (1, "B")]
    items += [(7, items[0][1])]
    rows = list(enumerate(odd_texts()))
    for i in range(60):
        text = words(draw.randint(0, 40))
        if i % 2:
            text += ". " + (draw.choice(items)[1] or "") + "; " + words(5)
        rows.append((100 + i, text.upper() if i % 3 == 0 else text))
    rows += [(None, items[0][1]), (100, rows[-60][1])]
    benchmark = spark.createDataFrame([(*x, "r") for x in items], ITEMS)
    got = decontaminate.judged(decontaminate.find(docs(*rows), benchmark, window=13, shingle=5, block_words=block_words)).collect()
    found = decontaminate.find(docs(*rows), benchmark, window=13, shingle=5, block_words=block_words).collect()
    assert len(got) == len(found) == len(rows)
    want = sorted((str(i), *plain_hits(t, items, 13)) for i, t in rows)
    assert sorted((str(r.doc_id), r.n_words, sum(s.last - s["first"] for s in r.spans), list(r["items"])) for r in found) == want
    for r in found:
        assert all(a.last < b["first"] or a.last <= b["first"] for a, b in zip(r.spans, r.spans[1:]))
    bad = sorted(str(i) for i, t in rows if (lambda h: h[1] > 0 and 20 * h[1] >= h[0])(plain_hits(t, items, 13)))
    assert sorted(str(r.doc_id) for r in got if r.contaminated) == bad
    clean = decontaminate.clean(docs(*rows), benchmark, block_words=block_words)
    assert sorted(str(r.doc_id) for r in clean.collect()) == sorted(set(str(i) for i, _ in rows).difference(bad)) + (
        ["100"] if "100" not in bad else [])  # document 100 is there twice
    assert clean.columns == docs().columns


def test_decontamination_of_nothing(spark, docs):
    none = spark.createDataFrame([], ITEMS)
    assert decontaminate.find(docs(), none).collect() == []
    (r,) = decontaminate.judged(decontaminate.find(docs((1, "a b")), none)).collect()
    assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (2, 0, 0, False)


def plain_repeats(rows, length):
    out = []
    for i, t in rows:
        b = (t or "").encode()
        seen = {x for j, u in rows if j is not None and (i is None or j < i)
                for v in [(u or "").encode()] for k in range(len(v) - length + 1) for x in [v[k: k + length]]}
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if b[k: k + length] in seen:
                gone[k: k + length] = b"\1" * length
        runs = sum(1 for k in range(len(b)) if gone[k] and (not k or not gone[k - 1]))
        out.append((str(i), len(b), sum(gone), runs, bytes(c for c, g in zip(b, gone) if not g)))
    return sorted(out)


@pytest.mark.parametrize("length,parts", [(50, 4), (20, 1)])
def test_repeats(docs, length, parts):
    draw = random.Random(4)
    vocabulary = ["alpha", "beta", "gämma", "delta\n", "漢字", "e"]

    def words(n):
        return " ".join(draw.choice(vocabulary) for _ in range(n))

    shared = [words(30) for _ in range(4)] + ["ab" * 100, "z" * 300]
    rows = [(i, t if t is None or len(t) < 6000 else t[:6000]) for i, t in enumerate(odd_texts())]
    for i in range(40):
        bits = [words(draw.randint(0, 20))]
        for _ in range(draw.randint(0, 3)):
            s = draw.choice(shared)
            cut = draw.randint(0, len(s) // 2)
            bits += [s[cut: cut + draw.randint(10, 150)], words(draw.randint(0, 6))]
        rows.append((draw.randint(0, 10**6), " ".join(bits)))
    rows += [(20, rows[-1][1]), (20, rows[-1][1]), (None, rows[-2][1]), (None, rows[-2][1]), (21, rows[9][1])]
    got = repeats.remove(docs(*rows, parts=parts), length=length, chunk_bytes=3_000, bucket_bytes=2_000, shard_bytes=500).collect()
    mine = sorted((str(r.doc_id), r.n_bytes, sum(s.last - s["first"] for s in r.spans), len(r.spans), bytes(r.kept)) for r in got)
    assert mine == plain_repeats(rows, length)


def test_repeats_of_one_line_that_goes_on_differently(docs, monkeypatch):
    draw = random.Random(9)
    rows = [(i, "".join(draw.choices("abcdefgh ", k=20)) + "A line that all of these texts share, word for word: "
             + "".join(draw.choices("abcdefgh ", k=40))) for i in range(400)]
    rows += [(1000 + i, "x" + rows[draw.randrange(400)][1][i % 7:]) for i in range(40)]
    groups, whole = [], repeats._repeated

    def spied(segments, length, buckets, shard_bytes):
        groups.extend(r.n for r in segments.groupBy("key").agg(F.sum(F.length("segment")).alias("n")).collect())
        return whole(segments, length, buckets, shard_bytes)

    monkeypatch.setattr(repeats, "_repeated", spied)
    got = repeats.remove(docs(*rows), chunk_bytes=8_000, bucket_bytes=5_000, shard_bytes=500).collect()
    mine = sorted((str(r.doc_id), r.n_bytes, sum(s.last - s["first"] for s in r.spans), len(r.spans), bytes(r.kept)) for r in got)
    assert mine == plain_repeats(rows, 50)
    assert groups and max(groups) <= 5_000


def test_repeats_merge_only_what_may_repeat(docs, monkeypatch):
    draw = random.Random(11)
    shared = ["A phrase of thirty bytes or so, ", "A passage that two texts have in common and both go on otherwise. "]
    rows = [(i, "".join(draw.choices("abcdefgh ", k=90)) + shared[i % 2] + "".join(draw.choices("abcdefgh ", k=90)))
            for i in range(12)]
    whole, most = repeats.least_by_repeat, len(shared[1]) + 8  # chance neighbours

    def strict(strings, values, length, shard_bytes):
        assert all(len(s) <= most for s in strings), "merges what cannot repeat"
        return whole(strings, values, length, shard_bytes)

    monkeypatch.setattr(repeats, "least_by_repeat", strict)
    for some in (rows[::2], rows):
        got = repeats.remove(docs(*some), bucket_bytes=10**9).collect()
        mine = sorted((str(r.doc_id), r.n_bytes, sum(s.last - s["first"] for s in r.spans), len(r.spans), bytes(r.kept)) for r in got)
        assert mine == plain_repeats(some, 50)
        assert any(r[2] for r in mine) == (some is rows)


def test_repeats_of_nothing(docs):
    assert repeats.remove(docs()).collect() == []


def test_merged_transforms_sort_suffixes():
    draw = random.Random(1)
    for _ in range(60):
        length = draw.choice([1, 2, 7, 8, 20])
        letters = draw.choice(["ab", "abc", "abcdefgh"])
        strings = ["".join(draw.choice(letters) for _ in range(draw.randint(0, 30))).encode() for _ in range(draw.randint(2, 9))]
        text = np.concatenate([np.frombuffer(s + b"\0", np.uint8) for s in strings])
        half = sum(len(s) + 1 for s in strings[: len(strings) // 2])
        shards = [bwt.build(text[:half], length), bwt.build(text[half:], length)]
        suffix, common = bwt.merge(shards, length)
        starts = np.concatenate([shards[0].order, shards[1].order + half])[suffix]

        def from_here(p):
            return bytes(text[p:]).split(b"\0")[0] + b"\0"

        heads = [from_here(p)[:length] for p in starts]
        assert sorted(starts) == list(range(len(text))) and heads == sorted(heads)
        for a, b, c in zip(heads, heads[1:], common[1:]):
            same = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y or x == 0), length)
            assert c == min(same, length)


def plain_join(rows, n, threshold):
    sets = {}
    for i, t in rows:
        w = decontaminate.words_of(t)
        if i is not None:
            sets[i] = {tuple(w[k: k + n]) for k in range(max(1, len(w) - n + 1))} if w else set()
    links = {i: [j for j in sets if j != i and sets[i] and sets[j] and len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j])]
             for i in sets}
    label = {i: i for i in sets}
    for _ in sets:
        label = {i: min([label[i]] + [label[j] for j in links[i]]) for i in sets}
    same = {i: min([j for j in sets if sets[j] == sets[i]] if sets[i] else [i]) for i in sets}
    return sorted((i, label[i], same[i], len(links[i])) for i in sets)


def test_jaccard_join(docs):
    draw = random.Random(8)

    def words(n):
        return [f"w{draw.randint(0, 400)}" for _ in range(n)]

    rows = list(enumerate(odd_texts()))
    key = 100
    for _ in range(8):
        base = words(draw.randint(3, 120))
        for _ in range(draw.randint(1, 25)):
            copy = list(base)
            for _ in range(draw.randint(0, 4)):
                copy[draw.randrange(len(copy))] = "new" + str(draw.randint(0, 9))
            rows.append((key, " ".join(copy)))
            key += 1
    rows += [(None, rows[-1][1]), (100, rows[len(odd_texts())][1])]
    got = jaccard.join(docs(*rows), chunk=7).collect()
    assert sorted((r.doc_id, r.class_id, r.representative, r.n_links) for r in got) == plain_join(rows, 5, 0.8)


def test_bands_reach_the_recall():
    bands, rows = jaccard.choose_bands(0.8, 0.999, 320)
    assert bands * rows <= 320 and 1 - (1 - 0.8**rows) ** bands >= 0.999 and rows > 4


def test_jaccard_of_nothing(docs):
    assert jaccard.join(docs()).collect() == []


def test_components(spark):
    draw = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 60)] + [(1000, 1000 + i) for i in range(1, 50)] + [(7, 7)]
    edges += [(draw.randint(2000, 2200), draw.randint(2000, 2200)) for _ in range(150)]
    frame = spark.createDataFrame(edges, "u bigint, v bigint").repartition(5)
    label = {x: x for e in edges for x in e}
    for _ in label:
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    got = {r.node: r.component for r in components.components(frame).collect()}
    assert got == {x: c for x, c in label.items() if any(x in e and e[0] != e[1] for e in edges)}


def test_words_and_windows():
    texts = [t or "" for t in odd_texts()]
    data, at = bytescan.buffers(pa.array(texts))
    start, end, first = bytescan.words(data, at)
    raw = data.tobytes()
    for i, t in enumerate(texts):
        got = [raw[a:b].decode().translate(decontaminate._LOWER) for a, b in zip(start[first[i]: first[i + 1]], end[first[i]: first[i + 1]])]
        assert got == decontaminate.words_of(t)
