"""op1 and op5 against the tokenizer itself."""

import zlib

import numpy as np
import pyarrow as pa
import pytest

from fieldtally.llm import bytescan, packing, token_store, tokens
from tests.llm.conftest import odd_texts


def reference(name, text, end):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokens.vocabulary(name)).encode(text or "", add_special_tokens=False).ids + [end]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_pieces_give_the_tokenizers_ids(name):
    texts = [t or "" for t in odd_texts()] + ["don't 'll we've x's 'S", "a,b;c (d) \"e\" f-g/h", "é, ñ. ü! ß? à b", " a 　b",
                                              "1 2, 33.4", "a <|endoftext|>b<|endoftext|> c", "end|>x <|end"]
    data, at = bytescan.buffers(pa.array(texts))
    coder = tokens.Encoder(name, 9, kept=50)
    for _ in range(2):  # a second time from memory
        ids, begins = coder.encode(data, at)
        for i, text in enumerate(texts):
            assert ids[begins[i]: begins[i + 1]].tolist() == reference(name, text, 9)


def test_store_round_trip(spark, docs, tmp_path):
    texts = odd_texts()
    rows = list(enumerate(texts)) + [(3, "again"), (None, "no id"), (3, "again")]
    path = str(tmp_path / "store")
    token_store.write(docs(*rows), path, shard_bytes=2_000)
    got = token_store.read(spark, path).collect()
    want = sorted(((i, t) for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0))
    assert sorted(x.doc_id is not None and x.doc_id for x in got) == sorted(i is not None and i for i, _ in rows)
    ordered = sorted(got, key=lambda x: x.start)
    assert [x.doc_id for x in ordered] == [i for i, _ in want]
    start = 0
    for x in ordered:
        ids = np.frombuffer(bytes(x.ids), "<u4").tolist()
        assert (x.start, x.n_tokens) == (start, len(ids))
        assert ids in [reference("byte_bpe_50k.json", t, 2) for i, t in rows if i == x.doc_id]
        start += len(ids)
    digest = {(r.doc_id, r.start): r.ids_crc32 for r in token_store.crc32_of(token_store.read(spark, path)).collect()}
    assert all(digest[x.doc_id, x.start] == zlib.crc32(bytes(x.ids)) for x in got)
    assert token_store.read_one(spark, path, 9) == reference("byte_bpe_50k.json", texts[9], 2)
    assert token_store.read_one(spark, path, 99) is None


def test_store_uses_its_dictionary(spark, docs, tmp_path):
    rows = [(i, f"the same words come again and again in text {i}, and again {i * 7}") for i in range(400)]
    with_, without = str(tmp_path / "with"), str(tmp_path / "without")
    token_store.write(docs(*rows), with_)
    token_store.write(docs(*rows), without, dictionary_sample=0)
    size = {p: spark.read.parquet(f"{p}/shards").selectExpr("sum(length(body))").first()[0] for p in (with_, without)}
    names = {p: spark.read.parquet(f"{p}/shards").select("dictionary").distinct().collect() for p in size}
    assert size[with_] < 0.8 * size[without]
    assert len(names[with_][0][0]) == 64 and names[without][0][0] == ""
    assert token_store.read(spark, with_).count() == 400


def test_empty_store(spark, docs, tmp_path):
    token_store.write(docs(), str(tmp_path / "none"))
    assert token_store.read(spark, str(tmp_path / "none")).collect() == []


def test_pieces_and_places(docs):
    rows = list(enumerate(odd_texts())) + [(None, "no id"), (6, "same text here, twice over")]
    capacity = 64
    got = packing.pack(docs(*rows), capacity=capacity).collect()
    by_doc = {}
    for r in got:
        by_doc.setdefault((r.doc_id,), []).append(r)
    for i, text in rows:
        ids = reference("word_bpe_49k.json", text, 1)
        mine = sorted((r.piece, r.start, r.length, bytes(r.ids)) for r in by_doc[(i,)])
        times = sum(1 for x in rows if x[0] == i)
        want = sorted((p // capacity, p, len(ids[p: p + capacity]), np.array(ids[p: p + capacity], "<u4").tobytes())
                      for p in range(0, len(ids), capacity)) * times
        assert mine == sorted(want)
    check_gapless(got, capacity)
    whole = {r.sequence_id: r.n_tokens for r in packing.sequences(packing.pack(docs(*rows), capacity=capacity)).collect()}
    assert sum(whole.values()) == sum(r.length for r in got)


def check_gapless(rows, capacity):
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return bins


def test_packing_of_nothing(docs):
    assert packing.pack(docs()).collect() == []


def fewest(lengths, capacity):
    """The least number of bins, by trying all placements."""
    lengths = sorted(lengths, reverse=True)
    best = [len(lengths)]

    def place(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(lengths):
            best[0] = len(bins)
            return
        for left in sorted(set(bins)):
            if left >= lengths[i]:
                rest = list(bins)
                rest.remove(left)
                place(i + 1, [*rest, left - lengths[i]])
        place(i + 1, [*bins, capacity - lengths[i]])

    place(0, [])
    return best[0]


def test_fixed_sets_lose_no_bin():
    """What the reduction fixes, plus the best packing of what it leaves, is a best packing of all."""
    draw = np.random.default_rng(5)
    fixed_any = 0
    for _ in range(250):
        capacity = int(draw.integers(6, 24))
        lengths = draw.integers(1 + int(draw.integers(0, capacity // 2)), capacity + 1, int(draw.integers(1, 10))).tolist()
        count = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
        groups = packing._reduce(count, capacity)
        left = [x for x in range(capacity + 1) for _ in range(count[x])]
        used = sum(g.bins for g in groups)
        fixed_any += used
        assert used + fewest(left, capacity) == fewest(lengths, capacity), (capacity, lengths)
        assert sum(g.bins * sum(a * b for a, b in g.content) for g in groups) + sum(left) == sum(lengths)
    assert fixed_any > 300


def test_plan_holds_all_pieces():
    draw = np.random.default_rng(6)
    for _ in range(50):
        capacity = int(draw.integers(4, 200))
        lengths = draw.integers(1, capacity + 1, int(draw.integers(1, 400)))
        histogram = {int(k): int(n) for k, n in zip(*np.unique(lengths, return_counts=True))}
        groups = packing.plan(histogram, capacity)
        held = {}
        for g in groups:
            assert sum(a * b for a, b in g.content) <= capacity
            for length, times in g.content:
                held[length] = held.get(length, 0) + times * g.bins
        assert held == histogram
        assert sum(g.bins for g in groups) <= 11 / 9 * -(-int(lengths.sum()) // capacity) + capacity  # no waste of whole bins
