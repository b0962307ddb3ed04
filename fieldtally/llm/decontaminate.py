"""Which words of documents lie inside passages of benchmark items: a prefix-filtered set join on word windows.

Words are runs of letters, digits and characters beyond ASCII, A-Z lower-cased. Every 13 consecutive words of an
item are a window (an item of fewer words, but not none, is one window). A window occurs in a document where all
its words follow one another, so its whole set of five-word shingles must be there. At a containment of one the
prefix that has to match is a single element of the set ordered by rarity: the join goes by each window's rarest
shingle, counted over all documents, and most documents meet no candidate at all. A candidate then passes

* the positional bound: the window, placed so that the shingle falls on the matching words, starts inside the
  document, and the length bound: it ends inside it;
* the exact check, word by word and finally on the text itself.

The benchmark is taken in blocks of a bounded number of words, each sent to all tasks; with more than one block
the documents are written with a row number first and the blocks' findings are united by it.

Defined cases: a null or empty text has no words; items without words have no windows; repeated items are one
item if their ids are equal; a null item id counts as the id ''; with an empty benchmark nothing is hit.
Repeated documents each get their own row.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldtally.llm.bytescan import FOLDED, Hashed, buffers, slices, windows, words
from fieldtally.llm.shared import saved, ship, texts

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
FOUND = "row bigint, n_words bigint, spans array<struct<first:bigint,last:bigint>>, items array<string>"
SPAN = pa.struct([("first", pa.int64()), ("last", pa.int64())])


def words_of(text: str | None) -> list[str]:
    """The words of one text, as the operator sees them."""
    return _WORD.findall((text or "").translate(_LOWER))


def _hashed_words(data: np.ndarray, at: np.ndarray):
    start, end, first = words(data, at)
    return start, end, first, Hashed(data, FOLDED).spans(start, end)


class Block:
    """The windows of a bounded part of the benchmark and the shingles that can find them."""

    def __init__(self, items: list[tuple[str, str]], window: int, shingle: int):
        found: dict[tuple[str, ...], set[str]] = {}
        for item, text in items:
            w = words_of(text)
            for i in range(max(1, len(w) - window + 1) if w else 0):
                found.setdefault(tuple(w[i: i + window]), set()).add(item)
        self.words = list(found)
        self.items = [sorted(found[w]) for w in self.words]
        self.size = np.array([len(w) for w in self.words], np.int64)
        self.begin = np.cumsum(self.size) - self.size
        column = pa.array([" ".join(w) for w in self.words], pa.string())
        data, at = buffers(column) if self.words else (np.zeros(0, np.uint8), np.zeros(1, np.int64))
        _, _, first, self.hashes = _hashed_words(data, at)
        # all shingles of all windows: which window, at which word of it
        self.shingles: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for size in sorted(set(np.minimum(self.size, shingle).tolist())):
            mine = np.minimum(self.size, shingle) == size
            h, at_word = windows(self.hashes, first, size)
            owner = np.searchsorted(first, at_word, side="right") - 1
            keep = mine[owner]
            self.shingles[size] = h[keep], owner[keep], (at_word - first[owner])[keep]

    def tokens(self) -> list[tuple[int, np.ndarray]]:
        return [(size, np.unique(h)) for size, (h, _, _) in self.shingles.items()]


def _matching(sorted_values: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indexes into `h` of the values that occur in `sorted_values`, and where."""
    if not len(sorted_values):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    spot = np.minimum(np.searchsorted(sorted_values, h), len(sorted_values) - 1)
    hit = np.flatnonzero(sorted_values[spot] == h)
    return hit, spot[hit]


def _frequencies(docs: DataFrame, tokens: list[tuple[int, np.ndarray]]) -> dict[int, np.ndarray]:
    """How often each shingle of the block occurs in all documents; at most one row a shingle reaches the driver."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [np.zeros(len(t), np.int64) for _, t in tokens]
        for _, data, at in slices(batches):
            _, _, first, h = _hashed_words(data, at)
            for i, (size, known) in enumerate(tokens):
                total[i] += np.bincount(_matching(known, windows(h, first, size)[0])[1], minlength=len(known))
        for i, (size, _) in enumerate(tokens):
            at_token = np.flatnonzero(total[i])
            yield pa.RecordBatch.from_pydict({"size": np.full(len(at_token), size), "token": at_token,
                                              "n": total[i][at_token]})

    out = {size: np.zeros(len(known), np.int64) for size, known in tokens}
    counted = docs.select("text").mapInArrow(count, "size bigint, token bigint, n bigint")
    for r in counted.groupBy("size", "token").agg(F.sum("n").alias("n")).collect():
        out[r["size"]][r["token"]] = r["n"]
    return out


def _probes(block: Block, frequency: dict[int, np.ndarray]) -> list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """For each shingle size: sorted rarest shingles, and the window and the place in it that each one probes.

    Windows whose rarest shingle occurs nowhere are left out: they occur nowhere.
    """
    out = []
    for size, known in block.tokens():
        h, owner, place = block.shingles[size]
        n = frequency[size][np.searchsorted(known, h)]
        order = np.lexsort((place, h, n, owner))
        rarest = order[np.unique(owner[order], return_index=True)[1]]
        rarest = rarest[n[rarest] > 0]
        rarest = rarest[np.argsort(h[rarest], kind="stable")]
        out.append((size, h[rarest], owner[rarest], place[rarest]))
    return out


def _hits(batches: Iterator[pa.RecordBatch], block: Block, probes: list) -> Iterator[tuple]:
    """Parts of the batches, each with its texts' numbers of words, hit word spans and found items (by row of the part)."""
    def same(raw: bytes, window: int) -> bool:
        return tuple(words_of(raw.decode())) == block.words[window]

    right: dict[tuple[int, bytes], bool] = {}
    for batch, data, at in slices(batches):
        start, end, first, h = _hashed_words(data, at)
        begins, which = [], []
        for size, keys, window, place in probes:
            sh, at_word = windows(h, first, size)
            lo, hi = np.searchsorted(keys, sh), np.searchsorted(keys, sh, side="right")
            met = np.flatnonzero(hi > lo)
            n = (hi - lo)[met]
            probe = np.repeat(lo[met], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            begins.append(np.repeat(at_word[met], n) - place[probe])
            which.append(window[probe])
        begin = np.concatenate(begins) if begins else np.zeros(0, np.int64)
        window = np.concatenate(which) if which else np.zeros(0, np.int64)
        # positional and length bounds, inside the document of the first word
        ok = (begin >= 0) & (begin + block.size[window] <= len(h))
        begin, window = begin[ok], window[ok]
        doc = np.searchsorted(first, begin, side="right") - 1
        ok = begin + block.size[window] <= first[doc + 1]
        begin, window, doc = begin[ok], window[ok], doc[ok]
        for i in range(int(block.size.max()) if len(begin) else 0):
            at_i = np.minimum(begin + i, len(h) - 1)
            mine = block.hashes[np.minimum(block.begin[window] + i, len(block.hashes) - 1)]
            ok = (i >= block.size[window]) | (h[at_i] == mine)
            begin, window, doc = begin[ok], window[ok], doc[ok]
        spans: dict[int, list[tuple[int, int]]] = {}
        items: dict[int, set[str]] = {}
        for b, w, d in sorted(set(zip(begin.tolist(), window.tolist(), doc.tolist()))):
            last = b + int(block.size[w])
            raw = data[start[b]: end[last - 1]].tobytes()
            if (w, raw) not in right:
                if len(right) > 100_000:
                    right.clear()
                right[w, raw] = same(raw, w)
            if right[w, raw]:
                mine = spans.setdefault(d, [])
                b, last = b - int(first[d]), last - int(first[d])
                if mine and b <= mine[-1][1]:
                    mine[-1] = (mine[-1][0], max(last, mine[-1][1]))
                else:
                    mine.append((b, last))
                items.setdefault(d, set()).update(block.items[w])
        yield batch, np.diff(first), spans, items


def _scan(docs: DataFrame, block: Block, probes: list) -> DataFrame:
    """For every row: its words, and the word spans and items of the windows found in it."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, n_words, spans, items in _hits(batches, block, probes):
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index("row")), pa.array(n_words, pa.int64()),
                 pa.array([[{"first": a, "last": z} for a, z in spans.get(i, ())] for i in range(n)], pa.list_(SPAN)),
                 pa.array([sorted(items.get(i, ())) for i in range(n)], pa.list_(pa.string()))],
                ["row", "n_words", "spans", "items"])

    return docs.select("row", "text").mapInArrow(find, FOUND)


def blocks(benchmark: DataFrame, block_words: int) -> Iterator[list[tuple[str, str]]]:
    """The benchmark's items in blocks that reach the driver one at a time, each of about `block_words` words.

    An item is one row and is never split.
    """
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
                             F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, -(-total // (5 * block_words)))
    for i in range(n):
        part = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == i) if n > 1 else items
        yield sorted({(r.item, r.text) for r in part.collect()})


def find(docs: DataFrame, benchmark: DataFrame, window: int = 13, shingle: int = 5,
         block_words: int = 1_000_000) -> DataFrame:
    """For every document: doc_id, n_words, spans (word ranges inside windows, end exclusive, disjoint, in order),
    items (ids, as sorted strings, of the items with windows that occur)."""
    docs = texts(docs)
    parts = None
    several = (benchmark.agg(F.sum(F.length("text"))).first()[0] or 0) > 5 * block_words
    if several:
        docs = saved(docs.withColumn("row", F.monotonically_increasing_id()), "documents")
    else:
        docs = docs.withColumn("row", F.col("doc_id"))
    for items in blocks(benchmark, block_words):
        block = Block(items, window, shingle)
        part = _scan(docs, block, _probes(block, _frequencies(docs, block.tokens())))
        parts = part if parts is None else parts.unionByName(part)
    if not several:
        return parts.withColumnRenamed("row", "doc_id")
    united = parts.groupBy("row").agg(
        F.max("n_words").alias("n_words"),
        _united(F.sort_array(F.flatten(F.collect_list("spans")))).alias("spans"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    return docs.select("row", "doc_id").join(united, "row").drop("row")


def clean(docs: DataFrame, benchmark: DataFrame, window: int = 13, shingle: int = 5, percent: int = 5,
          block_words: int = 1_000_000) -> DataFrame:
    """The rows, all columns unchanged, of documents that no block of the benchmark contaminates alone or together."""
    if (benchmark.agg(F.sum(F.length("text"))).first()[0] or 0) > 5 * block_words:
        numbered = saved(docs.select(F.struct("*").alias("doc"), F.monotonically_increasing_id().alias("row")), "documents")
        found = find(numbered.select(F.col("row").alias("doc_id"), "doc.text"), benchmark, window, shingle, block_words)
        bad = judged(found, percent).where("contaminated").select(F.col("doc_id").alias("row"))
        return numbered.join(bad, "row", "left_anti").select("doc.*")
    ship(docs.sparkSession)
    block = Block(next(blocks(benchmark, block_words)), window, shingle)
    probes = _probes(block, _frequencies(texts(docs), block.tokens()))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, n_words, spans, _ in _hits(batches, block, probes):
            hit = np.array([sum(z - a for a, z in spans.get(i, ())) for i in range(batch.num_rows)], np.int64)
            yield batch.filter(pa.array((hit == 0) | (100 * hit < percent * n_words)))

    return docs.mapInArrow(scan, docs.schema)


def _united(spans: Column) -> Column:
    """Sorted spans with those that touch or overlap made one."""
    kind = "array<struct<first:bigint,last:bigint>>"

    def add(done: Column, x: Column) -> Column:
        last = F.try_element_at(done, F.lit(-1))
        joined = F.struct(last["first"].alias("first"), F.greatest(last["last"], x["last"]).alias("last"))
        return F.when(last.isNotNull() & (x["first"] <= last["last"]),
                      F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(joined))
                      ).otherwise(F.concat(done, F.array(x)))
    return F.aggregate(spans, F.array().cast(kind), add)


def judged(found: DataFrame, percent: int = 5) -> DataFrame:
    """The contract's columns: how many words are hit, by which items, and whether that contaminates the document."""
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"])
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        ((hit > 0) & (hit * 100 >= F.col("n_words") * percent)).alias("contaminated"))
