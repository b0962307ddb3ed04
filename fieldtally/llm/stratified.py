"""Ranked lexical search over a length-stratified index.

Terms are runs of ASCII letters and digits and of all characters beyond ASCII, A-Z lower-cased. A document of n
terms has the normaliser m = 100 - b + (b * n * N) div L with b = 50 (N documents with terms, L terms in all); a
term of weight w = floor(1000 * ln((2N + 2) / (2 df + 1))) that occurs tf times in it adds
w * ((10^9 * tf) div (1000 * tf + 20 * m)).

*Index*: texts are cut into terms once. Ranges of m that hold equally many postings make the shards; an m that very
many documents share fills several, over which its documents are dealt by a hash of their ids. In a shard each stratum, the documents of one m,
is written in rows of bounded size. Such a row holds the documents, the distinct terms, and postings in runs of one term and one tf, largest tf
first.

*Search*: items come in blocks of bounded size, as distinct terms only, and are broadcast; a scan of the
terms and run lengths counts their df. The second scan computes the impact of each tf that a stratum has once. The first run of a
term gives its largest impact there, so the item's terms give a bound for all documents of the stratum; an
item visits strata in descending order of their bounds, adds up impacts by document, and stops at the first stratum
whose bound is below its last score so far. A window merges the tasks' lists, whose size is bounded.

Defined cases: a null text has no terms, and a document without terms is not in the index; every row is a document,
also one that repeats an id, and a null id stays null and comes after equal scores with an id; rows that repeat an
item id are one item with the terms of all; a null item id is an item of its own; items without terms, or whose
terms occur nowhere, have no rows; empty tables give none.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldtally.llm.bytescan import gather, slices
from fieldtally.llm.shared import partitions, saved, ship
from fieldtally.llm.vectors import query_blocks

_TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
FORWARD = "doc_id bigint, n bigint, terms array<string>, tfs array<int>"
STRATA = ("m bigint, docs array<bigint>, terms array<string>, run_term array<int>, run_tf array<int>, "
          "run_length array<int>, members array<int>")
#: Postings in one row of a stratum; a document is never cut.
ROW_POSTINGS = 150_000
#: Shards a shuffle partition, on the mean, so that partitions hold about equally many postings.
SHARDS = 4
B = 50


def terms_of(text: str | None) -> list[str]:
    """The terms of one text, with repeats, in order."""
    return _TERM.findall((text or "").translate(_LOWER))


@dataclass
class Index:
    """Strata of all documents with terms, how many these are, and how many terms they have."""

    strata: DataFrame
    documents: int
    terms: int


def _lists(flat: pa.Array, lengths: list[int]) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32()), flat)


def forward(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """For every document with terms: doc_id, n, its distinct terms and how often each occurs."""
    ship(docs.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, _ in slices(batches):
            counted = [Counter(terms_of(t)) for t in batch.column("text").to_pylist()]
            some = np.flatnonzero([bool(c) for c in counted])
            counted = [counted[i] for i in some]
            sizes = [len(c) for c in counted]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(some)), pa.array([c.total() for c in counted], pa.int64()),
                 _lists(pa.array([t for c in counted for t in c], pa.string()), sizes),
                 _lists(pa.array([n for c in counted for n in c.values()], pa.int32()), sizes)],
                ["doc_id", "n", "terms", "tfs"])

    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return texts.where("text is not null").mapInArrow(cut, FORWARD)


def index(docs: DataFrame) -> Index:
    """The length-stratified index of all documents, written to the shared folder."""
    counted = saved(forward(docs), "lexical-forward")
    documents, terms = counted.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    m = F.expr(f"{100 - B} + ({B} * n * {documents}L) div {max(1, terms)}L")
    n = partitions(docs.sparkSession)
    counted = counted.withColumn("m", m)
    dealt = (counted.withColumn("shard", _shard(counted, SHARDS * n)).repartition(n, "shard")
             .sortWithinPartitions("m", "doc_id"))
    return Index(saved(dealt.mapInArrow(_strata, STRATA), "lexical-strata"), documents, terms)


def _shard(counted: DataFrame, n: int) -> Column:
    """Shards of equally many postings in order of m; only their limits reach the driver."""
    shares = F.lit([i / n for i in range(1, n)])
    limits = counted.agg(F.percentile("m", shares, F.size("terms")).alias("limits")).first()["limits"] or []
    limits = F.array(*[F.lit(float(x)) for x in limits])
    low = F.size(F.filter(limits, lambda x: x < F.col("m")))
    several = F.size(F.filter(limits, lambda x: x == F.col("m"))) + 1
    return low + F.pmod(F.xxhash64("doc_id", "terms"), several).cast("int")


def _portions(batches: Iterator[pa.RecordBatch], postings: int, column: str = "terms") -> Iterator[pa.RecordBatch]:
    """Batches cut where the lists of a column come to more than `postings`."""
    for batch in batches:
        ends = np.cumsum(np.diff(batch.column(column).offsets.to_numpy())) if batch.num_rows else []
        first, before = 0, 0
        while first < batch.num_rows:
            last = max(first + 1, int(np.searchsorted(ends, before + postings, side="right")))
            yield batch.slice(first, last - first)
            first, before = last, ends[last - 1]


def _strata(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents in order of m as rows of strata."""
    for batch in _portions(batches, 4 * ROW_POSTINGS):
        m, terms, tfs = batch.column("m").to_numpy(), batch.column("terms"), batch.column("tfs").flatten().to_numpy()
        lengths = np.diff(terms.offsets.to_numpy())
        encoded = terms.flatten().dictionary_encode()
        codes, names = encoded.indices.to_numpy(), encoded.dictionary
        ends = np.cumsum(lengths)
        begins = ends - lengths
        doc = np.repeat(np.arange(batch.num_rows), lengths)
        out = []
        first = 0
        while first < batch.num_rows:
            last = int(np.searchsorted(m, m[first], side="right"))
            last = max(first + 1, min(last, int(np.searchsorted(ends, begins[first] + ROW_POSTINGS, side="right"))))
            a, z = begins[first], ends[last - 1]
            order = np.lexsort((doc[a:z], -tfs[a:z], codes[a:z]))
            code, tf, member = codes[a:z][order], tfs[a:z][order], doc[a:z][order] - first
            new = np.flatnonzero(np.concatenate([[True], (code[1:] != code[:-1]) | (tf[1:] != tf[:-1])]))
            used, run_term = np.unique(code[new], return_inverse=True)
            out.append((m[first], batch.column("doc_id").slice(first, last - first), names.take(pa.array(used)),
                        run_term, tf[new], np.diff(np.append(new, len(code))), member))
            first = last
        columns = list(zip(*out))
        ints = [_lists(pa.array(np.concatenate(c), pa.int32()), [len(x) for x in c]) for c in columns[3:]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int64()), _lists(pa.concat_arrays(columns[1]), [len(x) for x in columns[1]]),
             _lists(pa.concat_arrays(columns[2]).cast(pa.string()), [len(x) for x in columns[2]]), *ints],
            ["m", "docs", "terms", "run_term", "run_tf", "run_length", "members"])


# ---------------------------------------------------------------- search

def items(table: DataFrame, id_column: str = "item_id", text_column: str = "text") -> DataFrame:
    """One row an item id: its distinct terms."""
    ship(table.sparkSession)
    kind = dict(table.select(F.col(id_column).alias("item_id")).dtypes)["item_id"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(set(terms_of(t))) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("item_id"), pa.array(found, pa.list_(pa.string()))],
                                             ["item_id", "terms"])

    rows = table.select(F.col(id_column).alias("item_id"), F.col(text_column).cast("string").alias("text"))
    cut_rows = rows.mapInArrow(cut, f"item_id {kind}, terms array<string>")
    single = cut_rows.select("item_id", F.explode("terms").alias("term")).dropDuplicates()
    return single.groupBy("item_id").agg(F.sort_array(F.collect_list("term")).alias("terms"))


def _frequencies(strata: DataFrame, vocabulary: pa.Array) -> np.ndarray:
    """In how many documents each term of the vocabulary occurs."""
    shared = strata.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(shared.value), np.int64)
        for batch in batches:
            spot = _places(batch.column("terms").flatten(), shared.value)
            begin = batch.column("terms").offsets.to_numpy()
            begin = begin - begin[0]
            runs = np.diff(batch.column("run_term").offsets.to_numpy())
            term = batch.column("run_term").flatten().to_numpy() + np.repeat(begin[:-1], runs)
            known = spot[term] >= 0
            np.add.at(total, spot[term[known]], batch.column("run_length").flatten().to_numpy()[known])
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"term": at, "n": total[at]})

    out = np.zeros(len(vocabulary), np.int64)
    counted = strata.select("terms", "run_term", "run_length").mapInArrow(count, "term bigint, n bigint")
    for r in counted.groupBy("term").agg(F.sum("n").alias("n")).collect():
        out[r["term"]] = r["n"]
    return out


def _places(terms: pa.Array, vocabulary: pa.Array) -> np.ndarray:
    """Where each term is in the vocabulary, -1 where it is not."""
    return pc.index_in(terms, value_set=vocabulary).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


class Block:
    """A bounded part of the items: terms as places in a vocabulary, and the weights of these."""

    def __init__(self, terms: list[np.ndarray], vocabulary: pa.Array, weights: np.ndarray):
        self.terms, self.vocabulary, self.weights = terms, vocabulary, weights
        # for every term the items that have it
        owner = np.repeat(np.arange(len(terms)), [len(t) for t in terms])
        flat = np.concatenate(terms) if terms else np.zeros(0, np.int64)
        order = np.argsort(flat, kind="stable")
        self.item = owner[order]
        self.begin = np.searchsorted(flat[order], np.arange(len(vocabulary) + 1))


class _Stratum:
    """What a row of a stratum holds of the vocabulary: by term, the documents and what the term adds to each."""

    def __init__(self, block: Block, m: int, docs: np.ndarray, place: np.ndarray, run_term: np.ndarray,
                 run_tf: np.ndarray, run_length: np.ndarray, members: np.ndarray):
        self.docs = docs
        place = place[run_term]
        run = np.flatnonzero(place >= 0)
        run = run[np.argsort(place[run], kind="stable")]  # largest tf first within a term, as before
        begin = np.cumsum(run_length) - run_length
        self.members = members[gather(begin[run], run_length[run])]
        tfs, which = np.unique(run_tf[run], return_inverse=True)
        impact = (1_000_000_000 * tfs.astype(np.int64)) // (1000 * tfs.astype(np.int64) + 20 * m)
        adds = impact[which] * block.weights[place[run]]
        self.adds = np.repeat(adds, run_length[run])
        self.terms, top = np.unique(place[run], return_index=True)
        starts = np.cumsum(run_length[run]) - run_length[run]
        self.begin = np.append(starts[top], len(self.members)).astype(np.int64)
        # the bound of every item: the largest that each of its terms adds here
        self.bound = np.zeros(len(block.terms), np.int64)
        n = block.begin[self.terms + 1] - block.begin[self.terms]
        np.add.at(self.bound, block.item[gather(block.begin[self.terms], n)], np.repeat(adds[top], n))

    def scores(self, terms: np.ndarray) -> np.ndarray:
        """Scores of all documents for an item's terms."""
        at = np.searchsorted(self.terms, terms)
        at = at[(at < len(self.terms)) & (self.terms[np.minimum(at, len(self.terms) - 1)] == terms)]
        entry = gather(self.begin[at], self.begin[at + 1] - self.begin[at])
        out = np.zeros(len(self.docs), np.int64)
        np.add.at(out, self.members[entry], self.adds[entry])
        return out


def _read(batch: pa.RecordBatch, block: Block) -> list[_Stratum]:
    place = _places(batch.column("terms").flatten(), block.vocabulary)

    def parts(name: str) -> list[np.ndarray]:
        lists = batch.column(name)
        flat = lists.flatten()
        flat = place if name == "terms" else flat.fill_null(_NO_ID).to_numpy() if flat.null_count else flat.to_numpy()
        return np.split(flat, np.cumsum(np.diff(lists.offsets.to_numpy()))[:-1])

    rows = zip(batch.column("m").to_pylist(), *(parts(n) for n in (
        "docs", "terms", "run_term", "run_tf", "run_length", "members")))
    return [_Stratum(block, *row) for row in rows]


#: Stands for a null id inside a task: it comes after all others of equal score.
_NO_ID = 2**63 - 1


def _ranked(batches: Iterator[pa.RecordBatch], block: Block, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Items, documents and scores of the best k documents of each item."""
    ids = [np.zeros(0, np.int64) for _ in block.terms]
    scores = [np.zeros(0, np.int64) for _ in block.terms]
    last = np.ones(len(block.terms), np.int64)  # only scores above 0 count
    for batch in _portions(batches, 4 * ROW_POSTINGS, "members"):
        strata = _read(batch, block)
        bounds = np.stack([s.bound for s in strata])
        order = np.argsort(-bounds, axis=0, kind="stable")
        for i, terms in enumerate(block.terms):
            for s in order[:, i]:
                if bounds[s, i] < last[i]:
                    break
                found = strata[s].scores(terms)
                at = np.flatnonzero(found >= last[i])
                if not len(at):
                    continue
                doc, score = np.concatenate([ids[i], strata[s].docs[at]]), np.concatenate([scores[i], found[at]])
                if len(doc) > k:
                    keep = np.lexsort((doc, -score))[:k]
                    doc, score = doc[keep], score[keep]
                    last[i] = max(1, score[-1])
                ids[i], scores[i] = doc, score
    return (np.repeat(np.arange(len(ids)), [len(x) for x in ids]), np.concatenate([*ids, np.zeros(0, np.int64)]),
            np.concatenate([*scores, np.zeros(0, np.int64)]))


def rank(found: Index, asked: DataFrame, k: int = 50, block_bytes: int = 16_000_000) -> DataFrame:
    """The k documents of highest score above 0 for each item (as `items` returns them): item_id, rank, doc_id, score."""
    spark = found.strata.sparkSession
    asked = saved(asked, "lexical-items")
    kind = dict(asked.dtypes)["item_id"]
    size = F.aggregate("terms", F.lit(1000).cast("long"), lambda n, t: n + F.octet_length(t) + 16)
    out = None
    for part in query_blocks(asked, size, ["item_id"], block_bytes):
        lists = part["terms"].combine_chunks()
        vocabulary = lists.flatten().unique()
        if not len(vocabulary) or not found.documents:
            continue
        df = _frequencies(found.strata, vocabulary)
        weights = np.array([weight(found.documents, int(n)) for n in df], np.int64)
        place = _places(lists.flatten(), vocabulary)
        at = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        block = Block([place[a:z] for a, z in zip(at[:-1], at[1:])], vocabulary, weights)
        shared = spark.sparkContext.broadcast(block)

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            item, doc, score = _ranked(batches, shared.value, k)
            yield pa.RecordBatch.from_arrays(
                [pa.array(item, pa.int64()), pa.array(doc, pa.int64(), mask=doc == _NO_ID), pa.array(score, pa.int64())],
                ["item", "doc_id", "score"])

        best = found.strata.mapInArrow(search, "item bigint, doc_id bigint, score bigint")
        by = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        best = best.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)
        names = spark.createDataFrame(pa.table({"item": np.arange(part.num_rows), "item_id": part["item_id"]}))
        best = saved(best.join(names, "item").select("item_id", "rank", "doc_id", "score"), "lexical-found")
        out = best if out is None else out.unionByName(best)
    if out is None:
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id bigint, score bigint")
    return out
