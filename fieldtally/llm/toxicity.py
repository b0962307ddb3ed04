"""Toxic documents and the sentences that make them so, learnt from document labels: multiple-instance learning.

A document is a bag of sentences (text between `.`, `!`, `?` or line ends). A sentence's chance to be toxic is a
logistic function of the four-byte pieces that occur in its lower-cased words, pieces that open a word apart from others. A
document's chance is the noisy-or of its sentences, 1 - prod(1 - p). Only documents are labelled; the likelihood
of their labels is followed down to the sentences' weights, so no sentence label is needed, and afterwards the
sentences with a high chance of their own are where the document offends.

The model is fitted on a bounded sample, the `sample` labelled documents with the smallest id hashes that may be
learnt from and have at most `longest` characters, in one task. Pieces must occur in `least` of its documents.
Scoring runs over all documents and whole texts.

Defined cases: null and empty texts have no sentence and score 0; several labels of one document count as toxic if
one is; null labels are not learnt from; without two kinds of labels every score is 0; repeated documents are
scored each for itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldtally.llm.bytescan import FOLDED, WORD, Hashed, release, runs, slices
from fieldtally.llm.shared import ship, texts

BITS, PIECE = 22, 4
_ENDS = np.zeros(256, bool)
_ENDS[[ord(c) for c in ".!?\n"]] = True
SCORED = "doc_id bigint, score double, sentences array<struct<first:bigint,last:bigint,score:double>>"
_SENTENCE = pa.struct([("first", pa.int64()), ("last", pa.int64()), ("score", pa.float64())])


class Bags:
    """Sentences of some texts with the features of each."""

    def __init__(self, data: np.ndarray, at: np.ndarray):
        start, end = runs(WORD[data], at)
        # a sentence begins at the first word after an ending mark or at the first word of a text
        marks = np.concatenate([[0], np.cumsum(_ENDS[data])])
        text = np.searchsorted(at, start, side="right") - 1
        new = np.ones(len(start), bool)
        new[1:] = (marks[start[1:]] != marks[end[:-1]]) | (text[1:] != text[:-1])
        opens = np.flatnonzero(new)
        self.text = text[opens]
        self.first = start[opens]
        self.last = end[np.append(opens[1:], len(start)) - 1] if len(opens) else end[:0]
        # features: every piece of a word, and the word's first piece once more under a hash of its own
        length = end - start
        n = np.maximum(length - PIECE, 0) + 1
        owner = np.repeat(np.arange(len(start)), n)
        begin = start[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
        stop = np.minimum(begin + PIECE, end[owner])
        h = Hashed(data, FOLDED).spans(begin, stop)
        opening = begin == start[owner]
        opening_h = h[opening] * np.uint64(0x9E3779B97F4A7C15)
        sentence = np.cumsum(new) - 1
        shift = np.uint64(64 - BITS)
        pairs = np.unique((np.concatenate([sentence[owner], sentence[owner[opening]]]) << BITS)
                          | np.concatenate([h >> shift, opening_h >> shift]).astype(np.int64))
        self.feature, self.sentence = (pairs & ((1 << BITS) - 1)).astype(np.int32), (pairs >> BITS).astype(np.int32)

    def logits(self, weights: np.ndarray, bias: float) -> np.ndarray:
        return bias + np.bincount(self.sentence, weights=weights[self.feature], minlength=len(self.text))

    def noisy_or(self, logits: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Chances of the sentences and of the `n` texts."""
        clear = -np.logaddexp(0, logits)  # log(1 - p)
        return np.exp(-np.logaddexp(0, -logits)), -np.expm1(np.bincount(self.text, weights=clear, minlength=n))


def fit(bags: list[tuple[Bags, np.ndarray]], least: int = 10, rounds: int = 30, rate: float = 1.0,
        sparse: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights and bias that make the labels likely: adaptive gradient steps over the batches in turn, each weight
    pulled towards zero by `sparse` of its step, so that few pieces keep one."""
    size = 1 << BITS
    met = np.zeros(size, np.int64)
    for bag, _ in bags:
        features, texts_with = np.unique(np.unique(bag.text[bag.sentence] * size + bag.feature) % size, return_counts=True)
        met[features] += texts_with
    used = np.flatnonzero(met >= least)
    place = np.full(size, -1, np.int32)
    place[used] = np.arange(len(used))
    labels = np.concatenate([y for _, y in bags]) if bags else np.zeros(0)
    if not len(labels) or labels.min() == labels.max():
        return np.zeros(size), -50.0
    weights, bias = np.zeros(len(used)), -5.0
    seen, seen_bias = np.full(len(used), 1e-3), 1e-3
    for bag, _ in bags:
        known = place[bag.feature] >= 0
        bag.feature, bag.sentence = place[bag.feature[known]], bag.sentence[known]
    for _ in range(rounds):
        for bag, y in bags:
            p, chance = bag.noisy_or(bag.logits(weights, bias), len(y))
            # d(-log likelihood) / d(logit): p for a clean document, -p (1 - P) / P for a toxic one
            whole = np.maximum(chance[bag.text], 1e-9)
            slope = np.where(y[bag.text] == 1, -p * (1 - whole) / whole, p)
            step = np.bincount(bag.feature, weights=slope[bag.sentence], minlength=len(weights)) / len(y)
            seen += step * step
            by = rate / np.sqrt(seen)
            weights -= by * step
            weights = np.sign(weights) * np.maximum(np.abs(weights) - by * sparse, 0)
            down = slope.sum() / len(y)
            seen_bias += down * down
            bias -= rate * down / np.sqrt(seen_bias)
    out = np.zeros(size)
    out[used] = weights
    return out, float(bias)


def learn(docs: DataFrame, labels: DataFrame, sample: int = 10_000, longest: int = 50_000, least: int = 10,
          batch: int = 250) -> tuple[np.ndarray, np.ndarray, float]:
    """The model: features with a weight, their weights, and the bias. Reads text and `toxic` only."""
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy(
        F.col("doc_id").cast("long").alias("id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    allowed = known.where(F.crc32(F.col("id").cast("string")) % 3 != 1)
    chosen = allowed.orderBy(F.xxhash64("id"), "id").limit(sample)  # so many rows of two numbers at most
    rows = (texts(docs).where(F.length("text") <= longest)
            .join(F.broadcast(chosen), F.col("doc_id") == F.col("id")).select("doc_id", "text", "toxic"))

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        came = list(batches)
        if not came:
            return
        got = pa.Table.from_batches(came).sort_by([("doc_id", "ascending"), ("text", "ascending")])
        # neighbouring ids may be alike: deal them over the batches
        order = np.random.default_rng(0).permutation(got.num_rows)
        bags = []
        for lo in range(0, got.num_rows, batch):
            part = got.take(pa.array(order[lo: lo + batch])).combine_chunks()
            for piece, data, at in slices(iter(part.to_batches()), limit=1 << 40):
                bags.append((Bags(data, at), piece.column(2).to_numpy()))
        weights, bias = fit(bags, least)
        kept = np.flatnonzero(weights)
        del came, got, bags
        release()
        yield pa.RecordBatch.from_pydict({"feature": [kept], "weight": [weights[kept]], "bias": [bias]})

    model = rows.repartition(1).mapInArrow(train, "feature array<bigint>, weight array<double>, bias double").first()
    if model is None:
        return np.zeros(0, np.int64), np.zeros(0), -50.0
    return np.array(model.feature, np.int64), np.array(model.weight), model.bias


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float], offending: float = 0.5) -> DataFrame:
    """For every document: doc_id, score, and the sentences (code points, end exclusive) at or above `offending`."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = np.zeros(1 << BITS)
        weights[model[0]] = model[1]
        for rows, data, at in slices(batches, limit=1_000_000):
            bags = Bags(data, at)
            p, chance = bags.noisy_or(bags.logits(weights, model[2]), rows.num_rows)
            places = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
            bad = np.flatnonzero(p >= offending)
            found: list[list[dict]] = [[] for _ in range(rows.num_rows)]
            for i in bad.tolist():
                t = int(bags.text[i])
                base = places[at[t]]
                found[t].append({"first": int(places[bags.first[i]] - base), "last": int(places[bags.last[i]] - base),
                                 "score": float(p[i])})
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array(chance + 0.0), pa.array(found, pa.list_(_SENTENCE))], ["doc_id", "score", "sentences"])

    return texts(docs).mapInArrow(scan, SCORED)


def keep(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float], least: float = 0.7) -> DataFrame:
    """The rows, all columns unchanged, of documents that score below `least`."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = np.zeros(1 << BITS)
        weights[model[0]] = model[1]
        for rows, data, at in slices(batches, limit=1_000_000):
            bags = Bags(data, at)
            _, chance = bags.noisy_or(bags.logits(weights, model[2]), rows.num_rows)
            yield rows.filter(pa.array(chance < least))

    ship(docs.sparkSession)
    return docs.mapInArrow(scan, docs.schema)


def judged(scored: DataFrame, least: float = 0.7) -> DataFrame:
    """The contract's columns, with the offending sentences."""
    return scored.select("doc_id", (F.crc32(F.col("doc_id").cast("string")) % 3 == 1).alias("held_out"), "score",
                         F.when(F.col("score") >= least, 1).otherwise(0).alias("predicted"), "sentences")
