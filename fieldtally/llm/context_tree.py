"""Code lengths of texts under a context tree learnt from a corpus: context-tree weighting over bytes.

A text is its UTF-8 bytes and one end mark. Each byte is eight binary decisions, and every decision has a binary
context tree of its own whose contexts are the last 0 .. depth bytes. A context's counts of zeros and ones give a
Krichevsky-Trofimov estimate Pe; weighting mixes all depths, Pw = (Pe + prod Pw of the longer contexts) / 2, Pe
alone at full depth. The probability of the next decision given the learnt counts follows the path of contexts
with the posterior weights Pe / (2 Pw): w * KT + (1 - w) * (the same of the next longer context).

A byte's probability depends on its context and the byte only, so on one string of depth + 1 bytes. Work is done
once per distinct string of the corpus, and nothing of the corpus is gathered in one place:

* tasks count the strings of their texts, and a shuffle adds the counts up;
* all contexts that share their last two bytes form a subtree. Subtrees are computed group by group and leave one
  sum for each of their decisions (at most 65,280 rows in all, which the driver puts together into the two
  shortest depths), then group by group all strings get their log-probability;
* documents are dealt into blocks of bounded size by a hash. A block asks for its distinct strings and words,
  a join on the shuffled tables answers, and the block adds up its texts.

The baseline is a unigram model over words (lower-cased A-Z, one end token a text) with 0.1 added to each count.

Defined cases: null and empty texts have the end mark only; null ids are learnt from (they have no remainder of
zero) and scored; without training texts every decision has probability 1/2; repeated rows count each time.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldtally.llm.bytescan import FOLDED, VISIBLE, Hashed, runs, slices
from fieldtally.llm.shared import partitions, saved, texts

END = 0xFF  # no UTF-8 text holds this byte; it ends a text and stands for what is before its start
DEPTH = 4
STRING, WORD = 0, 1
_END_WORD = np.uint64(0)
SCORED = ("doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
          "base_score double, score double, n_bytes bigint")


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Logarithm of the gamma function for positive numbers, by Stirling's series from x + 8 on."""
    shift = np.zeros_like(x)
    for i in range(8):
        shift += np.log(x + i)
    z = x + 8
    return (z - 0.5) * np.log(z) - z + 0.5 * math.log(2 * math.pi) + 1 / (12 * z) - 1 / (360 * z**3) + 1 / (1260 * z**5) - 1 / (1680 * z**7) - shift


def log_estimate(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Krichevsky-Trofimov: natural logarithm of the probability of any one order of so many zeros and ones."""
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1.0) - math.log(math.pi)


def strings_of(data: np.ndarray, at: np.ndarray, depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """For every byte and end mark the number whose digits (base 256) are its context and itself, and each text's first."""
    n = len(at) - 1
    # every text is followed by its end mark, and depth marks stand before each text
    marks = max(depth, 1)
    out = np.full(len(data) + marks * (n + 1), END, np.uint8)
    kept = np.zeros(len(out), bool)
    shift = marks * np.arange(1, n + 1)
    if n and len(data):
        body = np.ones(len(out), bool)
        body[:marks] = False
        ends = at[1:] + shift
        for i in range(marks):
            body[ends + i] = False
        out[body] = data
        kept = body
    kept[at[1:] + shift] = True
    # strings of 1, 2, 4 ... bytes that end at each place, put together until they hold the context
    total, size = out.astype(np.uint64), 1
    while size < depth + 1:
        more = min(size, depth + 1 - size)
        longer = total.copy()
        longer[size:] |= (total[:-size] & np.uint64((1 << 8 * more) - 1)) << np.uint64(8 * size)
        total, size = longer, size + more
    return total[kept], at + np.arange(n + 1)


def words_of(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, each text's followed by the end token's 0, and where each text's tokens begin."""
    start, end = runs(VISIBLE[data], at)
    first = np.searchsorted(start, at)
    begins = first + np.arange(len(at))
    out = np.full(len(start) + len(at) - 1, _END_WORD, np.uint64)
    body = np.ones(len(out), bool)
    body[begins[1:] - 1] = False
    h = Hashed(data, FOLDED, safe=True).spans(start, end)
    out[body] = np.where(h == _END_WORD, np.uint64(1), h)
    return out, begins


def _both(data: np.ndarray, at: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Keys and each text's first key, for strings and for words."""
    return [strings_of(data, at), words_of(data, at)]


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sums of their counts."""
    k, n = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(k, kind="stable")
    k, n = k[order], n[order]
    first = _firsts(k)
    return k[first], np.add.reduceat(n, first) if len(first) else n[:0]


def _firsts(keys: np.ndarray) -> np.ndarray:
    """Where in sorted keys each distinct one begins."""
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    return np.flatnonzero(new)


def _distinct_of(keys: np.ndarray) -> np.ndarray:
    """Distinct keys in order, by a plain sort."""
    keys = np.sort(keys)
    return keys[_firsts(keys)]


def _counted(keys: np.ndarray, learnt: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and how often each occurs where `learnt` is true."""
    known = np.sort(keys[learnt])
    first = _firsts(known)
    known, n = known[first], np.diff(first, append=len(known))
    if learnt.all():
        return known, n
    other = _distinct_of(keys[~learnt])
    return _summed([known, other], [n, np.zeros(len(other), np.int64)])


def count(docs: DataFrame, at_once: int = 1_500_000) -> DataFrame:
    """kind, key, n: how often each string and word occurs in training texts (0: in held-out ones only)."""
    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[tuple[np.ndarray, np.ndarray]]] = [[], []]

        def rows(kind: int) -> pa.RecordBatch:
            k, n = _summed([x[0] for x in held[kind]], [x[1] for x in held[kind]])
            held[kind] = []
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(k), kind), pa.int32()), pa.array(k.view(np.int64)),
                                               pa.array(n)], ["kind", "key", "n"])

        for batch, data, at in slices(batches):
            learnt = batch.column(batch.schema.get_field_index("learnt")).to_numpy(zero_copy_only=False)
            for kind, (keys, begins) in enumerate(_both(data, at)):
                held[kind].append(_counted(keys, np.repeat(learnt, np.diff(begins))))
                if sum(len(x[0]) for x in held[kind]) > at_once:
                    held[kind] = [_summed([x[0] for x in held[kind]], [x[1] for x in held[kind]])]
                    if len(held[kind][0][0]) > at_once // 2:
                        yield rows(kind)
        for kind in (STRING, WORD):
            if held[kind]:
                yield rows(kind)

    return (docs.select("text", "learnt").mapInArrow(counts, "kind int, key bigint, n bigint")
            .groupBy("kind", "key").agg(F.sum("n").alias("n")))


class Subtree:
    """The trees of all eight decisions for contexts that share their last two bytes, depths 2 to DEPTH.

    Nodes are keyed by context and decision: the context's bytes from the third last on, most recent byte highest,
    then the number of the decision (1 to 255, the bits of the byte so far after a leading one).
    """

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        byte = (keys & np.uint64(255)).astype(np.int64)
        context = np.zeros(len(keys), np.int64)  # bytes 3 .. DEPTH back, the nearest first
        for back in range(3, DEPTH + 1):
            context = context * 256 + ((keys >> np.uint64(8 * back)) & np.uint64(255)).astype(np.int64)
        self.rows = len(keys)
        bits = [(byte >> (7 - i)) & 1 for i in range(8)]
        nodes = [(256 + byte) >> (8 - i) for i in range(8)]
        self.bit = np.concatenate(bits) if self.rows else np.zeros(0, np.int64)
        leaf = np.concatenate([context * 256 + n for n in nodes]) if self.rows else np.zeros(0, np.int64)
        n = np.tile(counts, 8)
        # from full depth to depth 2: keys, counts of zeros and ones, log Pw, log Pe
        self.levels = []
        key, which = np.unique(leaf, return_inverse=True)
        zeros = np.bincount(which, weights=n * (self.bit == 0), minlength=len(key))
        ones = np.bincount(which, weights=n * (self.bit == 1), minlength=len(key))
        estimate = log_estimate(zeros, ones)
        self.levels.append((which, zeros, ones, estimate, estimate))
        for level in range(1, DEPTH - 1):
            up = (key // 256**2 if level < DEPTH - 1 else key * 0) * 256 + key % 256
            up_key, parent = np.unique(up, return_inverse=True)
            zeros = np.bincount(parent, weights=zeros, minlength=len(up_key))
            ones = np.bincount(parent, weights=ones, minlength=len(up_key))
            below = np.bincount(parent, weights=self.levels[-1][3], minlength=len(up_key))
            estimate = log_estimate(zeros, ones)
            weighted = np.logaddexp(estimate, below) - math.log(2)
            which = parent[which]
            self.levels.append((which, zeros, ones, weighted, estimate))
            key = up_key
        self.node = key % 256

    def top(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Decision, zeros, ones and log Pw of every node at depth 2."""
        _, zeros, ones, weighted, _ = self.levels[-1]
        return self.node, zeros, ones, weighted

    def chances(self) -> tuple[np.ndarray, np.ndarray]:
        """For each of the eight decisions of each string (all first decisions first) its decision number and the
        probability that contexts of two bytes and more give it."""
        chance = None
        for level, (which, zeros, ones, weighted, estimate) in enumerate(self.levels):
            mine = np.where(self.bit == 1, ones[which], zeros[which])
            kt = (mine + 0.5) / (zeros[which] + ones[which] + 1.0)
            if level == 0:
                chance = kt
            else:
                w = np.exp(estimate[which] - weighted[which] - math.log(2))
                chance = w * kt + (1 - w) * chance
        return self.node[self.levels[-1][0]], chance


class Trunk:
    """Depths 0 and 1, put together from the sums that subtrees leave: node arrays of 256 x 256 and 256."""

    def __init__(self, last: np.ndarray, node: np.ndarray, zeros: np.ndarray, ones: np.ndarray, below: np.ndarray):
        def filled(values: np.ndarray) -> np.ndarray:
            out = np.zeros((256, 256))
            out[last, node] = values
            return out

        self.zeros1, self.ones1 = filled(zeros), filled(ones)
        e1 = log_estimate(self.zeros1, self.ones1)
        p1 = np.logaddexp(e1, filled(below)) - math.log(2)
        self.w1 = np.exp(e1 - p1 - math.log(2))
        self.zeros0, self.ones0 = self.zeros1.sum(0), self.ones1.sum(0)
        e0 = log_estimate(self.zeros0, self.ones0)
        self.w0 = np.exp(e0 - (np.logaddexp(e0, p1.sum(0)) - math.log(2)) - math.log(2))

    def mixed(self, last: int, node: np.ndarray, bit: np.ndarray, chance: np.ndarray) -> np.ndarray:
        for zeros, ones, w in ((self.zeros1[last], self.ones1[last], self.w1[last]), (self.zeros0, self.ones0, self.w0)):
            kt = (np.where(bit == 1, ones[node], zeros[node]) + 0.5) / (zeros[node] + ones[node] + 1.0)
            chance = w[node] * kt + (1 - w[node]) * chance
        return chance


def string_scores(strings: DataFrame) -> DataFrame:
    """key, value: for every counted string the log10-probability of its last byte after the others."""
    grouped = strings.withColumn("last_two", F.shiftright("key", 8).bitwiseAND(F.lit(0xFFFF)))

    def arrays(group: pa.Table) -> tuple[np.ndarray, np.ndarray, int]:
        keys = group["key"].combine_chunks().to_numpy().view(np.uint64)
        order = np.argsort(keys)
        return keys[order], group["n"].combine_chunks().to_numpy()[order].astype(float), int(keys[0] >> np.uint64(8)) & 255

    def tops(group: pa.Table) -> pa.Table:
        keys, n, last = arrays(group)
        node, zeros, ones, weighted = Subtree(keys, n).top()
        return pa.table({"last": np.full(len(node), last), "node": node, "zeros": zeros, "ones": ones, "weighted": weighted})

    kinds = "last bigint, node bigint, zeros double, ones double, weighted double"
    left = (grouped.groupBy("last_two").applyInArrow(tops, kinds).groupBy("last", "node")
            .agg(*(F.sum(c).alias(c) for c in ("zeros", "ones", "weighted"))).toArrow())
    trunk = Trunk(*(left[c].to_numpy() for c in ("last", "node", "zeros", "ones", "weighted")))

    def values(group: pa.Table) -> pa.Table:
        keys, n, last = arrays(group)
        tree = Subtree(keys, n)
        node, chance = tree.chances()
        logs = np.log10(trunk.mixed(last, node, tree.bit, chance)).reshape(8, len(keys)).sum(0)
        return pa.table({"key": keys.view(np.int64), "value": logs})

    return grouped.groupBy("last_two").applyInArrow(values, "key bigint, value double")


def _distinct(group: pa.Table) -> list[np.ndarray]:
    """All distinct strings and all distinct words of a block's texts."""
    out: list[list[np.ndarray]] = [[], []]
    for _, data, at in slices(iter(group.select(["text"]).to_batches())):
        for kind, (keys, _) in enumerate(_both(data, at)):
            out[kind].append(_distinct_of(keys))
    return [_distinct_of(np.concatenate(x)) if x else np.zeros(0, np.uint64) for x in out]


def _held_out(folds: int) -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % folds == 0


def score(docs: DataFrame, folds: int = 10, block_chars: int = 32_000_000) -> DataFrame:
    """Learn from documents whose crc32(id) modulo `folds` is not 0 and score all, held out or not.

    doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score (log10-probabilities), n_bytes.
    """
    docs = texts(docs).withColumn("held_out", F.coalesce(_held_out(folds), F.lit(False)))
    counted = saved(count(docs.withColumn("learnt", ~F.col("held_out"))), "counts")
    known = counted.where((F.col("kind") == WORD) & (F.col("n") > 0)).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    total, kinds = known.n, known.v
    strings = string_scores(counted.where(F.col("kind") == STRING).select("key", "n"))
    words = counted.where(F.col("kind") == WORD).select("kind", "key", F.col("n").cast("double").alias("value"))
    table = strings.select(F.lit(STRING).alias("kind"), "key", "value").unionByName(words)

    size = docs.agg(F.sum(F.length("text") + 1)).first()[0] or 0
    blocks = max(1, -(-size // block_chars))
    dealt = docs.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int"))
    dealt = dealt.repartition(max(blocks, partitions(docs.sparkSession)), "block")

    def ask(group: pa.Table) -> pa.Table:
        block = group["block"][0]
        keys = _distinct(group)
        kind = np.repeat([STRING, WORD], [len(k) for k in keys])
        return pa.table({"block": pa.array(np.full(len(kind), block.as_py()), pa.int32()), "kind": pa.array(kind, pa.int32()),
                         "key": np.concatenate(keys).view(np.int64)})

    asked = dealt.groupBy("block").applyInArrow(ask, "block int, kind int, key bigint")
    answers = asked.join(table, ["kind", "key"]).select("block", "kind", "key", "value")

    def add_up(group: pa.Table, answered: pa.Table) -> pa.Table:
        known_keys, known_values = [], []
        kind = answered["kind"].combine_chunks().to_numpy()
        for k in (STRING, WORD):
            keys = answered["key"].combine_chunks().to_numpy()[kind == k].view(np.uint64)
            known_keys.append(pd.Index(keys))  # a hash table, built once a block
            known_values.append(answered["value"].combine_chunks().to_numpy()[kind == k])
        log_base = np.log10((known_values[WORD] + 0.1) / (total + 0.1 * (kinds + 1)))
        out = []
        for rows, data, at in slices(iter(group.select(["doc_id", "held_out", "text"]).to_batches())):
            (strings, s_begin), (words, w_begin) = _both(data, at)
            s = known_values[STRING][known_keys[STRING].get_indexer(strings)]
            spot = known_keys[WORD].get_indexer(words)
            out.append(pa.table({
                "doc_id": rows.column(0), "held_out": rows.column(1), "n_tokens": np.diff(w_begin),
                "n_known": np.add.reduceat((known_values[WORD][spot] > 0).astype(np.int64), w_begin[:-1]),
                "train_tokens": np.full(rows.num_rows, total, np.int64),
                "base_score": np.add.reduceat(log_base[spot], w_begin[:-1]),
                "score": np.add.reduceat(s, s_begin[:-1]), "n_bytes": np.diff(at)}))
        return pa.concat_tables(out) if out else pa.table({n: pa.array([], t) for n, t in _OUT})

    return dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(add_up, SCORED)


_OUT = [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
        ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64()), ("n_bytes", pa.int64())]
