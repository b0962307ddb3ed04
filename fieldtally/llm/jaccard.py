"""Documents whose sets of word n-grams are alike: MinHash banding with exact checks.

Words are those of the decontamination operator; a document of fewer than n words, but not none, has one n-gram.

* Documents with equal n-gram sets form a class at once and are represented by the smallest id. Everything that
  follows sees representatives only, so exact copies cost one row each.
* A signature of band_count x band_rows minima is cut into bands. The two numbers are chosen so that a pair at the
  threshold shares a band with the probability `recall`, more similar pairs with a higher one.
* Band hashes are shuffled. Members of a bucket are tied to its smallest member, not to each other, and
  connected components of these ties hold every pair that shares a band.
* In a component all pairs are checked on the full n-gram sets. Members are dealt into chunks and a task takes
  two chunks, so a large component is many tasks. It holds, for one member at a time, the number of n-grams
  shared with each other member, added up from postings, and returns a count of links and one tie for each linked
  member, never the pairs.
* Components of the ties are the near-duplicate classes.

Defined cases: documents without words are similar to nothing, not even each other; null ids are left out, and
equal ids must be equal rows: repeated rows count as one document and are returned once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldtally.llm.bytescan import FOLDED, Hashed, slices, windows, words
from fieldtally.llm.components import components, forest
from fieldtally.llm.shared import saved, texts

SIGNED = "doc_id bigint, set_a bigint, set_b bigint, n_grams bigint, bands array<bigint>"
_SEED = 20260


def choose_bands(threshold: float, recall: float, most: int) -> tuple[int, int]:
    """How many bands of how many rows: the most selective choice within `most` hashes that reaches the recall."""
    best = (1, 1)
    for rows in range(1, 33):
        count = math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows)) if threshold < 1 else 1
        if rows * count <= most:
            best = (count, rows)
    return best


def grams_of(data: np.ndarray, at: np.ndarray, n: int) -> list[np.ndarray]:
    """The distinct n-grams of each text as sorted 64-bit hashes."""
    start, end, first = words(data, at)
    h, begin = windows(Hashed(data, FOLDED, safe=True).spans(start, end), first, n)
    edges = np.searchsorted(begin, first)
    return [np.unique(h[a:b]) for a, b in zip(edges[:-1], edges[1:])]


def _signature(grams: np.ndarray, by: np.ndarray, plus: np.ndarray) -> np.ndarray:
    """For each hash function the smallest value over all n-grams."""
    values = (grams >> np.uint64(32)).astype(np.uint32)
    best = np.full(len(by), 0xFFFFFFFF, np.uint32)
    for lo in range(0, len(values), 512):
        best = np.minimum(best, (values[lo: lo + 512, None] * by + plus).min(axis=0))
    return best


def _sum_hash(grams: np.ndarray, by: int) -> int:
    return int((grams * np.uint64(by) ^ (grams >> np.uint64(29))).sum(dtype=np.uint64).astype(np.int64))


def sign(docs: DataFrame, n: int, bands: int, rows: int) -> DataFrame:
    """For every document with words: two hashes of its n-gram set, the set's size, and its band hashes."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        draw = np.random.default_rng(_SEED)
        by = draw.integers(0, 2**31, bands * rows, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
        plus = draw.integers(0, 2**32, bands * rows, dtype=np.uint32)
        mixer = draw.integers(1, 2**63, rows, dtype=np.uint64) | np.uint64(1)
        number = np.arange(bands, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        for batch, data, at in slices(batches):
            sets = grams_of(data, at, n)
            keep = [i for i, g in enumerate(sets) if len(g)]
            out = []
            for i in keep:
                s = _signature(sets[i], by, plus).reshape(bands, rows).astype(np.uint64)
                h = ((s + np.uint64(1)) * mixer).sum(axis=1, dtype=np.uint64) + number
                h = (h ^ (h >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
                out.append((h ^ (h >> np.uint64(29))).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(keep, pa.int64())),
                 pa.array([_sum_hash(sets[i], 0xA24BAED4963EE407) for i in keep], pa.int64()),
                 pa.array([_sum_hash(sets[i], 0x9FB21C651E98DF25) for i in keep], pa.int64()),
                 pa.array([len(sets[i]) for i in keep], pa.int64()),
                 pa.ListArray.from_arrays(pa.array(np.arange(len(keep) + 1) * bands, pa.int32()),
                                          pa.array(np.concatenate(out) if out else np.zeros(0, np.int64)))],
                ["doc_id", "set_a", "set_b", "n_grams", "bands"])

    return docs.mapInArrow(scan, SIGNED)


def _linked(one: list[np.ndarray], other: list[np.ndarray] | None, threshold: float) -> Iterator[tuple[int, np.ndarray]]:
    """For each set of `one`, which sets of `other` (of `one` itself, other than it, if None) reach the threshold."""
    sets = one if other is None else other
    sizes = np.array([len(s) for s in sets])
    flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    for i, grams in enumerate(one):
        lo, hi = np.searchsorted(flat, grams), np.searchsorted(flat, grams, side="right")
        n = hi - lo
        # postings of rare n-grams are joined up; the sum goes over sets, not over pairs
        at = np.repeat(lo, n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        shared = np.bincount(owner[at], minlength=len(sets))
        alike = shared >= threshold * (len(grams) + sizes - shared) - 1e-9
        if other is None:
            alike[i] = False
        yield i, np.flatnonzero(alike)


def _check(members: DataFrame, docs: DataFrame, n: int, threshold: float, chunk: int) -> DataFrame:
    """`members` (component, doc_id, weight): for each member the weight of its links and ties (u, v) to linked ones.

    Texts join only the members, once these are dealt into pairs of chunks.
    """
    sizes = members.groupBy("component").agg(F.count("*").alias("size"))
    parts = F.ceil(F.col("size") / chunk).cast("int")
    dealt = (members.join(sizes.withColumn("parts", parts), "component")
             .withColumn("part", F.pmod(F.xxhash64("doc_id"), F.col("parts")).cast("int"))
             .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
             .withColumn("low", F.least("part", "with")).withColumn("high", F.greatest("part", "with"))
             .select("component", "low", "high", "part", "doc_id", "weight").join(docs, "doc_id"))

    def check(group: pa.Table) -> pa.Table:
        group = group.sort_by("doc_id")
        ids = group["doc_id"].combine_chunks().to_numpy()
        group = group.filter(pa.array(np.append(True, ids[1:] != ids[:-1])))  # a repeated row came along
        low, high = group["low"][0].as_py(), group["high"][0].as_py()
        part, ids, weight = (group[c].combine_chunks().to_numpy() for c in ("part", "doc_id", "weight"))
        sets: list[np.ndarray] = []
        for _, data, at in slices(iter(group.select(["text"]).to_batches())):
            sets += grams_of(data, at, n)
        a, b = np.flatnonzero(part == low), np.flatnonzero(part == high)
        links, u, v = np.zeros(len(ids), np.int64), [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for i, found in _linked([sets[k] for k in a], None if low == high else [sets[k] for k in b], threshold):
            found = (a if low == high else b)[found]
            links[a[i]] += weight[found].sum()
            if low != high:
                links[found] += weight[a[i]]
            # a tie to each linked member, kept as a spanning forest
            u.append(np.full(len(found), ids[a[i]]))
            v.append(ids[found])
            if sum(map(len, u)) > 200_000:
                x, y = forest(np.concatenate(u), np.concatenate(v))
                u, v = [x], [y]
        x, y = forest(np.concatenate(u), np.concatenate(v))
        linked = np.flatnonzero(links)
        return pa.table({"u": np.concatenate([ids[linked], x]), "v": np.concatenate([ids[linked], y]),
                         "links": np.concatenate([links[linked], np.zeros(len(x), np.int64)])})

    return dealt.groupBy("component", "low", "high").applyInArrow(check, "u bigint, v bigint, links bigint")


def join(docs: DataFrame, n: int = 5, threshold: float = 0.8, recall: float = 0.999, hashes: int = 320,
         chunk: int = 2_000) -> DataFrame:
    """For every document: doc_id, class_id (the smallest id of its near-duplicate class), representative (the smallest
    id with the same n-gram set), n_links (documents it is similar to, copies included)."""
    docs = texts(docs).where(F.col("doc_id").isNotNull())
    bands, rows = choose_bands(threshold, recall, hashes)
    # repeated rows go here, where a row is a few hundred bytes whatever its text
    signed = saved(sign(docs, n, bands, rows).dropDuplicates(["doc_id"]), "signed")
    classes = signed.groupBy("set_a", "set_b", "n_grams").agg(F.min("doc_id").alias("representative"), F.count("*").alias("weight"))
    member = saved(signed.select("doc_id", "set_a", "set_b", "n_grams").join(classes, ["set_a", "set_b", "n_grams"])
                   .select("doc_id", "representative", "weight"), "classes")
    heads = member.where("doc_id = representative").select("doc_id", "weight")
    banded = signed.select("doc_id", "bands").join(heads.select("doc_id"), "doc_id").select(
        "doc_id", F.explode("bands").alias("band"))
    buckets = banded.groupBy("band").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")).where("n > 1")
    ties = banded.join(buckets.select("band", "least"), "band").where("doc_id <> least").select(
        F.col("doc_id").alias("u"), F.col("least").alias("v"))
    near = components(ties)
    met = near.select(F.col("node").alias("doc_id"), "component").join(heads, "doc_id")
    checked = saved(_check(met, docs, n, threshold, chunk), "links")
    links = checked.where("u = v").groupBy(F.col("u").alias("representative")).agg(F.sum("links").alias("links"))
    groups = components(checked.where("u <> v").select("u", "v")).select(
        F.col("node").alias("representative"), F.col("component").alias("class_id"))
    return (docs.select("doc_id").distinct().join(member, "doc_id", "left").join(links, "representative", "left")
            .join(groups, "representative", "left")
            .select("doc_id", F.coalesce("class_id", "representative", "doc_id").alias("class_id"),
                    F.coalesce("representative", "doc_id").alias("representative"),
                    (F.coalesce("links", F.lit(0)) + F.coalesce(F.col("weight") - 1, F.lit(0))).alias("n_links")))
