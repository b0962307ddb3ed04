"""Exact top-k by inner product of sparse integer vectors, term at a time.

A vector is the list of its non-zero components (terms with weights). Candidates are dealt into blocks by a hash
of their id, queries too, and a task meets one block of each: every query block is compared with all rows, so a
task's memory is bounded by the two block sizes and work spreads over all pairs of blocks.

In a task the candidates' components are turned into postings by term. Dense score arrays hold a score for every
candidate and query of the blocks. Term by term, the posting's weights times the queries' weights of that term
are scattered onto them; when a term's posting holds most candidates it is added as one dense column. Each
query's best k are then selected by partition, not by a sort, and the blocks' winners are merged by a window.

Scores are integers, added in 32 or 64 bits as the largest possible score needs, and in exact integers of any
size beyond that, then cut to the range of a long. Ties go to the smaller id, ties of id to any equal row.

Defined cases: vectors that are null or hold a null, NaN or infinite component, and rows with a null id, take no
part; vectors of different lengths are compared over their common terms; an empty vector scores 0; repeated ids
are distinct candidates, except that a query never meets rows of its own id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldtally.llm.shared import ship

BEST = "query_id bigint, vec_id bigint, score bigint"
_LONG = 2**63 - 1
#: Candidates whose scores are held at once; with 64 queries they stay in a core's cache.
_ROWS, _COLUMNS = 4096, 64


def whole(vectors: DataFrame, scale: int = 64, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """Ids and components floor(scale * x) of the vectors that take part."""
    x = F.col(column).cast("array<double>")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return (vectors.where(F.col(id_column).isNotNull() & x.isNotNull() & ~bad)
            .select(F.col(id_column).cast("long").alias("vec_id"),
                    F.transform(x, lambda v: F.floor(v * scale).cast("double")).alias("weights")))


def _matrix(batch: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Ids, and weights with a row a vector, short vectors filled with zeros."""
    ids, lists = batch["vec_id"].combine_chunks().to_numpy(), batch["weights"].combine_chunks()
    lengths = np.diff(lists.offsets.to_numpy()) if len(lists) else np.zeros(0, np.int64)
    wide = int(lengths.max()) if len(lengths) else 0
    out = np.zeros((len(ids), wide))
    out[np.arange(wide)[None, :] < lengths[:, None]] = lists.flatten().to_numpy()
    return ids, out


def _kind(queries: np.ndarray, rows: np.ndarray):
    """The narrowest integers that hold every possible score."""
    terms = min(queries.shape[1], rows.shape[1])
    most = float(terms) * np.abs(queries).max(initial=0) * np.abs(rows).max(initial=0)
    return np.int32 if most < 2**31 else np.int64 if most < 2**62 else object


def _integers(weights: np.ndarray, kind) -> np.ndarray:
    if kind is object:
        return np.array([int(w) for w in weights.ravel()], object).reshape(weights.shape)
    return weights.astype(kind)


def _scores(postings: list[tuple[np.ndarray, np.ndarray]], columns: list[np.ndarray | None], weights: np.ndarray,
            n: int, kind) -> np.ndarray:
    """Scores of `n` candidates (rows) for some queries (columns), one term after the other."""
    scores = np.zeros((n, weights.shape[0]), kind)
    added = np.empty_like(scores)
    for term, (rows, values) in enumerate(postings):
        if not len(rows):
            continue
        if columns[term] is not None:
            np.multiply(columns[term][:, None], weights[None, :, term], out=added)
            scores += added
        else:
            used = np.flatnonzero(weights[:, term])
            scores[np.ix_(rows, used)] += values[:, None] * weights[None, used, term]
    return scores


def _best(scores: np.ndarray, ids: np.ndarray, own: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each query (a row of scores) the candidates among which its best k are, ties at the edge included."""
    for q in range(len(scores)):
        mine = np.flatnonzero(ids != own[q])
        s = scores[q, mine]
        if len(s) > k:
            edge = np.partition(s, len(s) - k)[len(s) - k]
            keep = np.flatnonzero(s >= edge)
            mine, s = mine[keep], s[keep]
            order = np.lexsort((ids[mine], -s))[:k]
            mine = mine[order]
        yield q, mine


def search(vectors: DataFrame, queries: DataFrame, k: int = 20, query_block: int = 1024, row_block: int = 16_384) -> DataFrame:
    """The k best rows of `vectors` for each of `queries`, both as `whole` returns them: query_id, rank, vec_id, score.

    Block sizes are means: ids are dealt by hash.
    """
    ship(vectors.sparkSession)
    n_rows, n_queries = (-(-max(1, f.count()) // size) for f, size in ((vectors, row_block), (queries, query_block)))

    def dealt(frame: DataFrame, name: str, n: int, other: str, m: int) -> DataFrame:
        return (frame.withColumn(name, F.pmod(F.xxhash64("vec_id", "weights"), F.lit(n)).cast("int"))
                .withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(m - 1)))))

    rows = dealt(vectors, "row_block", n_rows, "query_block", n_queries)
    asked = dealt(queries, "query_block", n_queries, "row_block", n_rows)

    def best(mine: pa.Table, theirs: pa.Table) -> pa.Table:
        own, q = _matrix(mine)
        ids, w = _matrix(theirs)
        kind = _kind(q, w)
        q, w = _integers(q, kind), _integers(w, kind)
        terms = min(q.shape[1], w.shape[1])
        out = [(np.zeros(0, np.int64),) * 3]
        for lo in range(0, len(ids), _ROWS):
            part = w[lo: lo + _ROWS, :terms]
            postings, columns = [], []
            for term in range(terms):
                at = np.flatnonzero(part[:, term])
                postings.append((at, part[at, term]))
                columns.append(np.ascontiguousarray(part[:, term]) if 2 * len(at) > len(part) else None)
            for first in range(0, len(own), _COLUMNS):
                scores = np.ascontiguousarray(
                    _scores(postings, columns, q[first: first + _COLUMNS, :terms], len(part), kind).T)
                for i, at in _best(scores, ids[lo: lo + _ROWS], own[first: first + _COLUMNS], k):
                    found = scores[i, at]
                    if kind is object:
                        found = np.array([max(-_LONG - 1, min(_LONG, int(s))) for s in found], np.int64)
                    out.append((np.full(len(at), own[first + i]), ids[lo + at], found.astype(np.int64)))
        query, row, score = (np.concatenate([o[i] for o in out]) for i in range(3))
        order = np.lexsort((row, -score, query))
        query, row, score = query[order], row[order], score[order]
        top = np.arange(len(query)) - np.searchsorted(query, query) < k
        return pa.table({"query_id": query[top], "vec_id": row[top], "score": score[top]})

    found = (asked.groupBy("query_block", "row_block").cogroup(rows.groupBy("query_block", "row_block"))
             .applyInArrow(best, BEST))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
