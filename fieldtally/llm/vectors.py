"""What the vector searches share: vectors that take part, matrices of Arrow batches, queries in bounded blocks,
running lists of the best rows of every query."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_LONG = 2**63 - 1


def finite(column: str) -> Column:
    """Whether a vector is there and all its components are numbers."""
    x = F.col(column).cast("array<double>")
    return x.isNotNull() & ~F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))


def floored(column: str, scale: float) -> Column:
    """floor(scale * x) of every component, kept as doubles, which are whole numbers already beyond 2^53."""
    def one(v: Column) -> Column:
        scaled = v * F.lit(float(scale))
        return F.when(F.abs(scaled) < 2.0**53, F.floor(scaled).cast("double")).otherwise(scaled)
    return F.transform(F.col(column).cast("array<double>"), one)


def matrix(lists: pa.Array, width: int | None = None) -> np.ndarray:
    """A row a vector, short vectors filled with zeros, cut to `width` columns where that is given."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    lengths = np.diff(lists.offsets.to_numpy()) if len(lists) else np.zeros(0, np.int64)
    wide = int(lengths.max()) if len(lengths) else 0
    out = np.zeros((len(lists), wide))
    out[np.arange(wide)[None, :] < lengths[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    if width is None or width == wide:
        return out
    return out[:, :width] if wide > width else np.pad(out, ((0, 0), (0, width - wide)))


def vector_bytes(column: str) -> Column:
    """What a row with a vector takes, about."""
    return F.size(column).cast("long") * 8 + 64


def query_blocks(queries: DataFrame, bytes_of: Column, dealt_by: Sequence[str], block_bytes: int) -> Iterator[pa.Table]:
    """The rows of `queries` in blocks of about `block_bytes` bytes, which reach the driver one at a time.

    `bytes_of` says what a row takes; rows are dealt by a hash of `dealt_by`. Nothing is left out; an empty table
    has no block.
    """
    n, size = queries.agg(F.count(F.lit(1)), F.sum(bytes_of)).first()
    blocks = -(-(size or 0) // block_bytes)
    for i in range(blocks if n else 0):
        part = queries.where(F.pmod(F.xxhash64(*dealt_by), F.lit(blocks)) == i) if blocks > 1 else queries
        table = part.toArrow()
        if table.num_rows:
            yield table


class Best:
    """The best `k` (score, id) of each of `n` lists: highest score first, ties by the smaller id."""

    def __init__(self, n: int, k: int, kind=np.float64):
        self.n, self.k, self.kind = n, k, kind
        self.owner, self.ids, self.scores = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, kind)

    def add(self, owner: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        owner, ids = np.concatenate([self.owner, owner]), np.concatenate([self.ids, ids])
        scores = np.concatenate([self.scores, scores])
        if scores.dtype == object:
            order = np.array(sorted(range(len(ids)), key=lambda i: (owner[i], -scores[i], ids[i])), np.int64)
        else:
            order = np.lexsort((ids, -scores, owner))
        owner = owner[order]
        keep = np.arange(len(owner)) - np.searchsorted(owner, owner) < self.k
        self.owner, self.ids, self.scores = owner[keep], ids[order][keep], scores[order][keep]

    def last(self) -> np.ndarray:
        """The k-th score of every list, minus infinity where it holds fewer; never more than it is."""
        out = np.full(self.n, -np.inf)
        count = np.bincount(self.owner, minlength=self.n)
        ends = np.cumsum(count)
        full = count >= self.k
        last = self.scores[ends[full] - 1]
        out[full] = np.nextafter(last.astype(float), -np.inf) if last.dtype == object else last
        return out


def to_long(scores: np.ndarray) -> np.ndarray:
    """Whole numbers as longs, those beyond a long as the largest or smallest one."""
    if scores.dtype != object:
        return scores.astype(np.int64)
    return np.array([max(-_LONG - 1, min(_LONG, int(s))) for s in scores], np.int64)
