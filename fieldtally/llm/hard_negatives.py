"""Hard negatives by an L2AP-style threshold join of integer vectors.

For every anchor its nearest rows of the same label (positives) are found, then, for each positive, the nearest
rows of other labels whose score lies in a window below the positive's. Both are threshold joins: all rows are
wanted whose inner product with the anchor reaches a threshold, and thresholds are lowered until the lists fill.

The rows are written once, spread evenly, and never shuffled after. Anchors come in blocks of a bounded number of
bytes; each block is broadcast and meets all rows. In a task every SLICE rows are turned into an inverted index. Dimensions are put in order of their energy and taken in groups. A row is indexed under its first groups
only: the rest is left out as soon as the norm of its remaining components times that of any anchor's stays below
the threshold, so that a row found under no indexed group cannot reach it (rows whose whole norm is too small are
in no posting at all). Postings of a group are a leading part of the rows, which lie in order of how many groups
they are indexed under. Scores are accumulated group by group; a pair whose partial score plus the product of the
remaining norms stays below the threshold is dropped, and the survivors' remaining components are added exactly.

The first threshold is high. While a list does not hold enough rows the threshold is lowered and the index made
anew for it, down to the window's lower edge, or to none at all for positives; from the second index of a task on,
it is the last score of the list so far, so later rows are pruned by what earlier ones held. Lists of tasks are
merged by a window; what a task returns is bounded by the number of lists.

Equal rows of one label score alike, so of copies of a label and a vector only those with the smallest ids can
be in a list; the others are dropped before, exactly, by a limit that combines before the shuffle. One vector
that a third of all rows share therefore costs no more than any other.

Defined cases: rows with a null id or label, a null vector, a component that is null or not finite, or one beyond
the doubles once scaled, take no part; an empty vector scores 0; vectors of different lengths are compared over
their common components; rows that repeat id, label and vector count once, and a row of an anchor's own id is never
its partner; a positive with a score below 0 has an empty window. Scores are exact integers; those beyond
a long are given as the largest or smallest one. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldtally.llm.shared import partitions, saved, ship
from fieldtally.llm.vectors import Best, finite, floored, matrix, query_blocks, to_long, vector_bytes

MINED = ("anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, "
         "negative_score bigint")
#: Groups of dimensions, and how many of them are accumulated for all pairs of a row and an anchor in one product.
GROUPS, LEAD = 16, 14
#: Anchors whose partial scores with a batch of rows are held at once.
CHUNK = 64
#: Rows that are indexed together.
SLICE = 2048
#: First thresholds as shares of the largest score that a list still takes, then none.
STEPS = (0.9, 0.8, 0.65, 0.5, 0.35, 0.2)


def whole(vectors: DataFrame, scale: float = 256, id_column: str = "vec_id", label_column: str | Column = "label",
          column: str = "embedding") -> DataFrame:
    """Ids, labels and components floor(scale * x) of the rows that take part; repeated rows once."""
    label = F.col(label_column) if isinstance(label_column, str) else label_column
    rows = vectors.where(F.col(id_column).isNotNull() & label.isNotNull() & finite(column)).select(
        F.col(id_column).cast("long").alias("vec_id"), label.cast("string").alias("label"),
        floored(column, scale).alias("weights"))
    return rows.where(finite("weights")).dropDuplicates(["vec_id", "label", "weights"])


def _first_copies(rows: DataFrame, most: int) -> DataFrame:
    """Of the rows of one label and vector the `most` with the smallest ids."""
    by = Window.partitionBy("label", "weights").orderBy("vec_id")
    return rows.withColumn("copy", F.row_number().over(by)).where(F.col("copy") <= most).drop("copy")


class _Rows:
    """A batch of rows, dimensions in order of energy, with the norms of what remains after each group."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, weights: np.ndarray, groups: list[np.ndarray]):
        self.ids, self.labels, self.weights, self.groups = ids, labels, weights, groups
        self.rest = _rest_norms(weights, groups)


def _rest_norms(weights: np.ndarray, groups: list[np.ndarray]) -> np.ndarray:
    """A column a group and one more: the norm of the components from that group on, never less than it is."""
    squares = np.stack([np.square(weights[:, g]).sum(axis=1) for g in groups] + [np.zeros(len(weights))], axis=1)
    return np.sqrt(np.cumsum(squares[:, ::-1], axis=1)[:, ::-1]) * (1 + 1e-12)


def _groups(weights: np.ndarray) -> list[np.ndarray]:
    """Dimensions, most energy first, in at most GROUPS groups."""
    order = np.argsort(-np.square(weights).sum(axis=0), kind="stable")
    return [g for g in np.array_split(order, min(GROUPS, max(1, len(order))))]


class _Index:
    """Postings of the rows that can reach the thresholds: rows in order of how many groups they are indexed under."""

    def __init__(self, rows: _Rows, rest: np.ndarray, thresholds: np.ndarray):
        # a row needs no more groups once its remaining norm is below every threshold by any anchor's remaining norm
        with np.errstate(divide="ignore", invalid="ignore"):
            least = np.where(thresholds[:, None] > 0, thresholds[:, None] / rest, -np.inf).min(axis=0)
        free = rows.rest < least[None, :]
        depth = np.where(free.any(axis=1), free.argmax(axis=1), len(rows.groups))
        self.order = np.argsort(-depth, kind="stable")
        self.order = self.order[: int((depth > 0).sum())]
        self.depth = depth[self.order]
        self.postings = [int((self.depth > g).sum()) for g in range(len(rows.groups))]


def _reaching(rows: _Rows, anchors: np.ndarray, rest: np.ndarray, thresholds: np.ndarray, labels: np.ndarray,
              same: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Anchors (of the given ones), rows and scores of all pairs that reach the anchor's threshold, of equal labels
    or of different ones."""
    index = _Index(rows, rest, thresholds)
    if not len(index.order):
        return
    weights, lead = rows.weights[index.order], min(LEAD, len(rows.groups))
    row_rest, row_labels = rows.rest[index.order], rows.labels[index.order]
    at = np.minimum(index.depth, lead)
    open_rest = row_rest[np.arange(len(at)), at]
    segments = np.flatnonzero(np.diff(at, prepend=-1, append=-1))  # rows of equal depth
    for lo in range(0, len(anchors), CHUNK):
        mine, mine_rest, edge = anchors[lo: lo + CHUNK], rest[lo: lo + CHUNK], thresholds[lo: lo + CHUNK]
        partial = np.zeros((len(weights), len(mine)))
        for g in range(lead):
            n = index.postings[g]
            if n:
                partial[:n] += weights[:n, rows.groups[g]] @ mine[:, rows.groups[g]].T
        alive = np.zeros(partial.shape, bool)
        least = edge - _slack(edge)
        for x, y in zip(segments[:-1], segments[1:]):
            alive[x:y] = partial[x:y] + open_rest[x:y, None] * mine_rest[None, :, at[x]] >= least
        r, a = np.nonzero(alive)
        fits = (row_labels[r] == labels[lo + a]) == same
        r, a = r[fits], a[fits]
        score, depth = partial[r, a], at[r]
        for g in range(int(depth.min()) if len(depth) else 0, len(rows.groups)):
            due = depth <= g
            if not due.any():
                continue
            dims = rows.groups[g]
            score[due] += np.einsum("ij,ij->i", weights[r[due]][:, dims], mine[a[due]][:, dims])
            depth[due] = g + 1
            keep = score + row_rest[r, depth] * mine_rest[a, depth] >= least[a]
            r, a, score, depth = r[keep], a[keep], score[keep], depth[keep]
        keep = score >= edge[a]
        yield lo + a[keep], index.order[r[keep]], score[keep]


def _slack(edge: np.ndarray) -> np.ndarray:
    """What a bound may fall short of by rounding."""
    return np.where(np.isfinite(edge), np.abs(edge) * 1e-9 + 1, 0)


def _exact(anchors: np.ndarray, rows: np.ndarray) -> bool:
    """Whether all scores, and sums on the way to them, are whole numbers that doubles hold."""
    terms = min(anchors.shape[1], rows.shape[1])
    most = float(terms) * np.abs(anchors).max(initial=0) * np.abs(rows).max(initial=0)
    return most * 100 < 2.0**53


class _Lists:
    """What is searched for a block of anchors: lists with a lowest score, a highest score and room for `k` rows.

    There is one list an anchor (positives) or up to one a positive (negatives); `low` and `high`, longs, have a
    row an anchor and a column a list, and `there` says where there is one.
    """

    def __init__(self, anchors: pa.Table, k: int, same: bool, low: np.ndarray, high: np.ndarray, there: np.ndarray):
        self.ids = anchors["vec_id"].to_numpy()
        self.labels = np.array(anchors["label"].to_pylist(), object)
        self.weights = matrix(anchors["weights"])
        self.k, self.same, self.low, self.high, self.there = k, same, low, high, there

    def find(self, batches: Iterator[pa.RecordBatch]) -> Best:
        best = Best(self.low.size, self.k)
        slices = (batch.slice(lo, SLICE) for batch in batches for lo in range(0, batch.num_rows, SLICE))
        for batch in slices if len(self.ids) else ():
            table = pa.Table.from_batches([batch])
            ids, labels = table["vec_id"].to_numpy(), np.array(table["label"].to_pylist(), object)
            weights = matrix(table["weights"])
            names = {label: i for i, label in enumerate(dict.fromkeys([*labels.tolist(), *self.labels.tolist()]))}
            labels, own = (np.array([names[x] for x in some], np.int64) for some in (labels, self.labels))
            width = min(weights.shape[1], self.weights.shape[1])
            weights, mine = weights[:, :width], self.weights[:, :width]
            if _exact(mine, weights):
                self._batch(best, ids, labels, weights, mine, own)
            else:
                self._large(best, ids, labels, weights, mine, own)
        return best

    def _batch(self, best: Best, ids, labels, weights, mine, own) -> None:
        groups = _groups(weights)
        rows, rest = _Rows(ids, labels, weights, groups), _rest_norms(mine, groups)
        top = rest[:, 0] * rows.rest[:, 0].max(initial=0)
        open_, step = np.flatnonzero(self.there.any(axis=1)), 0
        shape = self.low.shape
        # the last score of full lists bounds what can still enter them
        need = np.where(self.there, np.maximum(self.low, best.last().reshape(shape)), np.inf)
        high = np.where(self.there, self.high, -np.inf).max(axis=1)
        before = np.full(len(mine), np.inf)
        while len(open_):
            first = STEPS[step] * np.minimum(top, high) if step < len(STEPS) else np.full(len(mine), -np.inf)
            edge = np.minimum(before, np.maximum(first, need.min(axis=1)))
            met = []
            for a, r, score in _reaching(rows, mine[open_], rest[open_], edge[open_], own[open_], self.same):
                a = open_[a]
                keep = (ids[r] != self.ids[a]) & (score < before[a])
                a, r, score = a[keep], r[keep], score[keep]
                for column in range(shape[1]):
                    fits = self.there[a, column] & (score >= self.low[a, column]) & (score <= self.high[a, column])
                    met.append((a[fits] * shape[1] + column, ids[r[fits]], score[fits]))
            if met:
                best.add(*map(np.concatenate, zip(*met)))
            before[open_] = edge[open_]
            last = best.last().reshape(shape)
            done = ~self.there | (last >= edge[:, None]) | (edge[:, None] <= self.low)
            open_, step = open_[~done.all(axis=1)[open_]], step + 1

    def _large(self, best: Best, ids, labels, weights, mine, own) -> None:
        """The same by exact integers of any size, for components that doubles cannot multiply exactly."""
        if best.scores.dtype != object:
            best.scores = np.array([int(s) for s in best.scores], object)
        theirs = [[int(v) for v in row] for row in weights]
        for a, row in enumerate([[int(v) for v in row] for row in mine]):
            r = np.flatnonzero(((labels == own[a]) == self.same) & (ids != self.ids[a]))
            score = np.array([sum(x * y for x, y in zip(row, theirs[i])) for i in r], object)
            for column in range(self.low.shape[1]):
                if not self.there[a, column]:
                    continue
                low, high = int(self.low[a, column]), int(self.high[a, column])
                fits = np.array([low <= s <= high for s in score], bool)
                best.add(np.full(int(fits.sum()), a * self.low.shape[1] + column), ids[r[fits]], score[fits])


def _search(spark: SparkSession, rows: DataFrame, lists: _Lists) -> DataFrame:
    """The best rows of every list: list, rank, vec_id, score."""
    shared = spark.sparkContext.broadcast(lists)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = shared.value.find(batches)
        yield pa.RecordBatch.from_pydict({"list": best.owner, "vec_id": best.ids, "score": to_long(best.scores)})

    found = rows.select("vec_id", "label", "weights").mapInArrow(find, "list bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("list").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= lists.k)
            .select("list", "rank", "vec_id", "score"))


def mine(rows: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
         block_bytes: int = 32_000_000) -> DataFrame:
    """Hard negatives of `anchors` among `rows`, both as `whole` returns them: anchor_id, positive_id, rank,
    negative_id, positive_score, negative_score.

    A negative's score is at least `low` and at most `high` percent of the positive's.
    """
    spark = rows.sparkSession
    ship(spark)
    copies = max(positives, negatives) + 1
    rows = saved(_first_copies(rows, copies).repartition(partitions(spark)), "negatives-rows")
    out = None
    for block in query_blocks(anchors, vector_bytes("weights"), ["vec_id", "label", "weights"], block_bytes):
        n = block.num_rows
        every = np.full((n, 1), np.iinfo(np.int64).max)
        found = _search(spark, rows, _Lists(block, positives, True, -every - 1, every, every > 0)).toArrow()
        at, rank = found["list"].to_numpy(), found["rank"].to_numpy() - 1
        scores = found["score"].to_numpy()
        lo, hi, there = (np.zeros((n, positives), kind) for kind in (np.int64, np.int64, bool))
        # one list for positives of equal score
        column = np.full((n, positives), -1)
        column[at, rank] = rank
        before = np.zeros((n, positives), np.int64)
        before[at, rank] = scores
        for c in range(1, positives):
            equal = (column[:, c] >= 0) & (before[:, c] == before[:, c - 1])
            column[equal, c] = column[equal, c - 1]
        own = (column[at, rank] == rank) & (scores >= 0)
        there[at[own], rank[own]] = True
        lo[at[own], rank[own]] = [-(-low * s // 100) for s in scores[own].tolist()]
        hi[at[own], rank[own]] = [high * s // 100 for s in scores[own].tolist()]
        kept = saved(_search(spark, rows, _Lists(block, negatives, False, lo, hi, there)), "negatives-found")
        mined = spark.createDataFrame(pa.table({
            "list": at * positives + column[at, rank], "anchor_id": block["vec_id"].to_numpy()[at],
            "positive_id": found["vec_id"], "positive_score": found["score"]}))
        part = mined.join(kept, "list").select(
            "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score",
            F.col("score").alias("negative_score"))
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], MINED) if out is None else out
