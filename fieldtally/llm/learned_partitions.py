"""Approximate nearest neighbours by inner product with learned partitions.

*Fit*, on a bounded sample: the sample's neighbour graph (each vector with its best others by inner product) is
cut into balanced parts, so that few edges lie between parts. A small classifier (one hidden layer) learns from
each vector which part it and its neighbours are in. A second one, the router, learns over which parts the
neighbours of a query are spread, once the first has decided where vectors go.

*Index*: every row goes to the part that the first classifier finds most probable. Rows are written once, in order
of their part and dealt over files by part and id, so that a part that holds most rows is split over many tasks.

*Search*: a query visits its most probable parts and is scored exactly, in double precision, against all rows in
them. Queries come in blocks of bounded size, dealt by their first part; a block is broadcast and only the files
of the parts that it visits are read. Every task keeps running lists of the best rows, and a window merges them.

How many parts a query visits is not set by hand: `learn` takes held-out rows as queries, finds their true
neighbours among *all* rows, and takes the fewest parts that give the wanted recall on them. On vectors without
neighbourhoods that are many; on clustered ones few.

Of equal vectors only the k + 1 with the smallest ids can be among any query's best k (one of them may be the query
itself), since they score alike and ties go to the smaller id. The others are dropped before indexing, exactly, by a limit that combines before
the shuffle, so that one vector shared by a third of all rows makes no part hot.

Defined cases: rows with a null id, a null, empty or zero vector, or a component that is null or not finite take no part;
vectors of different lengths are compared over their common components; rows that repeat id and vector count
once, and a query never meets rows of its own id; fewer rows than parts make a single part; empty tables give no
rows. An inner product beyond the doubles is infinite, and one that is no number comes last.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldtally.llm.shared import partitions, saved, ship
from fieldtally.llm.vectors import Best, finite, matrix, query_blocks, vector_bytes

BEST = "query bigint, vec_id bigint, score double"
INDEXED = "part int, vec_id bigint, vector array<double>"
#: Scores of a block that a task holds at once.
_CELLS = 4_000_000


def usable(vectors: DataFrame, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """Ids and vectors, as doubles, of the rows that take part; repeated rows once."""
    x = F.col(column).cast("array<double>")
    rows = vectors.where(F.col(id_column).isNotNull() & finite(column)).where(F.exists(x, lambda v: v != 0))
    return rows.select(F.col(id_column).cast("long").alias("vec_id"), x.alias("vector")).dropDuplicates()


# ---------------------------------------------------------------- the neighbour graph and its parts

def neighbours(x: np.ndarray, k: int, block: int = 1024) -> np.ndarray:
    """For every vector the `k` others of largest inner product."""
    out = np.empty((len(x), min(k, len(x) - 1)), np.int64)
    for lo in range(0, len(x), block):
        score = x[lo: lo + block] @ x.T
        score[np.arange(len(score)), lo + np.arange(len(score))] = -np.inf
        out[lo: lo + block] = np.argpartition(-score, out.shape[1] - 1, axis=1)[:, : out.shape[1]]
    return out


def balanced_parts(x: np.ndarray, edges: np.ndarray, parts: int, slack: float = 0.1, sweeps: int = 20) -> np.ndarray:
    """A part for every vector, none larger than (1 + slack) times the mean, with few edges between parts.

    The start halves the vectors again and again along the direction in which they differ most; sweeps then move
    vectors to the part that holds most of their neighbours, largest gains first, while there is room.
    """
    part = np.zeros(len(x), np.int64)
    made = 1
    while made < parts:
        for p in range(made):
            mine = np.flatnonzero(part == p)
            centred = x[mine] - x[mine].mean(axis=0)
            direction = np.linalg.eigh(centred.T @ centred)[1][:, -1]
            order = np.argsort(centred @ direction, kind="stable")
            part[mine[order[len(order) // 2:]]] = made + p
        made *= 2
    room = int(np.ceil((1 + slack) * len(x) / parts))
    size = np.bincount(part, minlength=parts)
    source, target = np.repeat(np.arange(len(x)), edges.shape[1]), edges.ravel()
    for _ in range(sweeps):
        held = np.zeros((len(x), parts), np.int32)
        np.add.at(held, (source, part[target]), 1)
        np.add.at(held, (target, part[source]), 1)
        best = held.argmax(axis=1)
        gain = held[np.arange(len(x)), best] - held[np.arange(len(x)), part]
        moved = 0
        for v in np.argsort(-gain, kind="stable")[: int((gain > 0).sum())]:
            if size[best[v]] < room:
                size[part[v]] -= 1
                size[best[v]] += 1
                part[v] = best[v]
                moved += 1
        if moved <= len(x) // 1000:
            break
    return part


# ---------------------------------------------------------------- the classifier

@dataclass
class Classifier:
    """A hidden layer of rectified units and a softmax over parts."""

    scale: float
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.maximum((x * self.scale) @ self.w1 + self.b1, 0) @ self.w2 + self.b2


def fit_classifier(x: np.ndarray, wanted: np.ndarray, hidden: int = 128, epochs: int = 40, batch: int = 256,
                   rate: float = 0.003, seed: int = 7) -> Classifier:
    """Fit by Adam to the shares `wanted`, a row a vector and a column a part."""
    rng = np.random.default_rng(seed)
    scale = 1 / max(1e-300, float(np.sqrt(np.square(x).mean())))
    z = x * scale
    shapes = [(z.shape[1], hidden), (hidden,), (hidden, wanted.shape[1]), (wanted.shape[1],)]
    weights = [rng.normal(0, np.sqrt(2 / max(1, s[0])), s) if len(s) == 2 else np.zeros(s) for s in shapes]
    first, second = [np.zeros(s) for s in shapes], [np.zeros(s) for s in shapes]
    step, steps = 0, epochs * -(-len(z) // batch)
    for _ in range(epochs):
        order = rng.permutation(len(z))
        for lo in range(0, len(z), batch):
            at = order[lo: lo + batch]
            h = np.maximum(z[at] @ weights[0] + weights[1], 0)
            out = h @ weights[2] + weights[3]
            p = np.exp(out - out.max(axis=1, keepdims=True))
            off = (p / p.sum(axis=1, keepdims=True) - wanted[at]) / len(at)
            back = (off @ weights[2].T) * (h > 0)
            step += 1
            now = rate * (1 - step / steps) + rate / 50
            for i, g in enumerate((z[at].T @ back, back.sum(axis=0), h.T @ off, off.sum(axis=0))):
                first[i] = 0.9 * first[i] + 0.1 * g
                second[i] = 0.999 * second[i] + 0.001 * g * g
                weights[i] -= now * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    return Classifier(scale, *weights)


def _shares(part: np.ndarray, edges: np.ndarray, parts: int, own: float) -> np.ndarray:
    """Over which parts a vector's neighbours are spread, its own part counted `own` times."""
    out = np.zeros((len(edges), parts))
    np.add.at(out, (np.repeat(np.arange(len(edges)), edges.shape[1]), part[edges].ravel()), 1)
    out[np.arange(len(edges)), part[: len(edges)]] += own
    return out / np.maximum(1e-300, out.sum(axis=1, keepdims=True))


@dataclass
class Model:
    """Where vectors go, where queries look, and how many parts a query visits (with the recall that gave)."""

    width: int
    parts: int
    place: Classifier | None
    route: Classifier | None
    probes: int = 1
    recall: float = 1.0

    def part(self, x: np.ndarray) -> np.ndarray:
        return np.zeros(len(x), np.int64) if self.place is None else self.place.logits(x).argmax(axis=1)

    def ranked(self, x: np.ndarray) -> np.ndarray:
        """All parts for every query, most probable first."""
        if self.route is None:
            return np.zeros((len(x), 1), np.int64)
        return np.argsort(-self.route.logits(x), axis=1, kind="stable")


# ---------------------------------------------------------------- index

def candidates(rows: DataFrame, k: int) -> DataFrame:
    """The rows that can be among the best k of any query, written to the shared folder and spread evenly."""
    by = Window.partitionBy("vector").orderBy("vec_id")
    first = rows.withColumn("copy", F.row_number().over(by)).where(F.col("copy") <= k + 1).drop("copy")
    return saved(first.repartition(partitions(rows.sparkSession)), "neighbours-rows")


def learn(rows: DataFrame, k: int = 20, target: float = 0.95, sample: int = 8_192, held_out: int = 256,
          parts: int | None = None, most_parts: int = 256, degree: int = 10) -> tuple[Model, DataFrame]:
    """A model fitted on `sample` rows at most, and the index of all `rows` (as `candidates` returns them).

    Rows are sampled by a hash of their vector: the first ones fit the model, the next `held_out` ones only measure
    recall. Without `parts` there are about a quarter of the square root of the number of rows, a power of two, at most
    `most_parts`, with 32 sampled vectors each at least.
    """
    spark = rows.sparkSession
    ship(spark)
    n, width = rows.agg(F.count(F.lit(1)), F.max(F.size("vector"))).first()
    sample = min(sample, n // 2)
    drawn = rows.orderBy(F.xxhash64("vector"), "vec_id").limit(sample + held_out).toArrow() if n else None
    x = matrix(drawn["vector"], width) if n else np.zeros((0, 0))
    fit, asked = x[:sample], x[sample:]
    wanted = parts or 2 ** max(0, round(np.log2(max(1, np.sqrt(n) / 4))))
    parts = 1
    while parts * 2 <= min(wanted, most_parts) and parts * 2 * 32 <= len(fit):
        parts *= 2
    model = Model(width or 0, parts, None, None)
    if parts > 1:
        edges = neighbours(fit, degree)
        part = balanced_parts(fit, edges, parts)
        model.place = fit_classifier(fit, _shares(part, edges, parts, own=degree))
        model.route = fit_classifier(fit, _shares(model.part(fit), edges, parts, own=0))
    index = _index(rows, model)
    if parts > 1 and len(asked):
        block = pa.table({"vec_id": drawn["vec_id"][sample:], "vector": drawn["vector"][sample:]})
        model.probes, model.recall = _calibrated(spark, index, model, block, k, target)
    return model, index


def _index(rows: DataFrame, model: Model) -> DataFrame:
    """Every row with its part, in order of part and split evenly over files."""
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column("vector")
            part = model.part(matrix(vectors, model.width))
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), batch.column("vec_id"), vectors],
                                             ["part", "vec_id", "vector"])

    placed = saved(rows.select("vec_id", "vector").mapInArrow(place, INDEXED), "neighbours-placed")
    dealt = placed.repartitionByRange(partitions(rows.sparkSession), "part", "vec_id").sortWithinPartitions("part")
    return saved(dealt, "neighbours-index")


def _calibrated(spark: SparkSession, index: DataFrame, model: Model, block: pa.Table, k: int,
                target: float) -> tuple[int, float]:
    """The fewest parts that give the wanted recall on the queries of `block`, against a search of all rows."""
    every = np.ones((block.num_rows, model.parts), bool)
    true = _scan(spark, index, model, block, every, k).join(index.select("vec_id", "part"), "vec_id").toArrow()
    order = np.argsort(model.ranked(matrix(block["vector"], model.width)), axis=1)  # rank of every part
    at = order[true["query"].to_numpy(), true["part"].to_numpy()]
    found = np.cumsum(np.bincount(at, minlength=model.parts)) / max(1, len(at))
    enough = int(np.argmax(found >= min(target, found[-1])))
    return enough + 1, float(found[enough])


# ---------------------------------------------------------------- search

def _exact_scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of equal rows, components added in their order, so that equal vectors score alike."""
    out = np.zeros(len(a))
    for j in range(a.shape[1]):
        out += a[:, j] * b[:, j]
    return np.where(np.isnan(out), -np.inf, out)


def _scan(spark: SparkSession, index: DataFrame, model: Model, block: pa.Table, visits: np.ndarray, k: int) -> DataFrame:
    """The best k rows of each query of the block among the parts it visits: query (its place), rank, vec_id, score."""
    queries, own = matrix(block["vector"], model.width), block["vec_id"].to_numpy()
    shared = spark.sparkContext.broadcast((queries, own, visits))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, own, visits = shared.value
        norms = np.sqrt(np.square(queries).sum(axis=1))
        best = Best(len(queries), k)
        for batch in batches:
            part = batch.column("part").to_numpy()
            rows, ids = matrix(batch.column("vector"), queries.shape[1]), batch.column("vec_id").to_numpy()
            for p in np.unique(part):
                at, asking = np.flatnonzero(part == p), np.flatnonzero(visits[:, p])
                mine, longest = rows[at], float(np.sqrt(np.square(rows[at]).sum(axis=1)).max(initial=0))
                last = best.last()
                step = max(1, _CELLS // max(1, len(at)))
                for lo in range(0, len(asking), step):
                    q = asking[lo: lo + step]
                    # a fast product picks what can be among the best, the exact one decides
                    rough = queries[q] @ mine.T
                    rough[np.isnan(rough)] = -np.inf
                    edge = np.full(len(q), -np.inf)
                    if len(at) > k + 1:
                        edge = np.partition(rough, len(at) - k - 1, axis=1)[:, len(at) - k - 1]
                    error = 4 * (queries.shape[1] + 2) * 2.0**-52 * norms[q] * longest
                    edge = np.maximum(edge, last[q]) - np.where(np.isfinite(error), error, np.inf)
                    a, r = np.nonzero(rough >= np.where(np.isnan(edge), -np.inf, edge)[:, None])
                    a = q[a]
                    keep = ids[at[r]] != own[a]
                    a, r = a[keep], r[keep]
                    best.add(a, ids[at[r]], _exact_scores(queries[a], mine[r]))
        yield pa.RecordBatch.from_pydict({"query": best.owner, "vec_id": best.ids, "score": best.scores})

    found = index.mapInArrow(find, BEST)
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(model: Model, index: DataFrame, queries: DataFrame, k: int = 20, block_bytes: int = 32_000_000) -> DataFrame:
    """The k nearest rows found for each of `queries` (as `usable` returns them): query_id, rank, vec_id, score."""
    spark = index.sparkSession

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part = model.ranked(matrix(batch.column("vector"), model.width))[:, 0]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), batch.column("vec_id"), batch.column("vector")],
                                             ["part", "vec_id", "vector"])

    routed = queries.select("vec_id", "vector").mapInArrow(first, INDEXED)
    routed = saved(routed, "neighbours-queries")
    out = None
    for block in _by_part(routed, block_bytes):
        ranked = model.ranked(matrix(block["vector"], model.width))[:, : model.probes]
        visits = np.zeros((block.num_rows, model.parts), bool)
        np.put_along_axis(visits, ranked, True, axis=1)
        parts = np.flatnonzero(visits.any(axis=0)).tolist()
        some = index if len(parts) == model.parts else index.where(F.col("part").isin(parts))
        found = saved(_scan(spark, some, model, block, visits, k), "neighbours-found")
        names = spark.createDataFrame(pa.table({"query": np.arange(block.num_rows), "query_id": block["vec_id"]}))
        part = found.join(names, "query").select("query_id", "rank", "vec_id", "score")
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double") if out is None else out


def _by_part(routed: DataFrame, block_bytes: int) -> Iterator[pa.Table]:
    """Queries in blocks of bounded size, those with the same first part together as far as they fit."""
    sizes = routed.groupBy("part").agg(F.sum(vector_bytes("vector")).alias("bytes")).orderBy("part").collect()
    groups, held = [[]], 0
    for r in sizes:
        if held and held + r["bytes"] > block_bytes:
            groups.append([])
            held = 0
        groups[-1].append(r["part"])
        held += r["bytes"]
    for parts in groups if sizes else []:
        yield from query_blocks(routed.where(F.col("part").isin(parts)), vector_bytes("vector"), ["vec_id", "vector"], block_bytes)


def measured_recall(found: DataFrame, exact: DataFrame) -> float:
    """The share of the rows of `exact` (query_id, vec_id) that are in `found`."""
    hit = exact.join(found.select("query_id", "vec_id", F.lit(1).alias("hit")), ["query_id", "vec_id"], "left")
    return hit.agg(F.coalesce(F.avg(F.coalesce("hit", F.lit(0))), F.lit(1.0))).first()[0]
