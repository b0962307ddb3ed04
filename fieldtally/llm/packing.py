"""Token sequences of fixed capacity filled with whole documents: dominance reduction, then best fit.

Documents are encoded and cut into pieces of at most the capacity. How pieces are combined depends only on how
many there are of each length, at most `capacity` numbers whatever the corpus holds. The plan is made on that
histogram:

* Martello and Toth's dominance criterion fixes a set for good where it can be proven that some best solution
  has it: the longest piece alone when nothing fits beside it, with the piece that fills it exactly, with the
  largest other one when only one more fits or when no feasible pair is larger, and with the two largest when
  each feasible pair is no larger in either place. Fixed pieces leave the instance and the next longest follows.
* The rest is placed by best fit, longest first, in whole groups of equal bins.

Each piece then finds its bin by its rank among the pieces of its length. Ranks are the number of equal pieces
in earlier partitions plus a count inside the partition, so no length, however common, is gathered in a task.

Defined cases: a null text is empty and has only the end id; documents with equal or null ids are packed each
for itself; an empty table gives no pieces. Piece order, ids and sequences do not depend on other columns.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldtally.llm.bytescan import slices
from fieldtally.llm.shared import saved, texts
from fieldtally.llm.tokens import encoder, id_lists

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids binary, part int, ordinal bigint"


def cut(docs: DataFrame, vocabulary: str = "word_bpe_49k.json", end: int = 1, capacity: int = 4096) -> DataFrame:
    """The pieces of all documents with their ids, written to the shared folder.

    `part` and `ordinal` tell apart pieces of equal length: the partition that wrote a piece, and how many of its
    length came before it there.
    """
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch, data, at in slices(batches):
            ids, begins = encoder(vocabulary, end).encode(data, at)
            total = np.diff(begins)
            count = -(-total // capacity)
            doc = np.repeat(np.arange(len(total)), count)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
            start = piece * capacity
            length = np.minimum(capacity, total[doc] - start)
            # the place of each piece among those of its length in this slice
            order = np.argsort(length, kind="stable")
            by_length = length[order]
            first = np.searchsorted(by_length, by_length)
            ordinal = np.empty(len(length), np.int64)
            ordinal[order] = np.arange(len(length)) - first + seen[by_length]
            seen += np.bincount(length, minlength=capacity + 1)
            edges = np.append(begins[doc] + start, begins[-1])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), id_lists(ids, edges),
                 pa.array(np.full(len(doc), part), pa.int32()), pa.array(ordinal, pa.int64())],
                ["doc_id", "piece", "start", "length", "ids", "part", "ordinal"])

    return saved(texts(docs).mapInArrow(pieces, PIECES), "pieces")


class Group(NamedTuple):
    """`bins` equal bins; each holds `times` pieces of `length` for every (length, times) of `content`."""
    bins: int
    content: list[tuple[int, int]]
    fixed: bool


def _reduce(count: np.ndarray, capacity: int) -> list[Group]:
    """Fix dominating sets, longest piece first, and take them out of `count` (pieces by length)."""
    fixed: list[Group] = []

    def have(length: int, used: tuple[int, ...]) -> int:
        return int(count[length]) - used.count(length)

    def largest(most: int, used: tuple[int, ...]) -> int:
        """The largest length up to `most` of which a piece is left beside those in `used`; 0 if none."""
        for at in np.flatnonzero(count[1: most + 1])[::-1] + 1 if most > 0 else ():
            if have(int(at), used) > 0:
                return int(at)
        return 0

    def smallest(n: int, used: tuple[int, ...]) -> list[int]:
        out: list[int] = []
        for at in np.flatnonzero(count[1:]) + 1:
            out += [int(at)] * min(n - len(out), max(0, have(int(at), used)))
            if len(out) == n:
                break
        return out

    def fix(items: list[int]) -> None:
        kinds = {x: items.count(x) for x in items}
        bins = min(int(count[x]) // k for x, k in kinds.items())
        for x, k in kinds.items():
            count[x] -= bins * k
        fixed.append(Group(bins, sorted(kinds.items(), reverse=True), True))

    for j in range(capacity, 0, -1):
        while count[j]:
            room, least = capacity - j, smallest(3, (j,))
            k = largest(room, (j,))
            if not k:
                fix([j])
                continue
            if k == room or len(least) < 2 or room < least[0] + least[1]:
                fix([j, k])
                continue
            if len(least) == 3 and room >= sum(least):
                break  # three more may fit: nothing is proven
            # at most two more fit; the best pair, and the largest smaller member of any pair
            best = smaller = 0
            for a in np.flatnonzero(count[1: room + 1])[::-1] + 1:
                b = largest(min(int(a), room - int(a)), (j, int(a))) if have(int(a), (j,)) > 0 else 0
                if b:
                    best, smaller = max(best, int(a) + b), max(smaller, b)
            if k >= best:
                fix([j, k])
                continue
            second = largest(room - k, (j, k))
            if second and smaller <= second:
                fix([j, k, second])
                continue
            break
    return fixed


def _best_fit(count: np.ndarray, capacity: int) -> list[Group]:
    """Best fit, longest first, on whole groups of bins with equal content."""
    room: dict[int, list[tuple[int, list[tuple[int, int]]]]] = {}
    free = np.zeros(capacity + 1, bool)

    def put(bins: int, left: int, content: list[tuple[int, int]]) -> None:
        if bins:
            room.setdefault(left, []).append((bins, content))
            free[left] = True

    for length in (np.flatnonzero(count)[::-1]).tolist():
        n = int(count[length])
        while n:
            fitting = np.flatnonzero(free[length:])
            if len(fitting):
                left = int(fitting[0]) + length
                bins, content = room[left].pop()
                free[left] = bool(room[left])
            else:
                left, content = capacity, []
                bins = -(-n // (capacity // length))
            times = left // length
            full = min(bins, n // times)
            put(full, left - times * length, [*content, (length, times)])
            n -= full * times
            if full < bins and n:
                put(1, left - n * length, [*content, (length, n)])
                full, n = full + 1, 0
            if content:
                put(bins - full, left, content)
    return [Group(bins, content, False) for left in sorted(room) for bins, content in room[left]]


def plan(histogram: dict[int, int], capacity: int) -> list[Group]:
    """How many bins hold which lengths, for `histogram[length]` pieces of each length."""
    count = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        count[length] = n
    return _reduce(count, capacity) + _best_fit(count, capacity)


def _slots(groups: list[Group]) -> dict[str, np.ndarray]:
    """For each length, which ranks go to which group: from `rank` on, `times` to a bin, at `offset` in it."""
    rows, used, first = [], {}, 0
    for bins, content, fixed in groups:
        offset = 0
        for length, times in content:
            rows.append((length, used.get(length, 0), times, offset, first, fixed))
            used[length] = used.get(length, 0) + bins * times
            offset += length * times
        first += bins
    rows.sort()
    names = ("length", "rank", "times", "offset", "sequence", "fixed")
    return {n: np.array([r[i] for r in rows], np.int64) for i, n in enumerate(names)}


def place(pieces: DataFrame, capacity: int = 4096) -> DataFrame:
    """The pieces of `cut`, with any of its columns, and where each goes: sequence_id, offset, fixed (by dominance)."""
    counts = pieces.groupBy("part", "length").agg((F.max("ordinal") + 1).alias("n"))
    # at most `capacity` rows reach the driver
    histogram = {int(r.length): int(r.n) for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = _slots(plan(histogram, capacity))
    before = counts.select("part", "length", (F.sum("n").over(
        Window.partitionBy("length").orderBy("part")) - F.col("n")).alias("before"))
    kept = [c for c in pieces.columns if c not in ("part", "ordinal")]
    ranked = pieces.join(before, ["part", "length"]).select(*kept, (F.col("before") + F.col("ordinal")).alias("rank"))
    width = max(1, int(max(histogram.values(), default=1)) + 1)
    keys = slots["length"] * width + slots["rank"]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("length", "rank"))
            row = np.searchsorted(keys, length * width + rank, side="right") - 1
            inside = rank - slots["rank"][row]
            bin_, nth = np.divmod(inside, slots["times"][row])
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index(c)) for c in kept]
                + [pa.array(slots["sequence"][row] + bin_), pa.array(slots["offset"][row] + nth * length),
                   pa.array(slots["fixed"][row] > 0)], [*kept, "sequence_id", "offset", "fixed"])

    kinds = {f.name: f.dataType.simpleString() for f in pieces.schema.fields}
    out = ", ".join(f"`{c}` {kinds[c]}" for c in kept) + ", sequence_id bigint, offset bigint, fixed boolean"
    return ranked.mapInArrow(assign, out)


def pack(docs: DataFrame, vocabulary: str = "word_bpe_49k.json", end: int = 1, capacity: int = 4096) -> DataFrame:
    """Every piece with its ids and its place."""
    return place(cut(docs, vocabulary, end, capacity), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """The filled sequences themselves: sequence_id, n_tokens, ids; a sequence has at most `capacity` pieces."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(
        F.sum("length").alias("n_tokens"),
        F.aggregate(parts, F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids"))
