"""Removal of repeated passages: every byte covered by a 50-byte string that also starts in a document with a
smaller id, found by merging Burrows-Wheeler transforms.

All suffixes of a large corpus cannot meet in one merge, so strings that can be equal are brought together first.
A string of `length` bytes is keyed by the smallest hash among the `GRAM`-byte pieces inside it. Equal strings have
equal keys, and neighbouring strings mostly have the same one, so a text falls into segments: runs of places with
one key, with the bytes that the last of these strings reaches. Two strings can only be equal if their segments'
keys are, and a key that occurs in copies of one text only cannot repeat anything but the whole text.

* Documents are packed into compressed chunks of about 8 MB of text, each one row, written to the shared folder.
* Whole texts are compared by a hash: a copy of a text with a smaller id is removed as a whole.
* Each chunk gives its distinct keys with the smallest and largest hash of a text; keys met in two texts return to
  the chunks that have them. A key has at most two rows a chunk, however often its passage occurs.
* A key under which more bytes of segments lie than a bucket should hold, say of a line that many texts share and
  go on from differently, is split: its segments are cut into single strings, each under a key of its own made
  from all its bytes, so equal strings still meet and nothing else does.
* Each chunk sends the distinct segments under such keys with their smallest ids. Keys are dealt into buckets of
  bounded size. In a bucket equal segments are put together; a key left with one segment has nothing to be merged
  with. Most others share a piece and no whole string: strings whose hash is met once are told to repeat nothing. What
  is left of the segments, from the first to the last string that may repeat, is dealt into shards, the shards'
  transforms are built and merged by interleave refinement (see bwt.py), and each interval of suffixes that share
  `length` bytes gets its smallest id.
* Back come the places of a segment where a smaller id than the chunk's own was found, as bits of one number. In
  the chunk, a later document with the same segment repeats it whole.

Texts and segment contents are told apart by 64-bit hashes when they are put together and sent back, texts that
share a key by 40 bits; the merge works on the bytes. Defined cases: null and empty texts have nothing to remove; strings never cross documents; rows with equal
ids do not remove each other's bytes; a null id counts as larger than all others; cuts may fall inside a
character, so kept bytes are bytes, not text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldtally.llm.bwt import least_by_repeat
from fieldtally.llm.bytescan import Hashed, gather, slices
from fieldtally.llm.shared import partitions, saved, texts

GRAM = 16
#: Places of a segment, at most; their bits fit a long.
MOST = 63
LAST_ID = 2**63 - 1
CHUNK = "chunk bigint, doc_ids array<bigint>, prints array<bigint>, ends array<bigint>, body binary"
KEPT = "doc_id bigint, n_bytes bigint, spans array<struct<first:bigint,last:bigint>>, kept binary"
_SPAN = pa.struct([("first", pa.int64()), ("last", pa.int64())])
_CUT = np.int64(-2**63)  # marks the key of a single string
_ROWS = 100_000  # segments sent in one batch
_HERE = 256_000  # bytes scanned together: the arrays stay in a core's cache


def pack(docs: DataFrame, chunk_bytes: int = 8_000_000) -> DataFrame:
    """Chunks of documents, each with the ids, where each text ends, and all texts compressed together."""
    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        ids, prints, parts, sizes, held = [], [], [], [], 0

        def closed() -> pa.RecordBatch:
            body = zstandard.ZstdCompressor(level=5).compress(b"".join(parts))
            return pa.RecordBatch.from_pydict(
                {"chunk": [(part << 32) | number], "doc_ids": [np.concatenate(ids)], "prints": [np.concatenate(prints)],
                 "ends": [np.cumsum(np.concatenate(sizes))], "body": [body]},
                schema=pa.schema([("chunk", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("prints", pa.list_(pa.int64())),
                                  ("ends", pa.list_(pa.int64())), ("body", pa.binary())]))

        for batch, data, at in slices(batches, limit=chunk_bytes // 4):
            ids.append(batch.column(0).fill_null(LAST_ID).to_numpy())
            sizes.append(np.diff(at))
            parts.append(data.tobytes())
            prints.append(np.array([xxhash.xxh3_64_intdigest(data[a:b]) for a, b in zip(at[:-1], at[1:])], np.uint64).view(np.int64))
            held += len(data)
            if held >= chunk_bytes:
                yield closed()
                number, ids, prints, parts, sizes, held = number + 1, [], [], [], [], 0
        if ids:
            yield closed()

    return saved(docs.mapInArrow(chunks, CHUNK), "chunks")


class Segments:
    """All segments of some texts: where their strings start (first to last), and their keys."""

    def __init__(self, data: np.ndarray, at: np.ndarray, length: int):
        n = len(data)
        self.hashed = Hashed(data)
        self.key = self.text = self.first = self.last = np.zeros(0, np.int64)
        sizes = np.diff(at)
        if n < length or not (sizes >= length).any():
            return
        h = self.hashed.every(GRAM)
        h >>= np.uint64(24)
        # the least of length - GRAM + 1 neighbours, by doubling
        width, reach = length - GRAM + 1, 1
        while 2 * reach <= width:
            h = np.minimum(h[:-reach], h[reach:]) if reach < len(h) else h
            reach *= 2
        if width > reach:
            h = np.minimum(h[: len(h) - (width - reach)], h[width - reach:])
        text = np.repeat(np.arange(len(sizes)), np.maximum(sizes - length + 1, 0))
        places = gather(at[:-1], np.maximum(sizes - length + 1, 0))
        key = h[places].astype(np.int64)
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (text[1:] != text[:-1])
        begin = np.flatnonzero(new)
        run = np.diff(np.append(begin, len(key)))
        # long runs, of periodic text, are cut at fixed distances from their start
        pieces = -(-run // MOST)
        owner = np.repeat(np.arange(len(begin)), pieces)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        start = begin[owner] + nth * MOST
        size = np.minimum(MOST, run[owner] - nth * MOST)
        self.key, self.text = key[start], text[start]
        self.first = places[start]
        self.last = self.first + size

    def content(self, of: np.ndarray, length: int) -> np.ndarray:
        """Hashes of the segments' bytes."""
        return self.hashed.spans(self.first[of], self.last[of] + length - 1).view(np.int64)

    def under(self, shared: np.ndarray, hot: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
        """Key, text, first, last and content of the segments under the keys `shared`, those under `hot` cut into
        single strings with negative keys. Both lists of keys are in order."""
        of = np.flatnonzero(_member(shared, self.key))
        wide = _member(hot, self.key[of])
        size = np.where(wide, self.last[of] - self.first[of], 1)
        own = np.repeat(of, size)
        nth = np.arange(len(own)) - np.repeat(np.cumsum(size) - size, size)
        cut = np.repeat(wide, size)
        first = self.first[own] + nth
        last = np.where(cut, first + 1, self.last[own])
        content = self.hashed.spans(first, last + length - 1).view(np.int64)
        return np.where(cut, content | _CUT, self.key[own]), self.text[own], first, last, content


def _parts(ids: np.ndarray, ends: np.ndarray, body: bytes) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Ids, bytes and offsets of a chunk's texts, some at a time."""
    data = np.frombuffer(zstandard.ZstdDecompressor().decompress(body, max_output_size=int(ends[-1]) + 1), np.uint8) \
        if len(ends) and ends[-1] else np.zeros(0, np.uint8)
    at = np.concatenate([[0], ends])
    first = 0
    while first < len(ids):
        last = min(max(int(np.searchsorted(at, at[first] + _HERE, side="right")) - 1, first + 1), len(ids))
        yield ids[first:last], data[at[first]: at[last]], at[first: last + 1] - at[first]
        first = last


def _row(batch: pa.RecordBatch, i: int, *names: str) -> list:
    out = []
    for name in names:
        value = batch.column(batch.schema.get_field_index(name))[i]
        if isinstance(value, pa.ListScalar):
            out.append(value.values.to_numpy() if value.is_valid else np.zeros(0, np.int64))
        else:
            out.append(value.as_py())
    return out


def _least(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys and the least and largest value of each."""
    order = np.argsort(keys, kind="stable")
    k, v = keys[order], values[order]
    new = np.ones(len(k), bool)
    new[1:] = k[1:] != k[:-1]
    first = np.flatnonzero(new)
    if not len(first):
        return k, v, v
    return k[first], np.minimum.reduceat(v, first), np.maximum.reduceat(v, first)


def _keys(chunks: DataFrame, length: int) -> DataFrame:
    """chunk, key, print, n: each chunk's distinct keys with the smallest and, if it differs, the largest hash of a text
    under them; n has the number of different segments, in the first of the two rows."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                chunk, prints, ends, body = _row(batch, i, "chunk", "prints", "ends", "body")
                prints = (prints.view(np.uint64) >> np.uint64(24)).astype(np.int64)
                held, different = [(np.zeros(0, np.int64),) * 3], [(np.zeros(0, np.int64),) * 2]
                for own, data, at in _parts(prints, ends, body):
                    s = Segments(data, at, length)
                    held.append(_least(s.key, own[s.text]) if len(s.key) else held[0])
                    different.append(_least(s.content(np.arange(len(s.key)), length), s.key)[:2])
                k, low, high = (np.concatenate([x[j] for x in held]) for j in range(3))
                key, low, _ = _least(k, low)
                _, _, high = _least(k, high)
                _, of, _ = _least(*(np.concatenate([x[j] for x in different]) for j in range(2)))
                n = np.bincount(np.searchsorted(key, of), minlength=len(key))
                more = np.flatnonzero(high != low)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(key) + len(more), chunk)), pa.array(np.append(key, key[more])),
                     pa.array(np.append(low, high[more])),
                     pa.array(np.append(n, np.zeros(len(more), n.dtype)).astype(np.int32))], ["chunk", "key", "print", "n"])

    return chunks.mapInArrow(scan, "chunk bigint, key bigint, print bigint, n int")


def _member(sorted_values: np.ndarray, values: np.ndarray) -> np.ndarray:
    if not len(sorted_values):
        return np.zeros(len(values), bool)
    spot = np.minimum(np.searchsorted(sorted_values, values), len(sorted_values) - 1)
    return sorted_values[spot] == values


def _segments(chunks: DataFrame, length: int) -> DataFrame:
    """chunk, key, low, segment: the distinct segments under the keys each chunk got back, and their smallest ids."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                chunk, ids, ends, body, shared, hot = _row(batch, i, "chunk", "doc_ids", "ends", "body", "shared", "hot")
                shared, hot = np.sort(shared), np.sort(hot)
                if not len(shared):
                    continue
                held, raw, begin = [(np.zeros(0, np.int64),) * 5], [], 0
                for own, data, at in _parts(ids, ends, body):
                    s = Segments(data, at, length)
                    key, text, first, last, content = s.under(shared, hot, length)
                    content, one, which = np.unique(content, return_index=True, return_inverse=True)
                    low = np.full(len(content), LAST_ID)
                    np.minimum.at(low, which, own[text])
                    held.append((content, low, key[one], first[one] + begin, last[one] - first[one] + length - 1))
                    raw.append(data)
                    begin += len(data)
                raw = np.concatenate(raw)
                content, low, key, first, size = (np.concatenate([x[j] for x in held]) for j in range(5))
                content, one, which = np.unique(content, return_index=True, return_inverse=True)
                least = np.full(len(content), LAST_ID)
                np.minimum.at(least, which, low)
                # by key, so that segments that are much alike are neighbours where they are compressed
                order = np.argsort(key[one], kind="stable")
                for at in range(0, len(order), _ROWS):
                    here = order[at: at + _ROWS]
                    row = one[here]
                    bounds = np.concatenate([[0], np.cumsum(size[row])]).astype(np.int32)
                    segment = pa.Array.from_buffers(pa.binary(), len(row), [
                        None, pa.py_buffer(bounds), pa.py_buffer(raw[gather(first[row], size[row])])])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(row), chunk)), pa.array(key[row]), pa.array(least[here]), segment],
                        ["chunk", "key", "low", "segment"])

    return chunks.mapInArrow(scan, "chunk bigint, key bigint, low bigint, segment binary")


def _body(column: pa.Array) -> tuple[bytes, np.ndarray]:
    """The bytes of a column of byte strings without nulls, and where each begins and the last one ends."""
    _, offsets, data = column.buffers()
    kind = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    at = np.frombuffer(offsets, kind)[column.offset: column.offset + len(column) + 1].astype(np.int64)
    return data.to_pybytes()[at[0]: at[-1]], at - at[0]


def _met(hashed: Hashed, begin: np.ndarray, size: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Segments with a string whose hash is met again, and the first and last such string of each. All other strings are
    met once, since equal ones have equal hashes. `begin` has where a segment begins, `size` how many strings it has."""
    start = gather(begin, size)
    h = hashed.spans(start, start + length)
    order = np.argsort(h)
    h = h[order]
    again = np.zeros(len(h) + 1, bool)
    again[1:-1] = h[1:] == h[:-1]
    at = np.sort(order[again[1:] | again[:-1]])
    before = np.cumsum(size) - size
    owner = np.searchsorted(before, at, side="right") - 1
    of, first, n = np.unique(owner, return_index=True, return_counts=True)
    return of, at[first] - before[of], at[first + n - 1] - before[of]


def _repeated(segments: DataFrame, length: int, buckets: int, shard_bytes: int) -> DataFrame:
    """chunk, content, places: bits of the places at which a string starts that has a smaller id than `low`."""
    def merge(group: pa.Table) -> pa.Table:
        key, low, chunk = (group[c].combine_chunks().to_numpy() for c in ("key", "low", "chunk"))
        raw, ends = _body(group["segment"].combine_chunks())
        hashed = Hashed(np.frombuffer(raw, np.uint8))
        content = hashed.spans(ends[:-1], ends[1:]).view(np.int64)
        # rows of single strings stay apart, so that the transforms tell which are equal
        _, first, which = np.unique(np.where(key < 0, np.arange(len(key)), content), return_index=True, return_inverse=True)
        least = np.full(len(first), LAST_ID)
        np.minimum.at(least, which, low)
        _, under, n = np.unique(key[first], return_inverse=True, return_counts=True)
        size = np.diff(ends) - length + 1
        # a segment's own smallest id holds for all its strings
        places = np.where(least[which] < low, (np.int64(1) << size) - 1, 0)
        several = np.flatnonzero(n[under] > 1)
        of, lo, hi = _met(hashed, ends[first[several]], size[first[several]], length)
        several = several[of]
        if len(several):
            # only the strings from the first to the last that may be met again are merged
            begin = ends[first[several]]
            strings = [raw[a:b] for a, b in zip((begin + lo).tolist(), (begin + hi + length).tolist())]
            found, begins = least_by_repeat(strings, least[several], length, shard_bytes)
            spot = np.full(len(first), -1)
            spot[several] = np.arange(len(several))
            rows = np.flatnonzero((spot[which] >= 0) & (places == 0))
            of = spot[which[rows]]
            n_places = hi[of] - lo[of] + 1
            row = np.repeat(np.arange(len(rows)), n_places)
            nth = gather(np.zeros(len(rows), np.int64), n_places)
            hit = found[begins[of][row] + nth] < low[rows][row]
            row, bit = row[hit], (nth + lo[of][row])[hit]
            np.bitwise_or.at(places, rows[row], np.int64(1) << bit)
        keep = np.flatnonzero(places)
        return pa.table({"chunk": chunk[keep], "content": content[keep], "places": places[keep]})

    bucket = F.pmod(F.xxhash64("key"), F.lit(buckets)).cast("int")
    return (segments.withColumn("bucket", bucket).groupBy("bucket")
            .applyInArrow(merge, "chunk bigint, content bigint, places bigint"))


def _removed(chunks: DataFrame, length: int) -> DataFrame:
    """Apply what came back to each chunk's documents."""
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids, ends, body, shared, hot, contents, places, copies = _row(
                    batch, i, "doc_ids", "ends", "body", "shared", "hot", "contents", "places", "copies")
                shared, hot, done = np.sort(shared), np.sort(hot), 0
                copied = np.zeros(len(ids), bool)
                copied[copies] = True
                order = np.argsort(contents, kind="stable")
                contents, places = contents[order], places[order]
                # first the smallest id of each shared segment in this chunk, then its documents' places
                kept, low = [], [(np.zeros(0, np.int64),) * 2]
                for own, data, at in _parts(ids, ends, body):
                    s = Segments(data, at, length)
                    _, text, first, last, content = s.under(shared, hot, length)
                    doc = own[text]
                    kept.append((own, data, at, first, last, content, doc))
                    low.append(_least(content, doc)[:2] if len(first) else low[0])
                known, least, _ = _least(*(np.concatenate([x[j] for x in low]) for j in range(2)))
                for own, data, at, first, last, content, doc in kept:
                    whole = copied[done: done + len(own)] & (np.diff(at) >= length)
                    done += len(own)
                    yield _cleaned(own, data, at, whole, first, last, content, doc, known, least, contents, places, length)

    def _cleaned(own, data, at, whole, first, last, content, doc, known, least, contents, places, length):
        starts = np.zeros(len(data) + 1, np.int32)
        np.add.at(starts, at[:-1][whole], 1)
        np.add.at(starts, at[1:][whole], -1)
        if len(first):
            later = doc > least[np.searchsorted(known, content)]
            np.add.at(starts, first[later], 1)
            np.add.at(starts, last[later] + length - 1, -1)
            hit = np.flatnonzero(~later & _member(contents, content))
            bits = places[np.searchsorted(contents, content[hit])] if len(hit) else np.zeros(0, np.int64)
            size = last[hit] - first[hit]
            spot = gather(first[hit], size)
            row = np.repeat(np.arange(len(hit)), size)
            spot = spot[(bits[row] >> (spot - first[hit][row])) & 1 == 1]
            starts += np.bincount(spot, minlength=len(starts)).astype(np.int32)
            starts -= np.bincount(spot + length, minlength=len(starts)).astype(np.int32)
        gone = np.cumsum(starts[:-1]) > 0
        edge = np.zeros(len(data) + 1, bool)
        edge[at] = True
        begins = np.flatnonzero(gone & (np.concatenate([[True], ~gone[:-1]]) | edge[:-1])) if len(gone) else at[:0]
        stops = np.flatnonzero(gone & (np.concatenate([~gone[1:], [True]]) | edge[1:])) + 1 if len(gone) else at[:0]
        text = np.searchsorted(at, begins, side="right") - 1
        cut = np.searchsorted(text, np.arange(len(own) + 1))
        base = at[text]
        spans = pa.StructArray.from_arrays([pa.array(begins - base), pa.array(stops - base)], ["first", "last"])
        left = np.concatenate([[0], np.cumsum(~gone)])
        body = pa.Array.from_buffers(pa.binary(), len(own), [None, pa.py_buffer(left[at].astype(np.int32)),
                                                             pa.py_buffer(np.ascontiguousarray(data[~gone]))])
        ids = pa.array(own, mask=own == LAST_ID)
        return pa.RecordBatch.from_arrays(
            [ids, pa.array(np.diff(at)), pa.ListArray.from_arrays(pa.array(cut, pa.int32()), spans), body],
            ["doc_id", "n_bytes", "spans", "kept"])

    return chunks.mapInArrow(apply, KEPT)


def remove(docs: DataFrame, length: int = 50, chunk_bytes: int = 8_000_000, bucket_bytes: int = 1_000_000,
           shard_bytes: int = 128_000) -> DataFrame:
    """For every document: doc_id, n_bytes, spans (maximal removed byte ranges, ends exclusive), kept (remaining bytes)."""
    if length < GRAM:
        raise ValueError(f"strings have to be {GRAM} bytes long or longer")
    chunks = pack(texts(docs), chunk_bytes)
    n = partitions(docs.sparkSession)
    under = Window.partitionBy("key")  # two rows a chunk and key at most
    hot = F.col("bytes") > bucket_bytes
    met = (_keys(chunks, length).repartition(n, "key")
           .withColumn("least", F.min("print").over(under)).withColumn("most", F.max("print").over(under))
           .withColumn("bytes", F.sum("n").over(under) * (MOST + length - 1))
           .where("least < most").groupBy("chunk")
           .agg(F.collect_list("key").alias("shared"), F.collect_set(F.when(hot, F.col("key"))).alias("hot"),
                # a segment's strings, cut, are as many as a key's run has places
                F.sum(F.when(hot, F.col("n") * (length - GRAM + 1) * length).otherwise(F.col("n") * 2 * length)).alias("bytes")))
    texts_of = chunks.select("chunk", F.posexplode(F.arrays_zip("prints", "doc_ids")).alias("place", "of")).select(
        "chunk", "place", F.col("of.prints").alias("print"), F.col("of.doc_ids").alias("id"))
    first = texts_of.groupBy("print").agg(F.min("id").alias("first"))
    copies = (texts_of.join(first, "print").where("id > first").groupBy("chunk")
              .agg(F.collect_list(F.col("place").cast("long")).alias("copies")))
    known = saved(met.join(copies, "chunk", "full_outer"), "shared")
    sent = known.agg(F.sum("bytes")).first()[0] or 0
    asking = chunks.join(known, "chunk", "left")
    # the same join as below, so that its shuffles are written once
    segments = _segments(asking, length)
    found = (_repeated(segments, length, max(n, -(-sent // bucket_bytes)), shard_bytes)
             .groupBy("chunk").agg(F.collect_list("content").alias("contents"), F.collect_list("places").alias("places")))
    return _removed(asking.join(found, "chunk", "left"), length)


def digests(removed: DataFrame) -> DataFrame:
    """The contract's columns."""
    gone = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"])
    return removed.select("doc_id", "n_bytes", gone.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                          F.sha2("kept", 256).alias("kept_sha256"))
