"""Token ids in a compact file format: one zstandard frame a document, one shared dictionary for all.

The store is a Parquet table of shards in ascending document order. A shard row holds

* ``part``, ``shard``: its place; shards ordered by them hold the documents in ascending id order,
* ``doc_ids``, ``n_tokens``, ``offsets``: the index. Document i is the frame ``body[offsets[i]: offsets[i + 1]]``,
* ``dictionary``: the SHA-256 of the dictionary its frames need (empty: none),
* ``body``: the frames one after the other; a frame holds the ids as little-endian unsigned 32-bit integers.

The dictionary is trained on the id arrays of a bounded sample of documents and stored beside the shards. One
document is read by its shard's row and one small frame; nothing else is decompressed.

Defined cases: a null text is empty and has only the end id; null ids come first, equal ids are ordered by
their text's hash; repeated rows are stored as often as they come; an empty table gives an empty store.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldtally.llm.bytescan import slices
from fieldtally.llm.shared import partitions, shared_dir, texts
from fieldtally.llm.tokens import encoder

SHARD = ("part int, shard int, doc_ids array<bigint>, n_tokens array<int>, offsets array<bigint>, "
         "dictionary string, body binary")
DICTIONARY = "dictionary string, trained binary"


def train_dictionary(docs: DataFrame, vocabulary: str, end: int, sample: int, longest: int, size: int) -> DataFrame:
    """One row: the dictionary's hash and bytes, both empty when there is too little text to train one.

    It is trained on the `sample` documents of at most `longest` characters whose hashes are smallest.
    """
    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays = []
        for _, data, at in slices(batches):
            ids, begins = encoder(vocabulary, end).encode(data, at)
            arrays += [ids[a:b].astype("<u4").tobytes() for a, b in zip(begins[:-1], begins[1:])]
        try:
            trained = zstandard.train_dictionary(size, arrays).as_bytes() if len(arrays) >= 8 else b""
        except zstandard.ZstdError:  # the samples are too few or too alike
            trained = b""
        name = hashlib.sha256(trained).hexdigest() if trained else ""
        yield pa.RecordBatch.from_pydict({"dictionary": [name], "trained": [trained]})

    keyed = docs.where(F.length("text") <= longest).select("text", F.xxhash64("doc_id", "text").alias("key"))
    chosen = keyed.select("key").distinct().orderBy("key").limit(sample)  # so many numbers at most
    return (keyed.join(F.broadcast(chosen), "key").dropDuplicates(["key"]).orderBy("key").select("text")
            .coalesce(1).mapInArrow(train, DICTIONARY))


def write(docs: DataFrame, path: str, vocabulary: str = "byte_bpe_50k.json", end: int = 2, shard_bytes: int = 1 << 20,
          level: int = 3, dictionary_sample: int = 2_000, dictionary_longest: int = 20_000,
          dictionary_bytes: int = 64 * 1024) -> None:
    """Encode every whole text, end it with the id `end`, and write the store to the folder `path`.

    `dictionary_sample` and `dictionary_longest` bound what the dictionary is trained on; every document is
    encoded and stored. A shard closes once its frames reach `shard_bytes`.
    """
    spark, docs = docs.sparkSession, texts(docs)
    (train_dictionary(docs, vocabulary, end, dictionary_sample, dictionary_longest, dictionary_bytes)
     .write.parquet(f"{path}/dictionary"))
    name, trained = spark.read.schema(DICTIONARY).parquet(f"{path}/dictionary").first() or ("", b"")
    trained = bytes(trained)

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = zstandard.ZstdCompressionDict(trained) if trained else None
        pack = zstandard.ZstdCompressor(level=level, dict_data=known, write_content_size=True, write_checksum=True)
        part, shard = TaskContext.get().partitionId(), 0
        ids_of, counts, frames, held = [], [], [], 0

        def closed() -> pa.RecordBatch:
            offsets = np.cumsum([0, *map(len, frames)])
            return pa.RecordBatch.from_pydict(
                {"part": [part], "shard": [shard], "doc_ids": [ids_of], "n_tokens": [counts],
                 "offsets": [offsets], "dictionary": [name], "body": [b"".join(frames)]},
                schema=pa.schema([("part", pa.int32()), ("shard", pa.int32()), ("doc_ids", pa.list_(pa.int64())),
                                  ("n_tokens", pa.list_(pa.int32())), ("offsets", pa.list_(pa.int64())),
                                  ("dictionary", pa.string()), ("body", pa.binary())]))

        for batch, data, at in slices(batches):
            ids, begins = encoder(vocabulary, end).encode(data, at)
            raw = memoryview(np.ascontiguousarray(ids, "<u4")).cast("B")
            for doc_id, a, b in zip(batch.column(0).to_pylist(), begins[:-1].tolist(), begins[1:].tolist()):
                frames.append(pack.compress(raw[4 * a: 4 * b]))
                ids_of.append(doc_id)
                counts.append(b - a)
                held += len(frames[-1])
                if held >= shard_bytes:
                    yield closed()
                    shard, ids_of, counts, frames, held = shard + 1, [], [], [], 0
        if frames:
            yield closed()

    ordered = (docs.repartitionByRange(partitions(spark), "doc_id", F.xxhash64("text"))
               .sortWithinPartitions("doc_id", F.xxhash64("text")))
    ordered.mapInArrow(shards, SHARD).write.option("compression", "none").parquet(f"{path}/shards")


def _dictionary(spark: SparkSession, path: str) -> dict[str, bytes]:
    """The stored dictionary by its hash; one row of bounded size."""
    return {r.dictionary: bytes(r.trained) for r in spark.read.schema(DICTIONARY).parquet(f"{path}/dictionary").take(1)}


def _expander(dictionaries: dict[str, bytes], name: str) -> zstandard.ZstdDecompressor:
    trained = dictionaries.get(name)
    if name and hashlib.sha256(trained or b"").hexdigest() != name:
        raise ValueError(f"the store's dictionary is not {name}")
    return zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(trained) if name else None)


def read(spark: SparkSession, path: str) -> DataFrame:
    """All documents of a store: doc_id, start (ids of all documents before it), n_tokens, ids (binary)."""
    dictionaries = _dictionary(spark, path)
    shards = spark.read.schema(SHARD).parquet(f"{path}/shards")
    sizes = shards.select("part", "shard", F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, n: a + n).alias("n"))
    # one row a partition of the writing job: a running sum over so few rows is one small task
    before = (sizes.groupBy("part").agg(F.sum("n").alias("n"))
              .select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("part_start")))
    inside = Window.partitionBy("part").orderBy("shard")
    starts = (sizes.withColumn("inner", F.sum("n").over(inside) - F.col("n"))
              .join(before, "part").select("part", "shard", (F.col("part_start") + F.col("inner")).alias("start")))

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expanders: dict[str, zstandard.ZstdDecompressor] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(j)[i] for j, name in enumerate(batch.schema.names)}
                name = row["dictionary"].as_py()
                if name not in expanders:
                    expanders[name] = _expander(dictionaries, name)
                body, offsets = memoryview(row["body"].as_buffer()), row["offsets"].as_py()
                counts = row["n_tokens"].as_py()
                begins = np.cumsum([row["start"].as_py(), *counts])[:-1]
                ids = [expanders[name].decompress(body[a:b]) for a, b in zip(offsets, offsets[1:])]
                yield pa.RecordBatch.from_arrays(
                    [row["doc_ids"].values, pa.array(begins, pa.int64()), pa.array(counts, pa.int64()),
                     pa.array(ids, pa.binary())], ["doc_id", "start", "n_tokens", "ids"])

    return (shards.join(starts, ["part", "shard"])
            .mapInArrow(documents, "doc_id bigint, start bigint, n_tokens bigint, ids binary"))


def read_one(spark: SparkSession, path: str, doc_id: int) -> list[int] | None:
    """The ids of one document (the first of equal ids), from its own frame only."""
    found = (spark.read.schema(SHARD).parquet(f"{path}/shards").where(F.array_contains("doc_ids", F.lit(doc_id).cast("long")))
             .withColumn("i", F.expr(f"array_position(doc_ids, {int(doc_id)}L)").cast("int"))
             .select("part", "shard", "dictionary",
                     F.expr("substring(body, cast(offsets[i - 1] + 1 as int), cast(offsets[i] - offsets[i - 1] as int))").alias("frame"))
             .orderBy("part", "shard").limit(1).collect())
    if not found:
        return None
    raw = _expander(_dictionary(spark, path), found[0].dictionary).decompress(bytes(found[0].frame))
    return np.frombuffer(raw, "<u4").tolist()


def crc32_of(ids: DataFrame) -> DataFrame:
    """The contract's digest of read documents."""
    return ids.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def new_store(spark: SparkSession) -> str:
    return f"{shared_dir(spark).rstrip('/')}/token-store-{uuid.uuid4().hex}"


def checksum(ids: list[int]) -> int:
    """The checksum of a plain list of ids, for tests and for readers without Spark."""
    return zlib.crc32(np.array(ids, "<u4").tobytes())
