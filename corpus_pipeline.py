"""A corpus pipeline out of the operators in fieldtally.llm: stages applied to `documents`, one after the other.

A stage takes all documents that its predecessor kept and returns documents, the last one packed sequences. What a
stage returns is written as Parquet to the shared folder and read again by the next, so that a lost executor costs
tasks of one stage only.

Null and empty texts, repeated rows and extra columns pass through as the operators define it; an empty table gives
no pieces.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldtally.llm import credentials, decontaminate, jaccard, packing, toxicity
from fieldtally.llm.shared import saved

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model scores below 0.7."""
    model = toxicity.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), sample=10_000, longest=50_000)
    return toxicity.keep(docs, model, least=0.7)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of each near-duplicate class (five-word shingles, similarity 0.8). Documents without an id are
    in no class. Of rows that repeat an id, or its lack, and the text one stays."""
    classes = jaccard.join(docs, n=5, threshold=0.8, recall=0.999)
    later = classes.where("class_id <> doc_id").select("doc_id")
    kept = docs.join(later, "doc_id", "left_anti").select(*docs.columns)
    # the row is kept aside, so that no column of it can clash with the hash
    aside = kept.select(F.struct("*").alias("row"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("text_hash"))
    return aside.dropDuplicates(["id", "text_hash"]).select("row.*")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with less than 5 % of their words inside 13-word windows of benchmark items."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), window=13, percent=5)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, found credentials in their texts replaced by a mark."""
    return credentials.redact(docs, credentials.learn(docs, per_kind=2_000, miss=0.01))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document that is left, with its ids and its place in a sequence of 4096 tokens."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("secret scans", redact_secrets),
    ("best-fit packing", pack),
]

#: Stages train models and pack greedily, which SQL cannot express; tests hold them against plain versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
