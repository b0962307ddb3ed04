"""What the operators share: a folder all executors see, tables written there, documents with defined columns."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir, or the one that the session's checkpoints go to.

    On one machine a session without either gets a new local folder. On a cluster that would be a folder which
    executors do not share, so there it is an error.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="shared-"))
        named = context.getCheckpointDir()
    return named


def session_dir(spark: SparkSession) -> str:
    """The folder inside the shared one that holds all intermediate tables of this application."""
    return f"{shared_dir(spark).rstrip('/')}/fieldtally-{spark.sparkContext.applicationId}"


def clear(spark: SparkSession) -> None:
    """Delete this application's intermediate tables. To be called once results that read them are written."""
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(session_dir(spark))
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once a session: their Python workers import the operators' helpers."""
    context = spark.sparkContext
    if getattr(context, "_fieldtally_sent", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="code-"), "fieldtally.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(package)))
    context.addPyFile(path)
    context._fieldtally_sent = True


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write the rows as Parquet to the shared folder and read them back, which also cuts the lineage."""
    path = f"{session_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    """How many partitions the cluster wants a shuffle of this session to have."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def texts(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Only the id, as long, and the text, null read as empty, whatever other columns there are."""
    ship(docs.sparkSession)
    return docs.select(F.col(id_column).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"))
