"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chanlake.session import ensure_checkpoint_dir, shared_path

# A word is a run of anything but the six ASCII white-space characters;
# Python's bytes.split() cuts at exactly the same ones.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"

# Arrow batches are cut by rows and by bytes, so that a run of very long texts
# never meets in one Python batch.
BATCH_ROWS = 1000
BATCH_BYTES = 4 * 1024 * 1024


def prepare(spark: SparkSession) -> None:
    """Session settings of these operators: small Arrow batches, UTC, and the
    shared folder the cluster names."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    ensure_checkpoint_dir(spark)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a step to the shared folder and read it back: cuts the lineage,
    survives lost executors, and is computed once for several readers."""
    path = shared_path(df.sparkSession, "llm", name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text):
    """Array of the words of a text column; NULL or blank text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def blocks_for(df: DataFrame, per_block: int) -> int:
    """Number of hash blocks for a frame: its estimated bytes over the bytes
    one task should hold, and at least the shuffle partition count."""
    spark = df.sparkSession
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    size = int(size.toString()) if not isinstance(size, int) else size
    if size >= 1 << 60:                       # no statistics
        return least
    return max(least, -(-size // per_block))
