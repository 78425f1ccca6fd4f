"""Stores: relational/document sinks and scans (S9-S11), the per-channel
high-water mark (J3/ST4), equality queries (P6) and media path listing (P10).

Targets are Spark tables or parquet folders in a shared location; a JDBC or
document connector plugs in through ``DataFrameWriter.format(...)`` the same
way, since every function here takes and returns DataFrames.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chanlake.schemas import LAST_ID
from chanlake.session import shared_path

IMAGE_SUFFIX = r"\.(jpg|png|jpeg)$"   # case-sensitive, as str.endswith


class UniqueViolation(RuntimeError):
    """A batch would break the target's unique key; nothing was written."""


# --- P6 / S10 ----------------------------------------------------------------

def eq_filter(df: DataFrame, query: dict[str, Any], null_safe: bool = False,
              drop: tuple[str, ...] = ("_id",), missing_as_null: bool = False) -> DataFrame:
    """Rows matching every ``column == value`` of ``query``; ``{}`` keeps all.

    SQL semantics by default (``k = NULL`` matches nothing, as the relational
    store); ``null_safe=True`` gives ``None == None`` (file store); adding
    ``missing_as_null=True`` treats a field absent from the schema as NULL
    (document store: ``{k: None}`` matches records without ``k``). The
    predicate is a plain conjunction, so it is pushed into the scan."""
    conds: list[Column] = []
    for k, v in query.items():
        if k not in df.columns:
            if not missing_as_null:
                raise KeyError(f"no field {k!r}")
            c = F.lit(None)
        else:
            c = F.col(k)
        conds.append(c.eqNullSafe(F.lit(v)) if null_safe else c == F.lit(v))
    out = df.where(reduce(lambda a, b: a & b, conds)) if conds else df
    return out.drop(*[c for c in drop if c in out.columns])


# --- S9 / S11 ------------------------------------------------------------------

def unique_violations(batch: DataFrame, target: DataFrame | None, key: str) -> DataFrame:
    """Keys of ``batch`` that repeat inside the batch or already exist in the
    target: ``key, n_in_batch, in_target``. NULL keys never collide, as under a UNIQUE
    column. The batch keys are counted with
    partial aggregation; the target is first cut to the batch's keys by a
    semi join (broadcast when the batch-key side is small, else a runtime
    filter on the target scan), so an append never shuffles every key of a
    large target."""
    counts = batch.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n_in_batch"))
    if target is None:
        return counts.where(F.col("n_in_batch") > 1).withColumn("in_target", F.lit(False))
    existing = target.select(key).where(F.col(key).isNotNull()) \
        .join(counts.select(key), key, "left_semi").distinct().withColumn("in_target", F.lit(True))
    joined = counts.join(existing, key, "left").withColumn(
        "in_target", F.coalesce(F.col("in_target"), F.lit(False)))
    return joined.where((F.col("n_in_batch") > 1) | F.col("in_target"))


def append_unique_to(batch: DataFrame, existing: DataFrame | None, key: str,
                     write: Callable[[DataFrame], None], report: Callable[[DataFrame], None] | None = None) -> None:
    """S9 for any target: ``existing`` reads the target (e.g. ``spark.read.jdbc``)
    and ``write`` appends to it (e.g. ``df.write.jdbc(..., mode="append")``).
    Raises and writes nothing when ``key`` would repeat inside the batch or
    collide with the target. The error names the number of such keys and the first few;
    ``report`` gets all of them."""
    bad = unique_violations(batch, existing, key)
    if report is not None and not bad.isEmpty():
        report(bad)
    some = bad.orderBy(key).limit(5).collect()
    if some:
        raise UniqueViolation(f"{key} not unique: {bad.count()} keys, first "
                              + ", ".join(str(r[key]) for r in some))
    write(batch)


def append_unique(spark: SparkSession, batch: DataFrame, path: str, key: str,
                  fmt: str = "parquet") -> None:
    """Append ``batch`` to the table at ``path`` only if ``key`` stays
    unique; otherwise raise and write nothing (the transaction rollback of
    the relational store). All offending keys are then listed in ``<path>_violations``."""
    append_unique_to(batch, _read_if_exists(spark, path, fmt), key,
                     lambda df: df.write.mode("append").format(fmt).save(path),
                     lambda df: df.write.mode("overwrite").format(fmt).save(path.rstrip("/") + "_violations"))


def append(batch: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Plain append; an empty batch writes nothing."""
    if batch.isEmpty():
        return
    batch.write.mode("append").format(fmt).save(path)


def _read_if_exists(spark: SparkSession, path: str, fmt: str) -> DataFrame | None:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(hpath):
        return None
    return spark.read.format(fmt).load(path)


# --- J3 / ST4 -----------------------------------------------------------------

STATE_BROADCAST_ROWS = 100_000      # channels; a row is a name and a number, so some ten megabytes at most


def new_since(messages: DataFrame, state: DataFrame, channel: str = "channel",
              msg_id: str = "id") -> DataFrame:
    """Messages above their channel's saved mark (no mark -> 0).

    The state has one row per channel. Up to ``STATE_BROADCAST_ROWS`` rows, counted first, it is broadcast,
    so messages are not shuffled on their few channel values; beyond that, the join
    is a shuffle that AQE splits where a channel is large."""
    st = state.select(F.col(channel).alias("_st_ch"), F.col("last_id").alias("_last"))
    if st.limit(STATE_BROADCAST_ROWS + 1).count() <= STATE_BROADCAST_ROWS:
        st = F.broadcast(st)
    j = messages.join(st, messages[channel] == F.col("_st_ch"), "left")
    return j.where(F.col(msg_id) > F.coalesce(F.col("_last"), F.lit(0))).drop("_st_ch", "_last")


def save_marks(spark: SparkSession, marks: DataFrame, path: str) -> None:
    """Store the marks as the next version under ``path``; readers see the old version until it is complete."""
    version = _versions(spark, path)[-1:] or [0]
    marks.write.parquet(f"{path.rstrip('/')}/version={version[0] + 1}")


def load_marks(spark: SparkSession, path: str, channel: str = "channel") -> DataFrame:
    """The newest complete version of the stored marks; no version: no marks."""
    versions = _versions(spark, path)
    if not versions:
        return spark.createDataFrame([], LAST_ID).withColumnRenamed("channel", channel)
    return spark.read.parquet(f"{path.rstrip('/')}/version={versions[-1]}")


def _versions(spark: SparkSession, path: str) -> list[int]:
    jvm = spark.sparkContext._jvm
    done = jvm.org.apache.hadoop.fs.Path(path.rstrip("/") + "/version=*/_SUCCESS")
    fs = done.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.globStatus(done) or []
    return sorted(int(f.getPath().getParent().getName().split("=")[1]) for f in found)


def load_new(spark: SparkSession, messages: DataFrame, marks_path: str, write: Callable[[DataFrame], None],
             channel: str = "channel", msg_id: str = "id") -> DataFrame:
    """J3 + ST4 for any sink: rows above the stored marks are fixed in the shared folder first, handed to ``write``, and
    the marks advance by the same rows, whatever the source does meanwhile. A run that fails in between loads
    them again; where rows and marks have to be one commit, use ``commits.load_new``. Returns the new marks with ``n_new``."""
    state = load_marks(spark, marks_path, channel)
    path = shared_path(spark, "fresh")
    new_since(messages, state, channel, msg_id).write.parquet(path)
    fresh = spark.read.schema(messages.schema).parquet(path)
    write(fresh)
    marks = advance_marks(state, fresh, channel, msg_id)
    save_marks(spark, marks, marks_path)
    return load_marks(spark, marks_path, channel)


def advance_marks(state: DataFrame, loaded: DataFrame, channel: str = "channel",
                  msg_id: str = "id") -> DataFrame:
    """New state: per channel ``greatest(old mark, max loaded id)``; channels
    not in this load keep their mark, new channels are added."""
    agg = loaded.groupBy(channel).agg(F.max(msg_id).alias("_mx"), F.count(F.lit(1)).alias("n_new"))
    j = state.select(channel, "last_id").join(agg, channel, "full_outer")
    return j.select(
        channel,
        F.greatest(F.coalesce(F.col("last_id"), F.lit(0)), F.coalesce(F.col("_mx"), F.lit(0)))
        .cast("bigint").alias("last_id"),
        F.coalesce(F.col("n_new"), F.lit(0)).cast("bigint").alias("n_new"))


# --- P10 / N2 / T18 -------------------------------------------------------------

def image_copies(df: DataFrame, path_column: str, output_dir: str, keep: list[str]) -> DataFrame:
    """Image paths of every record whose path list is present: one row per
    ``.jpg/.png/.jpeg`` path with its target ``output_dir/basename``."""
    rows = df.where(F.col(path_column).isNotNull()).select(
        *keep, F.explode(path_column).alias("src"))
    rows = rows.where(F.col("src").rlike(IMAGE_SUFFIX))
    return rows.withColumn("target", F.concat(F.lit(output_dir.rstrip("/") + "/"),
                                              F.regexp_extract("src", r"[^/]*$", 0)))
