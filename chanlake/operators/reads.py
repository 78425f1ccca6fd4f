"""Served reads (P7, P8, P12, P14, N4, L1-L3) and the frame profile.

Each read is a filter plus an ordered limit; Spark plans
``TakeOrderedAndProject`` (a per-partition top-n then a merge), so a read
never sorts the whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_LIMIT = 10


def _limit(df: DataFrame, order_by: str, limit: int | None) -> DataFrame:
    return df.orderBy(order_by).limit(limit) if limit is not None else df


def scraped_rows(df: DataFrame, limit: int | None = DEFAULT_LIMIT, order_by: str = "_id") -> DataFrame:
    """L1 + P12: the raw scraped records, first ``limit`` by ``order_by``,
    with the document id rendered as a string."""
    return _limit(df, order_by, limit).withColumn(order_by, F.col(order_by).cast("string"))


def regex_filter(df: DataFrame, column: str, pattern: str | None, limit: int | None = DEFAULT_LIMIT,
                 order_by: str = "id") -> DataFrame:
    """P7 + L1 + P12: case-insensitive regex on ``column`` (blank pattern = all
    rows), ordered by ``order_by``, first ``limit`` rows, id as string."""
    out = df
    if pattern:
        out = out.where(F.col(column).rlike("(?iu)" + pattern))
    out = _limit(out, order_by, limit)
    return out.withColumn(order_by, F.col(order_by).cast("string"))


def detection_filter(df: DataFrame, pattern: str | None, limit: int | None = DEFAULT_LIMIT,
                     order_by: str = "image_path", field: str = "class",
                     column: str = "detections") -> DataFrame:
    """Records with any nested detection whose ``field`` matches the
    case-insensitive regex."""
    out = df
    if pattern:
        out = out.where(F.exists(column, lambda d: d[field].rlike("(?iu)" + pattern)))
    return _limit(out, order_by, limit)


def slice_rows(df: DataFrame, order_by: str, start: int, stop: int) -> DataFrame:
    """L2/L3: rows ``[start:stop]`` of the ordered frame."""
    return df.orderBy(order_by).offset(start).limit(stop - start)


def served_rows(df: DataFrame, limit: int | None = DEFAULT_LIMIT, order_by: str = "id") -> DataFrame:
    """P14 + N4: the served row shape; JSON array columns parse to ``array<string>``, missing -> ``[]``. Rows
    without a ``business_name`` or ``scraped_date`` are returned as they are; the response
    schema of a server has to refuse them (``require_served``)."""
    empty = F.array().cast("array<string>")
    out = df.select(
        F.col("id"), "business_name", "phone_number", "address", "scraped_date",
        F.coalesce(F.from_json("media_paths", "array<string>"), empty).alias("media_paths"),
        F.coalesce(F.from_json("links", "array<string>"), empty).alias("links"))
    return _limit(out, order_by, limit)


def require_served(df: DataFrame) -> DataFrame:
    """Fail on the first served row that lacks a required field, as a validated response does."""
    missing = F.col("business_name").isNull() | F.col("scraped_date").isNull()
    checked = F.when(missing, F.raise_error(F.concat(F.lit("required field missing in row "), F.col("id").cast("string"))))
    return df.withColumn("id", F.coalesce(checked.cast(df.schema["id"].dataType), F.col("id")))


def profile(df: DataFrame) -> DataFrame:
    """``info()``/``shape``: per column its type, non-null count and the
    row count, from one aggregate pass, unpivoted with ``stack``."""
    cols = df.columns
    agg = df.agg(F.count(F.lit(1)).alias("_rows"),
                 *[F.count(F.col(c)).alias(f"_nn{i}") for i, c in enumerate(cols)])
    pairs = ", ".join(f"'{c}', '{df.schema[c].dataType.simpleString()}', _nn{i}"
                      for i, c in enumerate(cols))
    return agg.selectExpr(f"stack({len(cols)}, {pairs}) AS (column, dtype, non_null)", "_rows") \
        .withColumnRenamed("_rows", "rows")
