"""The warehouse models (P1-P5, D1, W1, A2-A4, N1, U1, P11) and their graph
(M1), materialisation (M2) and the run-then-test gate (M3).

Each model is a function ``DataFrame(s) -> DataFrame``. ``build`` wires them
in dependency order inside one session; nothing runs until an action, so
Catalyst sees (and prunes) the whole chain at once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chanlake.functions import arrays, dates, text
from chanlake.operators.dedupe import keep_latest

PASS_THROUGH = ("business_name", "phone_number", "address")


# --- per-group chain -------------------------------------------------------

def stg_telegram(raw_data: DataFrame) -> DataFrame:
    """P1 + T12: staging projection; links are every ``https?://`` match.
    Business columns pass through when the source has them."""
    extra = [c for c in PASS_THROUGH if c in raw_data.columns]
    return raw_data.select(
        F.col("_id").alias("raw_id"), "group_id", "message_ids", "message_text", "sender",
        "scraped_date", "media_paths", text.sql_links("message_text").alias("links"), *extra)


def dim_businesses(stg: DataFrame) -> DataFrame:
    """A4 + P5: distinct businesses with a name."""
    return (stg.where(F.col("business_name").isNotNull())
            .select("group_id", "business_name", "phone_number", "address").distinct())


def fact_business_interactions(stg: DataFrame) -> DataFrame:
    """Ids, media paths and links unnested in lockstep (padded with NULL)."""
    return arrays.unnest_lockstep(
        stg, {"message_ids": "message_id", "media_paths": "media_path", "links": "extracted_link"},
        keep=["group_id", "message_text", "scraped_date"],
    ).select("group_id", "message_id", "message_text", "media_path", "extracted_link",
             "scraped_date")


def transformed_telegram_data(stg: DataFrame) -> DataFrame:
    """A3: per (group_id, sender), the distinct arrays (sorted), greatest text
    and greatest date."""
    return stg.groupBy("group_id", "sender").agg(
        arrays.distinct_arrays("message_ids").alias("message_ids"),
        F.max("message_text").alias("message_text"),
        F.max("scraped_date").alias("scraped_date"),
        arrays.distinct_arrays("media_paths").alias("media_paths"),
        arrays.distinct_arrays("links").alias("links"),
    ).select("group_id", "message_ids", "message_text", "sender", "scraped_date",
             "media_paths", "links")


def cleaned_data(raw_data_flat: DataFrame) -> DataFrame:
    """A2: per group and business attributes, ordered arrays that keep NULL
    elements (as Postgres ``ARRAY_AGG`` does) and the greatest text. The three arrays are
    aligned: position i of each comes from the same message row."""
    keys = ["group_id", "business_name", "phone_number", "address", "scraped_date"]
    return raw_data_flat.groupBy(*keys).agg(
        arrays.ordered_lists(["message_id"], ["message_id", "media_path", "link"]).alias("lists"),
        F.max("message_text").alias("message_text"),
    ).select("group_id", F.col("lists.message_id").alias("message_ids"), "message_text",
             F.col("lists.media_path").alias("media_paths"), F.col("lists.link").alias("links"), *keys[1:])


# --- per-message chain -----------------------------------------------------

def clean_messages(stg_messages: DataFrame) -> DataFrame:
    """Trim text (spaces only, as SQL TRIM), default media, drop NULL text."""
    return stg_messages.where(F.col("message_text").isNotNull()).select(
        "message_id", "sender_id", F.trim("message_text").alias("message_text"), "message_date",
        F.coalesce(F.col("media_path"), F.lit("No Media")).alias("media_path"), "channel")


def remove_duplicates(cleaned: DataFrame) -> DataFrame:
    """Newest row per message id (``DESC`` with NULL first, as Postgres)."""
    return keep_latest(cleaned, "message_id", "message_date", nulls_first=True,
                       tiebreak=["message_text", "sender_id", "media_path", "channel"])


def handle_missing(dedup: DataFrame) -> DataFrame:
    """Defaults for sender, text and media."""
    return dedup.select(
        "message_id",
        F.coalesce(F.col("sender_id").cast("string"), F.lit("Unknown Sender")).alias("sender_id"),
        F.coalesce(F.col("message_text"), F.lit("No Text")).alias("message_text"),
        "message_date",
        F.coalesce(F.col("media_path"), F.lit("No Media")).alias("media_path"),
        "channel")


def standardize_formats(filled: DataFrame) -> DataFrame:
    """P4 + D1: lower-case trimmed text, parsed timestamp (NULL when malformed)."""
    return filled.select(
        "message_id", "sender_id", F.lower(F.trim("message_text")).alias("message_text"),
        dates.parse_sql_timestamp("message_date").alias("formatted_date"),
        "media_path", "channel")


# --- example models --------------------------------------------------------

def my_first_dbt_model(spark: SparkSession) -> DataFrame:
    """Two literal rows, ``1`` and NULL."""
    return spark.sql("SELECT 1 AS id UNION ALL SELECT CAST(NULL AS INT) AS id")


def my_second_dbt_model(first: DataFrame) -> DataFrame:
    """Equality with a constant."""
    return first.where(F.col("id") == 1)


# --- graph (M1) ------------------------------------------------------------

# model name -> (inputs, function); inputs name sources or earlier models
GRAPH: dict[str, tuple[tuple[str, ...], Callable[..., DataFrame]]] = {
    "stg_telegram": (("raw_data",), stg_telegram),
    "dim_businesses": (("stg_telegram",), dim_businesses),
    "fact_business_interactions": (("stg_telegram",), fact_business_interactions),
    "transformed_telegram_data": (("stg_telegram",), transformed_telegram_data),
    "cleaned_data": (("raw_data_flat",), cleaned_data),
    "clean_messages": (("stg_telegram_messages",), clean_messages),
    "remove_duplicates": (("clean_messages",), remove_duplicates),
    "handle_missing": (("remove_duplicates",), handle_missing),
    "standardized": (("handle_missing",), standardize_formats),
}


def build(sources: dict[str, DataFrame], models: list[str] | None = None) -> dict[str, DataFrame]:
    """Build the requested models (default all whose sources are given), in
    dependency order. Returns lazy DataFrames keyed by model name."""
    out: dict[str, DataFrame] = dict(sources)
    wanted = models or list(GRAPH)
    done: dict[str, DataFrame] = {}

    def make(name: str) -> DataFrame:
        if name in out:
            return out[name]
        if name not in GRAPH:
            raise KeyError(f"unknown model or missing source: {name}")
        inputs, fn = GRAPH[name]
        out[name] = fn(*[make(i) for i in inputs])
        done[name] = out[name]
        return out[name]

    for name in wanted:
        inputs, _ = GRAPH[name]
        if models is None and not all(_resolvable(i, sources) for i in inputs):
            continue
        make(name)
    return done


def _resolvable(name: str, sources: dict[str, DataFrame]) -> bool:
    if name in sources:
        return True
    return name in GRAPH and all(_resolvable(i, sources) for i in GRAPH[name][0])


def store_model(spark: SparkSession, name: str, df: DataFrame, kind: str, location: str | None) -> DataFrame:
    """M2, one model: ``view`` -> temp view; ``table`` -> parquet under ``location`` (a shared folder), read
    back; ``catalog`` -> the same files registered as an external catalog table, visible to later sessions."""
    if kind not in ("view", "table", "catalog"):
        raise ValueError(f"unknown materialisation: {kind}")
    if kind != "view":
        if location is None:
            raise ValueError(f"a {kind} materialisation needs a location")
        path = f"{location.rstrip('/')}/{name}"
        writer = df.write.mode("overwrite").format("parquet")
        if kind == "catalog":
            writer.option("path", path).saveAsTable(name)
            return spark.table(name)
        writer.save(path)
        df = spark.read.schema(df.schema).parquet(path)
    df.createOrReplaceTempView(name)
    return df


def materialize(spark: SparkSession, models: dict[str, DataFrame], how: dict[str, str] | None = None,
                location: str | None = None) -> dict[str, DataFrame]:
    """M2 for frames that are already built (default ``view``); ``build_stored`` walks the graph instead."""
    return {name: store_model(spark, name, df, (how or {}).get(name, "view"), location) for name, df in models.items()}


def build_stored(spark: SparkSession, sources: dict[str, DataFrame], location: str | None,
                 how: dict[str, str] | None = None, models: list[str] | None = None) -> dict[str, DataFrame]:
    """M1 + M2 along the graph: parents are stored first and children read the stored frame, so every raw source
    and every model is computed once however many children it has (default ``table``)."""
    frames, done = dict(sources), {}

    def make(name: str) -> DataFrame:
        if name not in frames:
            if name not in GRAPH:
                raise KeyError(f"unknown model or missing source: {name}")
            inputs, fn = GRAPH[name]
            df = fn(*[make(i) for i in inputs])
            frames[name] = done[name] = store_model(spark, name, df, (how or {}).get(name, "table"), location)
        return frames[name]

    for name in models or list(GRAPH):
        if models is not None or all(_resolvable(i, sources) for i in GRAPH[name][0]):
            make(name)
    return done


REPORT = "_data_tests"


def run(spark: SparkSession, sources: dict[str, DataFrame], location: str,
        how: dict[str, str] | None = None, tests=None) -> DataFrame:
    """M3: build and store every model along the graph, run the data tests on the stored rows, store the
    report under ``location`` and only then raise if any test fails. Returns the stored report."""
    from chanlake.operators import quality
    from chanlake.session import estimated_bytes, size_shuffle_partitions
    sizes = [estimated_bytes(df) for df in sources.values()]
    previous = spark.conf.get("spark.sql.shuffle.partitions")
    size_shuffle_partitions(spark, None if None in sizes else sum(sizes))
    try:
        models = build_stored(spark, sources, location, how)
        path = f"{location.rstrip('/')}/{REPORT}"
        quality.run_tests(models, tests or quality.DECLARED_TESTS).write.mode("overwrite").parquet(path)
        return quality.gate(spark.read.parquet(path))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", previous)
