"""Inactivity folding of live messages (ST1-ST5, A5, N6).

A group closes when no new member arrives for ``gap``. With event time this
is a session window: ``session_window(ts, gap)`` per key. The same fold runs
on a batch DataFrame (``session_fold``) and on a stream (``run_session_stream``),
so the stream can be checked against the batch.

In a stream the window state lives in the state store and is checkpointed
(the reference kept it in process memory and lost it on a crash); append mode
emits a session once the watermark passes its end, and a late member beyond
the watermark is dropped rather than opening a second record.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from chanlake.functions.arrays import join_nonblank

INACTIVITY_GAP = "5 seconds"      # the listener's inactivity gap


def fold_sessions(df: DataFrame, keys: Sequence[str], ts: str, msg_id: str, gap: str,
                  texts: Sequence[str] = (), firsts: Sequence[str] = (),
                  bucket_seconds: int | None = 86400, lists: Sequence[str] = (),
                  pre_aggregate: bool = False) -> DataFrame:
    """One row per (keys, session): ``session_start``, ``session_end`` (last
    arrival + gap), ``n_messages``, ``message_ids`` in arrival order, each of
    ``texts`` as its non-blank values joined by newline, each of ``lists`` as
    its non-NULL values in arrival order, and each of ``firsts`` taken from
    the first arrival.

    Batch input is sessionized inside (keys, day bucket) and the partial sessions are merged per key, so
    a very active key is spread over its days. For dense data (many events per gap)
    ``pre_aggregate`` folds in three exact steps, so such a key does not ship every event either:

    1. events closer than ``gap`` always share a session, so each gap-sized
       time slot is summarised by an ordinary aggregate (first/last time,
       members), which Spark combines map-side before the shuffle;
    2. the slot summaries are merged into sessions inside (keys, day bucket)
       with a session window whose gap is each summary's span plus ``gap``;
    3. those partial sessions are merged per key the same way.

    Without it step 1 is skipped, which saves an exchange where events are mostly more than one gap
    apart. A stream uses the one-step
    fold (Spark merges sessions per partition before its shuffle).
    """
    member_cols = [*texts, *lists]
    if df.isStreaming or not bucket_seconds:
        return _present(_fold_rows(df, keys, ts, msg_id, gap, member_cols, firsts), keys, texts,
                        firsts, lists)
    gap_us = _micros(gap)
    order = F.struct(F.col(ts), F.col(msg_id))
    summary = [F.count(F.lit(1)).alias("_n"), _members(ts, msg_id, member_cols, ordered=False).alias("_m"),
               F.min(ts).alias("_s"), F.max(ts).alias("_l"), F.min(order).alias("_first"),
               *[F.min_by(F.col(c), order).alias(c) for c in firsts]]
    bucket_us = bucket_seconds * 1_000_000
    if pre_aggregate:
        slot = F.floor(F.unix_micros(F.col(ts)) / F.lit(gap_us)).alias("_slot")
        slots = df.groupBy(*keys, slot).agg(*summary)
        bucket = F.floor(F.col("_slot") * F.lit(gap_us) / F.lit(bucket_us)).alias("_bucket")
        per_bucket = _merge_spans(slots, [*keys, bucket], gap_us, firsts)
    else:
        bucket = F.floor(F.unix_micros(F.col(ts)) / F.lit(bucket_us)).alias("_bucket")
        per_bucket = df.groupBy(F.session_window(ts, gap).alias("session"), *keys, bucket).agg(*summary)
    merged = _merge_spans(per_bucket, list(keys), gap_us, firsts)
    return _present(merged.withColumn("_m", F.array_sort("_m")), keys, texts, firsts, lists)


def _merge_spans(parts: DataFrame, group_cols: list, gap_us: int, firsts: Sequence[str]) -> DataFrame:
    """Merge partial sessions ``[_s, _l]`` (with ``_n``, ``_m``, ``_first``):
    a session window over ``_s`` whose gap is the span plus ``gap`` joins two
    parts exactly when the later one starts within ``gap`` of the earlier
    one's last arrival, the rule the event-level fold applies."""
    span_gap = F.expr("make_interval(0, 0, 0, 0, 0, 0, CAST(unix_micros(_l) - unix_micros(_s) + "
                      f"{gap_us} AS DECIMAL(18, 0)) / 1000000)")
    return parts.groupBy(F.session_window("_s", span_gap).alias("session"), *group_cols).agg(
        F.sum("_n").cast("bigint").alias("_n"), F.flatten(F.collect_list("_m")).alias("_m"),
        F.min("_s").alias("_s"), F.max("_l").alias("_l"), F.min("_first").alias("_first"),
        *[F.min_by(F.col(c), F.col("_first")).alias(c) for c in firsts])


def _members(ts: str, msg_id: str, texts: Sequence[str], ordered: bool = True):
    items = F.collect_list(F.struct(
        F.col(ts).alias("_ts"), F.col(msg_id).alias("_id"),
        *[F.col(t).alias(f"_t{i}") for i, t in enumerate(texts)]))
    return F.array_sort(items) if ordered else items


def _fold_rows(df: DataFrame, keys, ts, msg_id, gap, texts, firsts) -> DataFrame:
    order = F.struct(F.col(ts), F.col(msg_id))
    return df.groupBy(F.session_window(ts, gap).alias("session"), *keys).agg(
        F.count(F.lit(1)).alias("n_messages"), _members(ts, msg_id, texts).alias("_m"),
        *[F.min_by(F.col(c), order).alias(c) for c in firsts])


def _present(g: DataFrame, keys, texts, firsts, lists=()) -> DataFrame:
    n = len(texts)
    if "_n" in g.columns:
        g = g.withColumnRenamed("_n", "n_messages")
    return g.select(
        *keys, F.col("session.start").alias("session_start"), F.col("session.end").alias("session_end"),
        "n_messages", F.transform("_m", lambda m: m["_id"]).alias("message_ids"),
        *[join_nonblank(F.transform("_m", _field(f"_t{i}"))).alias(t) for i, t in enumerate(texts)],
        *[F.filter(F.transform("_m", _field(f"_t{n + i}")), lambda v: v.isNotNull()).alias(c)
          for i, c in enumerate(lists)],
        *firsts)


_UNIT_US = {"microsecond": 1, "millisecond": 1000, "second": 1_000_000, "minute": 60_000_000,
            "hour": 3_600_000_000, "day": 86_400_000_000}


def _micros(duration: str) -> int:
    """'6 hours' -> microseconds (a session gap is a fixed duration)."""
    n, unit = duration.split()
    return int(float(n) * _UNIT_US[unit.lower().rstrip("s")])


def _field(name: str):
    # one-parameter lambda: a second parameter would receive the index
    return lambda m: m[name]


def subscribe(stream: DataFrame, channels: Sequence[str], channel: str = "channel") -> DataFrame:
    """ST1: only messages of the listed channels."""
    return stream.where(F.col(channel).isin(*channels))


def read_landed(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                max_files: int | None = None) -> DataFrame:
    """Stream of landed message files (the client itself is not built)."""
    r = spark.readStream.schema(schema).format(fmt)
    if max_files:
        r = r.option("maxFilesPerTrigger", str(max_files))
    return r.load(path)


def read_kafka(spark: SparkSession, servers: str, topic: str, schema: T.StructType) -> DataFrame:
    """Stream of JSON messages from a Kafka topic (ST1 with a broker instead
    of landed files). Needs the Spark Kafka connector on the classpath; the
    value is decoded with ``from_json`` against the declared schema."""
    raw = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
           .option("subscribe", topic).option("startingOffsets", "earliest").load())
    return raw.select(F.from_json(F.col("value").cast("string"), schema).alias("m")).select("m.*")


def with_event_time(stream: DataFrame, ts: str, lateness: str) -> DataFrame:
    """Watermark on an event-time column (NTZ is cast: watermarks need TIMESTAMP). A value that is no
    time becomes NULL and joins no session; ``without_time`` gives those rows to a side sink."""
    return stream.withColumn(ts, F.col(ts).try_cast("timestamp")).withWatermark(ts, lateness)


def without_time(stream: DataFrame, ts: str) -> DataFrame:
    """Rows whose event time cannot be read, as they landed."""
    return stream.where(F.col(ts).try_cast("timestamp").isNull())


def late_members(landed: DataFrame, folded: DataFrame, keys: Sequence[str], msg_id: str,
                 ids: str = "message_ids") -> DataFrame:
    """Batch check of a finished run: landed rows whose key has closed records but that are in none of them
    (members that came after the watermark). The rows to re-fold or to keep beside the records."""
    seen = folded.select(*keys, F.explode(ids).alias(msg_id))
    closed = folded.select(*keys).distinct()
    return landed.join(closed, list(keys), "left_semi").join(seen, [*keys, msg_id], "left_anti")


def write_append(out: DataFrame, sink_path: str, checkpoint: str, fmt: str = "parquet",
                 available_now: bool = True) -> StreamingQuery:
    """ST5: append closed records to a file sink (exactly once via the sink
    log and the checkpoint in a shared folder)."""
    w = out.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="5 seconds")
    return w.start(sink_path)


def run_session_stream(spark: SparkSession, source: str, schema: T.StructType, sink: str,
                       checkpoint: str, keys: Sequence[str], ts: str, msg_id: str, gap: str,
                       lateness: str, texts: Sequence[str] = (), firsts: Sequence[str] = (),
                       fmt: str = "parquet", max_files: int | None = None) -> StreamingQuery:
    """ST2-ST5 end to end: landed files -> watermark -> session fold -> sink."""
    s = with_event_time(read_landed(spark, source, schema, fmt, max_files), ts, lateness)
    out = fold_sessions(s, keys, ts, msg_id, gap, texts, firsts)
    return write_append(out, sink, checkpoint)


def fold_live_albums(messages: DataFrame, gap: str = INACTIVITY_GAP, channel: str = "channel",
                     msg_id: str = "id", grouped_id: str = "grouped_id", ts: str = "date",
                     message: str = "message", text: str = "text", sender_id: str = "sender_id",
                     media_path: str | None = None, bucket_seconds: int | None = 86400) -> DataFrame:
    """ST2 for messages (batch or stream): members of one album that arrive
    with no pause longer than ``gap`` fold into one record: ``message_ids`` in
    arrival order, ``message``/``text`` as the non-blank values joined by
    newline, ``sender_id`` of the first arrival, ``session_start`` its date,
    and with ``media_path`` (a per-message downloaded path, NULL when none or
    failed) the album's paths in arrival order."""
    from chanlake.operators.albums import group_key
    keyed = messages.withColumn("group_id", group_key(grouped_id, msg_id))
    return fold_sessions(keyed, [channel, "group_id"], ts, msg_id, gap, texts=[message, text],
                         firsts=[sender_id], bucket_seconds=bucket_seconds,
                         lists=[media_path] if media_path else [])
