"""Session folding in batch and in a stream (A5, ST1-ST5, N6)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from chanlake.functions import dates
from chanlake.plans import fixtures as fx
from chanlake.streaming import members, sessions
from chanlake.plans.catalog._base import _msgs, _work, q, register
from chanlake.plans.catalog.file_queries import MSG_COLS


# --- session folding, batch and stream (A5, ST1-ST5, N6) ---------------------------

SESSION_GAP_HOURS = 6     # smallest per-user gap in events is seconds; 6 h groups real bursts


def _events(spark, sf) -> DataFrame:
    return fx.read_table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def _fold_events(df: DataFrame) -> DataFrame:
    return sessions.fold_sessions(df, ["user_id"], "ts", "event_id", f"{SESSION_GAP_HOURS} hours",
                         texts=["event_type"], firsts=["value"])


def _render_sessions(df: DataFrame) -> DataFrame:
    return df.select("user_id", dates.sql_format("session_start").alias("session_start"),
                     dates.sql_format("session_end").alias("session_end"), "n_messages",
                     F.array_join("message_ids", ",").alias("message_ids"),
                     F.col("event_type").alias("types"), F.col("value").alias("first_value"))


D_SESSIONS = f"""
WITH e AS (SELECT *, CASE WHEN lag(ts) OVER w IS NULL OR ts - lag(ts) OVER w > INTERVAL {SESSION_GAP_HOURS} HOUR
                          THEN 1 ELSE 0 END AS brk
           FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
s AS (SELECT *, sum(brk) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS sid FROM e)
SELECT user_id, min(ts) AS start_ts, max(ts) + INTERVAL {SESSION_GAP_HOURS} HOUR AS end_ts,
  count(*) AS n_messages, string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY ts, event_id) AS message_ids,
  coalesce(string_agg(event_type, chr(10) ORDER BY ts, event_id) FILTER (WHERE event_type <> ''), '') AS types,
  arg_min(value, (ts, event_id)) AS first_value
FROM s GROUP BY user_id, sid"""


def _d_sessions(where: str = "") -> str:
    return f"""
SELECT user_id, strftime(start_ts, '%Y-%m-%d %H:%M:%S') AS session_start,
  strftime(end_ts, '%Y-%m-%d %H:%M:%S') AS session_end, n_messages, message_ids, types, first_value
FROM ({D_SESSIONS}) s {where}"""


register("session_fold", _d_sessions())(
    lambda spark, sf: _render_sessions(_fold_events(_events(spark, sf))))

STREAM_CHANNELS = ("chan0", "chan2", "chan3", "chan5")


def _stream_messages(spark, sf):
    m = _msgs(spark, sf).select(*MSG_COLS)
    landing, sink, ckpt = _work(spark, "landing_msgs"), _work(spark, "sink_msgs"), _work(spark, "ckpt_msgs")
    m.write.mode("overwrite").json(landing)
    s = sessions.subscribe(sessions.read_landed(spark, landing, m.schema, fmt="json", max_files=2),
                           STREAM_CHANNELS)
    sessions.write_append(s, sink, ckpt).awaitTermination()
    return spark.read.schema(m.schema).parquet(sink)


register("stream_messages", f"""
SELECT {', '.join(MSG_COLS)} FROM {fx.for_duck(fx.msgs)} m
WHERE channel IN ({', '.join(q(c) for c in STREAM_CHANNELS)})""")(_stream_messages)


def _stream_session(spark, sf):
    """ST2-ST5 over landed events: closed sessions once the watermark passes."""
    ev = fx.read_table(spark, sf, "events")
    landing, sink, ckpt = _work(spark, "landing_events"), _work(spark, "sink_sessions"), _work(spark, "ckpt_sessions")
    ev.write.mode("overwrite").parquet(landing)
    sessions.run_session_stream(spark, landing, ev.schema, sink, ckpt, ["user_id"], "ts", "event_id",
                                f"{SESSION_GAP_HOURS} hours", f"{STREAM_LATENESS_HOURS} hour",
                                texts=["event_type"], firsts=["value"]).awaitTermination()
    return _render_sessions(spark.read.parquet(sink))


STREAM_LATENESS_HOURS = 1

# All landed files form one micro-batch (no late rows to drop); the batch that
# follows moves the watermark to max(ts) - lateness, and append mode emits
# every session whose end is at or before it. Open sessions stay in state.
register("stream_session", _d_sessions(
    f"WHERE end_ts <= (SELECT max(ts) FROM events) - INTERVAL {STREAM_LATENESS_HOURS} HOUR"))(
    _stream_session)


# --- long format: a row a member (ST2, ST3, A5) ---------------------------------------

def _session_members(spark, sf):
    """Sessions of events with one always-active key: every third event belongs to one user."""
    ev = _events(spark, sf).withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(-1)).otherwise(F.col("user_id")))
    out = members.session_members(ev.select("user_id", "ts", "event_id", "value"), ["user_id"], "ts", "event_id",
                                  SESSION_GAP_HOURS * 3600)
    return out.select("user_id", "event_id", F.col("session").alias("session_no"), F.col("place").alias("place_no"), "value")


_D_GAP = f"INTERVAL {SESSION_GAP_HOURS} HOUR"
register("session_members", f"""
WITH e AS (SELECT CASE WHEN event_id % 3 = 0 THEN -1 ELSE user_id END AS user_id, ts, event_id, value FROM events),
b AS (SELECT *, CASE WHEN ts - lag(ts) OVER w > {_D_GAP} THEN 1 ELSE 0 END AS brk
      FROM e WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
s AS (SELECT *, CAST(sum(brk) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS session_no
      FROM b)
SELECT user_id, event_id, session_no,
  row_number() OVER (PARTITION BY user_id, session_no ORDER BY ts, event_id) - 1 AS place_no, value FROM s""")(
    _session_members)

LATE = "event_id % 11 = 0"


def _stream_late_members(spark, sf):
    """ST3: most events arrive in time, then, when the watermark has closed what it can, the others."""
    ev = fx.read_table(spark, sf, "events").select("user_id", "event_id", "ts")
    landing, sink, ckpt = _work(spark, "landing_late"), _work(spark, "sink_late"), _work(spark, "ckpt_late")
    for rows in (f"NOT ({LATE})", LATE):
        ev.where(rows).write.mode("append").parquet(landing)
        stream = members.live_members(sessions.read_landed(spark, landing, ev.schema), ["user_id"], "ts", "event_id",
                                      SESSION_GAP_HOURS * 3600, f"{STREAM_LATENESS_HOURS} hour")
        sessions.write_append(stream, sink, ckpt).awaitTermination()
    return spark.read.parquet(sink).select("user_id", "event_id", F.col("record").alias("record_no"),
                                           F.col("place").alias("place_no"))


register("stream_late_members", f"""
WITH a AS (SELECT user_id, ts, event_id, CASE WHEN ts - lag(ts) OVER w > {_D_GAP} THEN 1 ELSE 0 END AS brk
      FROM events WHERE NOT ({LATE}) WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
intime AS (SELECT user_id, ts, event_id,
      CAST(sum(brk) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS record_no FROM a),
numbered AS (SELECT *, row_number() OVER (PARTITION BY user_id, record_no ORDER BY ts, event_id) - 1 AS place_no FROM intime),
edge AS (SELECT user_id, max(record_no) AS record_no, max(ts) AS last,
           arg_max(place_no, (record_no, place_no)) + 1 AS n,
           max(ts) + {_D_GAP} > (SELECT max(ts) FROM events WHERE NOT ({LATE})) - INTERVAL {STREAM_LATENESS_HOURS} HOUR AS open
         FROM numbered GROUP BY user_id),
late AS (SELECT l.user_id, l.ts, l.event_id, coalesce(e.record_no, -1) AS had, coalesce(e.open, false) AS open, e.last, e.n,
           lag(l.ts) OVER w AS prev FROM events l LEFT JOIN edge e ON e.user_id = l.user_id WHERE l.{LATE}
         WINDOW w AS (PARTITION BY l.user_id ORDER BY l.ts, l.event_id)),
lb AS (SELECT *, CASE WHEN prev IS NULL AND NOT open THEN 1
           WHEN ts - (CASE WHEN open THEN greatest(last, coalesce(prev, last)) ELSE prev END) > {_D_GAP} THEN 1
           ELSE 0 END AS brk FROM late),
lr AS (SELECT *, CAST(sum(brk) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS k FROM lb)
SELECT user_id, event_id, record_no, place_no FROM numbered
UNION ALL SELECT user_id, event_id, had + k AS record_no,
  row_number() OVER (PARTITION BY user_id, k ORDER BY ts, event_id) - 1 + CASE WHEN k = 0 THEN n ELSE 0 END AS place_no
FROM lr""")(_stream_late_members)
