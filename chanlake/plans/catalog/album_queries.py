"""Albums, media and stores."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from chanlake.operators import albums, dedupe
from chanlake.plans import cleaning, fixtures as fx
from chanlake.sources import commits, store
from chanlake.plans.catalog._base import ORACLES, _msgs, _work, register


# --- albums, media and stores (P9, P10, P15, P16, A1, J1-J3, W2, S9) --------------


D_GKEY = "coalesce(CASE WHEN grouped_id <> 0 THEN grouped_id END, message_id)"


def _d_first_truthy(v: str, falsy: str) -> str:
    return (f"list({v} ORDER BY ({falsy}), CASE WHEN {falsy} THEN message_id "
            f"ELSE -message_id END)[1]")


def d_albums(src: str, extra: str = "") -> str:
    """DuckDB album fold over a per-message relation ``src``."""
    return f"""
SELECT channel, {D_GKEY} AS group_id,
  list(message_id ORDER BY message_id DESC) AS message_ids,
  {_d_first_truthy('message_text', "message_text IS NULL OR message_text = ''")} AS text,
  {_d_first_truthy('raw_message', "raw_message IS NULL OR raw_message = ''")} AS message,
  (list(message_date ORDER BY message_id DESC) FILTER (WHERE message_date IS NOT NULL))[1] AS date,
  {_d_first_truthy('sender_id', "sender_id IS NULL OR sender_id = 0")} AS sender_id,
  CAST(count(media_kind) AS BIGINT) AS media_slots{extra}
FROM {src} m GROUP BY 1, 2"""


D_ALBUMS = d_albums(fx.for_duck(fx.msgs))


def _albums(spark, sf) -> DataFrame:
    return albums.fold_albums(_msgs(spark, sf), msg_id="message_id", text="message_text",
                              message="raw_message", date="message_date",
                              has_media=F.col("media_kind").isNotNull())


register("album_group", f"""
SELECT channel, group_id, array_to_string(message_ids, ',') AS message_ids, text, message, date,
  sender_id, media_slots FROM ({D_ALBUMS}) a""")(
    lambda spark, sf: _albums(spark, sf).withColumn("message_ids", F.array_join("message_ids", ",")))

register("album_filter", f"""
SELECT channel, group_id, CAST(len(message_ids) AS INTEGER) AS n_messages
FROM ({D_ALBUMS}) a WHERE len(message_ids) > 1""")(
    lambda spark, sf: albums.albums_only(
        _albums(spark, sf)).select("channel", "group_id", F.size("message_ids").alias("n_messages")))


# One path per message: failed downloads out, the greatest path of several.
D_MEDIA = (f"(SELECT channel, id, max(path) AS path FROM {fx.for_duck(fx.media)} dl WHERE path IS NOT NULL "
           "GROUP BY channel, id)")


def _media_attach(spark, sf):
    out = albums.attach_media(_msgs(spark, sf), fx.for_spark(spark, sf, fx.media), msg_id="message_id")
    return out.select("channel", "group_id", F.array_join("media_paths", ",").alias("media_paths"))


register("media_attach", f"""
SELECT m.channel, {D_GKEY.replace('grouped_id', 'm.grouped_id').replace('message_id', 'm.message_id')} AS group_id,
  array_to_string(coalesce(list(md.path ORDER BY m.message_id DESC) FILTER (WHERE md.path IS NOT NULL),
    CAST([] AS VARCHAR[])), ',') AS media_paths
FROM {fx.for_duck(fx.msgs)} m LEFT JOIN {D_MEDIA} md
  ON m.channel = md.channel AND m.message_id = md.id
GROUP BY 1, 2""")(_media_attach)

NEWEST_N = 10     # messages per channel and run in the scraper's main


def _newest(spark, sf):
    out = albums.newest_per_channel(_msgs(spark, sf), NEWEST_N, msg_id="message_id")
    return out.select("channel", "message_id", F.col("rank").cast("bigint").alias("rank"))


register("newest_per_channel", f"""
SELECT channel, message_id, rank FROM (
  SELECT channel, message_id, row_number() OVER (PARTITION BY channel ORDER BY message_id DESC) AS rank
  FROM {fx.for_duck(fx.msgs)} m) r WHERE rank <= {NEWEST_N}""")(_newest)

# Saved marks: channels 0-4 have one (a message id inside their range),
# channels 5 and 6 have none and start from 0.
STATE_SQL = """SELECT channel, CAST(max(message_id) - 250 AS BIGINT) AS last_id FROM {m} s
WHERE channel NOT IN ('chan5', 'chan6') GROUP BY channel"""


def _incremental(spark, sf):
    m = _msgs(spark, sf)
    state = spark.sql(STATE_SQL, m=m)
    loaded = store.new_since(m, state, msg_id="message_id")
    return store.advance_marks(state, loaded, msg_id="message_id")


register("incremental_load", f"""
WITH m AS {fx.for_duck(fx.msgs)}, st AS ({STATE_SQL.format(m='m')}),
new AS (SELECT m.channel, m.message_id FROM m LEFT JOIN st ON m.channel = st.channel
        WHERE m.message_id > coalesce(st.last_id, 0)),
agg AS (SELECT channel, max(message_id) AS mx, count(*) AS n FROM new GROUP BY channel)
SELECT coalesce(st.channel, agg.channel) AS channel,
  CAST(greatest(coalesce(st.last_id, 0), coalesce(agg.mx, 0)) AS BIGINT) AS last_id,
  CAST(coalesce(agg.n, 0) AS BIGINT) AS n_new
FROM st FULL OUTER JOIN agg ON st.channel = agg.channel""")(_incremental)


def _unique_append(spark, sf):
    batch = _msgs(spark, sf).select(albums.group_key("grouped_id", "message_id").alias("group_id"))
    target = fx.for_spark(spark, sf, fx.raw_data)
    return store.unique_violations(batch, target, "group_id")


register("unique_append", f"""
WITH b AS (SELECT {D_GKEY} AS group_id FROM {fx.for_duck(fx.msgs)} m),
bc AS (SELECT group_id, count(*) AS n_in_batch FROM b GROUP BY group_id),
t AS (SELECT DISTINCT group_id FROM {fx.for_duck(fx.raw_data)} r WHERE group_id IS NOT NULL)
SELECT bc.group_id, CAST(bc.n_in_batch AS BIGINT) AS n_in_batch, (t.group_id IS NOT NULL) AS in_target
FROM bc LEFT JOIN t ON bc.group_id = t.group_id
WHERE bc.n_in_batch > 1 OR t.group_id IS NOT NULL""")(_unique_append)


def _append_runs(spark, sf):
    """S9 + S11 on a stored table: a first batch, an empty append, a second batch, a batch that is
    rejected whole, and rows without key (never a collision); the table as it is then."""
    m = _msgs(spark, sf).select("message_id", "channel", "message_text")
    path = _work(spark, "messages")
    store.append_unique(spark, m.where("message_id % 2 = 0"), path, "message_id")
    store.append(m.where("message_id < 0"), path)
    store.append_unique(spark, m.where("message_id % 2 = 1"), path, "message_id")
    try:
        store.append_unique(spark, m.where("channel = 'chan1'"), path, "message_id")
    except store.UniqueViolation:
        pass
    store.append_unique(spark, m.where("channel = 'chan2'").withColumn("message_id", F.lit(None).cast("bigint")), path,
                        "message_id")
    return spark.read.schema(m.schema).parquet(path)


register("append_runs", f"""
SELECT message_id, channel, message_text FROM {fx.for_duck(fx.msgs)} m
UNION ALL SELECT NULL, channel, message_text FROM {fx.for_duck(fx.msgs)} m2 WHERE channel = 'chan2'""")(_append_runs)


def _load_runs(spark, sf):
    """J3 + ST4: two runs with stored marks; the second loads only what the first had not seen."""
    m = _msgs(spark, sf).select("channel", "message_id", "conv_id")
    marks, sink = _work(spark, "marks"), _work(spark, "loaded")
    half = f"conv_id < {LOAD_SPLIT}"
    store.load_new(spark, m.where(half), marks, lambda df: df.withColumn("run", F.lit(1)).write.mode("append")
                   .parquet(sink), msg_id="message_id")
    store.load_new(spark, m, marks, lambda df: df.withColumn("run", F.lit(2)).write.mode("append").parquet(sink),
                   msg_id="message_id")
    loaded = spark.read.parquet(sink).groupBy("channel").agg(
        F.count_if(F.col("run") == 1).alias("first_run"), F.count_if(F.col("run") == 2).alias("second_run"))
    return loaded.join(store.load_marks(spark, marks), "channel").select(
        "channel", "first_run", "second_run", "last_id", "n_new")


LOAD_SPLIT = 40
register("load_runs", f"""
WITH m AS {fx.for_duck(fx.msgs)},
one AS (SELECT channel, max(message_id) AS mark FROM m WHERE conv_id < {LOAD_SPLIT} GROUP BY channel),
r AS (SELECT m.channel, m.message_id, m.conv_id < {LOAD_SPLIT} AS first,
        m.message_id > coalesce(one.mark, 0) AS second FROM m LEFT JOIN one USING (channel))
SELECT channel, count_if(first) AS first_run, count_if(second) AS second_run, max(message_id) AS last_id,
  count_if(second) AS n_new FROM r GROUP BY channel""")(_load_runs)


def _commit_append(spark, sf):
    """S9 as commits: even ids, odd ids in two batches, a batch that collides and one that repeats a key (both refused),
    rows without key; the committed rows."""
    m = _msgs(spark, sf).select("message_id", "channel", "message_text")
    path = _work(spark, "unique")
    for part in ("message_id % 2 = 0", "message_id % 4 = 1", "message_id % 4 = 3"):
        commits.append_unique(spark, m.where(part), path, "message_id")
    for bad in (m.where("channel = 'chan1'"), m.where("message_id % 3 = 0").withColumn("message_id", F.lit(-1).cast("bigint"))):
        try:
            commits.append_unique(spark, bad, path, "message_id")
        except store.UniqueViolation:
            pass
    commits.append_unique(spark, m.where("channel = 'chan2'").withColumn("message_id", F.lit(None).cast("bigint")), path,
                          "message_id")
    return commits.read(spark, path)


register("commit_append", ORACLES["append_runs"])(_commit_append)


def _commit_load(spark, sf):
    """J3 + ST4 as commits: a run, a run that dies before its commit, and the run after it."""
    m = _msgs(spark, sf).select("channel", "message_id", "conv_id")
    path = _work(spark, "loads")
    commits.load_new(spark, m.where(f"conv_id < {LOAD_SPLIT}"), path, msg_id="message_id")
    first = commits.snapshot(spark, path)["data"]

    def die():
        raise InterruptedError
    try:
        commits.load_new(spark, m, path, msg_id="message_id", before_commit=die)
    except InterruptedError:
        pass
    marks = commits.load_new(spark, m, path, msg_id="message_id")
    rows = commits.read(spark, path).withColumn("run", F.when(
        F.col("_metadata.file_path").contains(first[0]), 1).otherwise(2))
    loaded = rows.groupBy("channel").agg(
        F.count_if(F.col("run") == 1).alias("first_run"), F.count_if(F.col("run") == 2).alias("second_run"))
    return loaded.join(marks, "channel").select("channel", "first_run", "second_run", "last_id", "n_new")


register("commit_load", ORACLES["load_runs"])(_commit_load)


def _dedupe_id_lists(spark, sf):
    """Newest record per list of message ids (an array key)."""
    a = _albums(spark, sf).select("message_ids", "channel", "date")
    again = a.where(F.size("message_ids") > 1).withColumn("date", F.lit("2023-01-01 00:00:00"))
    out = dedupe.keep_latest(a.unionByName(again), "message_ids", "date", nulls_first=False, tiebreak=["channel"])
    return out.select(F.array_join("message_ids", ",").alias("message_ids"), "channel", "date")


register("dedupe_id_lists", f"""
WITH a AS (SELECT message_ids, channel, date FROM ({D_ALBUMS}) al),
u AS (SELECT * FROM a UNION ALL SELECT message_ids, channel, '2023-01-01 00:00:00' FROM a WHERE len(message_ids) > 1)
SELECT array_to_string(message_ids, ',') AS message_ids, channel, date FROM (
  SELECT DISTINCT ON (message_ids) * FROM u
  ORDER BY message_ids, date DESC NULLS LAST, channel DESC NULLS LAST) d""")(_dedupe_id_lists)


def _standard_columns(spark, sf):
    """Landed field names to column names."""
    landed = _msgs(spark, sf).select(F.col("message_id").alias("Group ID"), F.col("message_text").alias("Message"),
                                     F.col("raw_message").alias("Text"), F.col("sender_id").alias("Sender ID"),
                                     F.col("message_date").alias("Date"), F.col("channel").alias("Channel"))
    out = cleaning.standardize_columns(landed)
    return out.select("group_id", "message", "text", "sender_id", "message_date", F.col("Channel").alias("channel"))


register("standard_columns", f"""
SELECT message_id AS group_id, message_text AS message, raw_message AS text, sender_id, message_date, channel
FROM {fx.for_duck(fx.msgs)} m""")(_standard_columns)

MEDIA_DIR = "media"
ALLOWED_MEDIA = ("photo", "document")


def _media_path_derive(spark, sf):
    return _msgs(spark, sf).select(
        "channel", "message_id",
        albums.media_file_path(MEDIA_DIR, ALLOWED_MEDIA, msg_id="message_id").alias("path"))


register("media_path_derive", f"""
SELECT channel, message_id,
  CASE WHEN media_kind = 'photo' THEN '{MEDIA_DIR}/' || channel || '/' || CAST(message_id AS VARCHAR) || '.jpg'
       WHEN media_kind = 'document' THEN '{MEDIA_DIR}/' || channel || '/' || CAST(message_id AS VARCHAR) || '.'
         || CASE WHEN mime_type IS NULL OR mime_type = '' THEN 'bin' ELSE string_split(mime_type, '/')[-1] END
  END AS path
FROM {fx.for_duck(fx.msgs)} m""")(_media_path_derive)


def _media_paths(spark, sf):
    return store.image_copies(fx.for_spark(spark, sf, fx.raw_data), "media_paths", "out/images",
                              keep=["group_id"])


register("media_paths", f"""
SELECT group_id, src, 'out/images/' || regexp_extract(src, '[^/]*$', 0) AS target FROM (
  SELECT group_id, UNNEST(media_paths) AS src FROM {fx.for_duck(fx.raw_data)} r
  WHERE media_paths IS NOT NULL) x
WHERE regexp_matches(src, '\\.(jpg|png|jpeg)$')""")(_media_paths)
