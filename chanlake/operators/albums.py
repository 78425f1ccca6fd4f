"""Album folding and media attachment for scraped messages (P16, A1, J1, J2,
W2, P9, P15).

Messages of one album share ``grouped_id``; a message outside an album is its
own group. The scraper walks a channel newest first and folds each group into
one record. Here that walk order is a sort key (``-id``), and each "first
truthy, else last seen" field is a ``min_by`` over an ordering that ranks
truthy values first: a declarative aggregate with a partial (map-side) step,
so hot groups are combined before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def group_key(grouped_id: str = "grouped_id", msg_id: str = "id") -> Column:
    """``grouped_id`` when truthy (not NULL, not 0), else the message id."""
    g = F.col(grouped_id)
    return F.coalesce(F.when(g != 0, g), F.col(msg_id))


def _truthy(c: Column, kind: str) -> Column:
    if kind == "text":
        return c.isNotNull() & (c != F.lit(""))
    return c.isNotNull() & (c != F.lit(0))


def first_truthy(value: str, walk: Column, kind: str = "text") -> Column:
    """Value of the first row (in walk order) whose value is truthy; if none,
    the value of the last row walked (Python's ``acc or value`` fold)."""
    v = F.col(value)
    t = _truthy(v, kind)
    ordering = F.struct((~t).alias("falsy"), F.when(t, walk).otherwise(-walk).alias("pos"))
    return F.min_by(v, ordering)


def fold_albums(messages: DataFrame, channel: str = "channel", msg_id: str = "id",
                grouped_id: str = "grouped_id", text: str = "text", message: str = "message",
                date: str = "date", sender_id: str = "sender_id",
                has_media: Column | None = None, media_path: str | None = None) -> DataFrame:
    """A1: one record per ``(channel, group)``.

    Output: ``channel, group_id, message_ids`` (walk order, newest first),
    ``text, message, sender_id`` (first truthy, else last walked), ``date``
    (first non-null), ``media_slots`` (messages that carry media).
    Keyed by channel too: a fallback key is a message id, which is only
    unique inside a channel. With ``media_path`` (a per-message downloaded
    path, NULL when absent or failed) the record also gets ``media_paths``
    in walk order (J1/J2).
    """
    walk = -F.col(msg_id)          # the API yields newest (largest id) first
    d = F.col(date)
    media_flag = has_media if has_media is not None else F.lit(False)
    keyed = messages.withColumn("group_id", group_key(grouped_id, msg_id))
    extra = []
    if media_path is not None:
        p = F.col(media_path)
        hits = F.collect_list(F.when(p.isNotNull(), F.struct(walk.alias("pos"), p.alias("path"))))
        extra.append(F.transform(F.array_sort(hits), lambda h: h["path"]).alias("media_paths"))
    return keyed.groupBy(channel, "group_id").agg(
        F.sort_array(F.collect_list(F.col(msg_id)), asc=False).alias("message_ids"),
        first_truthy(text, walk).alias("text"),
        first_truthy(message, walk).alias("message"),
        F.min_by(d, F.when(d.isNotNull(), walk)).alias("date"),
        first_truthy(sender_id, walk, kind="number").alias("sender_id"),
        F.sum(F.when(media_flag, 1).otherwise(0)).cast("bigint").alias("media_slots"),
        *extra,
    )


def one_path(media: DataFrame, channel: str) -> DataFrame:
    """One downloaded path per (channel, id): failed downloads are left out, and of several downloads of one
    message the greatest path counts."""
    return media.where(F.col("path").isNotNull()).groupBy(
        F.col(channel).alias("_ch"), F.col("id").alias("_mid")).agg(F.max("path").alias("_path"))


def scrape_records(messages: DataFrame, media: DataFrame, limit: int, channel: str = "channel",
                   msg_id: str = "id", **fold_args) -> DataFrame:
    """The batch scrape of every channel at once: the ``limit`` newest
    messages per channel (W2), folded into group records (A1) carrying the
    downloaded paths of their messages (J1/J2).

    One window with a partial group limit, one equi-join on ``(channel, id)``
    (AQE broadcasts the media side when it is small), one aggregate."""
    newest = newest_per_channel(messages, limit, channel, msg_id).drop("rank")
    m = one_path(media, channel)
    joined = newest.join(m, (newest[channel] == m["_ch"]) & (newest[msg_id] == m["_mid"]), "left") \
        .drop("_ch", "_mid")
    return fold_albums(joined, channel=channel, msg_id=msg_id, media_path="_path", **fold_args)


def attach_media(messages: DataFrame, media: DataFrame, channel: str = "channel",
                 msg_id: str = "id", grouped_id: str = "grouped_id") -> DataFrame:
    """J1 + J2: per group, the downloaded paths in message-id walk order.

    ``media`` holds ``(channel, id, path)`` with a NULL path for a failed
    download. One equi-join on ``(channel, id)`` (a unique key, so no skew;
    AQE turns it into a broadcast when the media side is small at run time),
    then one aggregate. A group without any hit gets ``[]``.
    """
    m = one_path(media, channel).withColumnRenamed("_path", "path")
    keyed = messages.select(channel, msg_id, group_key(grouped_id, msg_id).alias("group_id"))
    joined = keyed.join(m, (keyed[channel] == m["_ch"]) & (keyed[msg_id] == m["_mid"]), "left")
    hits = F.collect_list(F.when(F.col("path").isNotNull(),
                                 F.struct((-F.col(msg_id)).alias("pos"), F.col("path"))))
    return joined.groupBy(channel, "group_id").agg(
        F.transform(F.array_sort(hits), lambda s: s["path"]).alias("media_paths"))


def albums_only(groups: DataFrame, ids: str = "message_ids") -> DataFrame:
    """Groups with more than one message."""
    return groups.where(F.size(F.col(ids)) > 1)


def newest_per_channel(messages: DataFrame, n: int, channel: str = "channel",
                       msg_id: str = "id") -> DataFrame:
    """The ``n`` newest messages of every channel (``iter_messages(limit=n)``).

    Written as ``row_number() <= n``; Spark's group-limit rule inserts a
    per-partition top-n before the shuffle, so a huge channel sends at most
    ``n`` rows per map task to the window.
    """
    from pyspark.sql import Window
    w = Window.partitionBy(channel).orderBy(F.col(msg_id).desc())
    return messages.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def media_file_path(media_dir: str, allowed: Sequence[str], channel: str = "channel",
                    msg_id: str = "id", kind: str = "media_kind", mime: str = "mime_type") -> Column:
    """Where a download lands: photo -> ``id.jpg``; document ->
    ``id.<mime subtype or bin>``; other kinds or kinds not allowed -> NULL."""
    k = F.col(kind)
    m = F.col(mime)
    subtype = F.when(m.isNull() | (m == ""), F.lit("bin")).otherwise(F.element_at(F.split(m, "/"), -1))
    ext = (F.when((k == "photo") & F.lit("photo" in allowed), F.lit("jpg"))
            .when((k == "document") & F.lit("document" in allowed), subtype))
    prefix = F.concat(F.lit(media_dir.rstrip("/") + "/"), F.col(channel), F.lit("/"))
    return F.when(ext.isNotNull(), F.concat(prefix, F.col(msg_id).cast("string"), F.lit("."), ext))
