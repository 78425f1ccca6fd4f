"""Text functions over whole documents (T1-T14), the frame cleaning job (T15), T13 and dates."""

from __future__ import annotations

from pyspark.sql import functions as F

from chanlake.functions import arrays, dates, text
from chanlake.plans import fixtures as fx
from chanlake.plans.cleaning import clean_frame
from chanlake.plans.catalog._base import (
    AS_OF, CLEAN_TEXT_STEPS, D_STEPS, _links_duck, _texts, d_chain, d_collapse, d_re, q, register,
)


# --- text functions over whole documents (T1-T12, T14) ----------------------

def _text_query(key: str, fn, duck_expr) -> None:
    oracle = f"SELECT doc_id, {duck_expr('message')} AS out FROM {fx.for_duck(fx.texts)} t"

    @register(key, oracle)
    def _q(spark, sf, fn=fn):
        return _texts(spark, sf).select("doc_id", fn(F.col("message")).alias("out"))


_text_query("amharic_normalize", text.normalize_amharic, D_STEPS["amharic"])
_text_query("amharic_only", text.remove_non_amharic, lambda x: d_re(x, text.NON_AMHARIC, ""))
_text_query("amharic_punct", text.remove_punctuation, D_STEPS["punct"])
_text_query("emoji_remove", text.remove_emojis, D_STEPS["emoji"])
_text_query("collapse_repeats", text.collapse_repeats, d_collapse)
_text_query("url_remove", text.remove_urls, D_STEPS["url"])
_text_query("link_normalize", text.normalize_links, D_STEPS["link"])
_text_query("space_normalize", text.normalize_spaces, D_STEPS["space"])
_text_query(
    "emoji_extract", text.extract_emojis,
    lambda x: (f"CASE WHEN {x} IS NULL OR {x} = '' OR {d_re(x, text.NOT_EMOJI_CLASS, '')} = '' "
               f"THEN {q(text.NO_EMOJI)} ELSE {d_re(x, text.NOT_EMOJI_CLASS, '')} END"))
_text_query(
    "newline_clean", text.clean_newlines,
    lambda x: (f"CASE WHEN {x} IS NULL THEN {q(text.NO_MESSAGE)} "
               f"ELSE {d_re(d_re(x, chr(10) + '+', ' '), text.EDGE_WS, '')} END"))


register("link_extract", f"""
SELECT doc_id, array_to_string(l, ' ') AS links, CAST(len(l) AS INTEGER) AS n_links
FROM (SELECT doc_id, {_links_duck('message', text.LINK, 1, True)} AS l FROM {fx.for_duck(fx.texts)} t) x
""")(lambda spark, sf: _texts(spark, sf)
     .select("doc_id", text.extract_links("message").alias("l"))
     .select("doc_id", F.array_join("l", " ").alias("links"), F.size("l").alias("n_links")))

_ctes, _last = d_chain(fx.for_duck(fx.texts), "doc_id", "message", CLEAN_TEXT_STEPS)
register("clean_text", _ctes + f"""
SELECT doc_id, CASE WHEN m0 IS NULL OR m0 = '' THEN '' ELSE m END AS out FROM {_last}
""")(lambda spark, sf: _texts(spark, sf).select("doc_id", text.clean_text("message").alias("out")))


# --- frame cleaning (T15) -----------------------------------------------------

def _d_coerce(x: str, as_of: str) -> str:
    """DuckDB twin of D2, independent of the DuckDB session time zone."""
    aware = f"regexp_matches({x}, '(Z|[+-][0-9][0-9]:?[0-9][0-9])$')"
    return (f"coalesce(CASE WHEN {aware} THEN try_cast({x} AS TIMESTAMPTZ) AT TIME ZONE 'UTC' "
            f"ELSE try_cast({x} AS TIMESTAMP) END, TIMESTAMP {q(as_of)})")


_fctes, _flast = d_chain(f"(SELECT *, {d_re('message', text.URL_ANYWHERE, '')} AS m_nourl "
                         f"FROM {fx.for_duck(fx.frame)} f)", "group_id",
                         f"coalesce(m_nourl, {q(text.NO_MESSAGE)})", CLEAN_TEXT_STEPS,
                         keep="message AS raw, channel, date, media_path, ")
register("clean_frame", _fctes + f"""
SELECT group_id,
  CASE WHEN raw IS NULL OR raw = '' OR {d_re('raw', text.NOT_EMOJI_CLASS, '')} = ''
       THEN {q(text.NO_EMOJI)} ELSE {d_re('raw', text.NOT_EMOJI_CLASS, '')} END AS emojis,
  array_to_string({_links_duck('raw', text.LINK, 1, True)}, ' ') AS links,
  CASE WHEN m0 = '' THEN '' ELSE m END AS message,
  array_to_string(coalesce(media_path, ['No Media']), ',') AS media_path,
  strftime({_d_coerce('date', AS_OF)}, '%Y-%m-%d %H:%M:%S') AS date,
  {d_re('channel', text.EDGE_WS, '')} AS channel
FROM {_flast}
""")(lambda spark, sf: clean_frame(fx.for_spark(spark, sf, fx.frame), AS_OF).select(
    "group_id", "emojis", F.array_join("links", " ").alias("links"), "message",
    F.array_join("media_path", ",").alias("media_path"),
    dates.sql_format("date").alias("date"), "channel"))


# --- T13 over whole conversations -------------------------------------------

register("combine_messages", f"""
SELECT conv_id, array_to_string(list_filter(list_transform(list(text ORDER BY turn),
         lambda x: {d_re('x', text.EDGE_WS, '')}), lambda x: x <> ''), chr(10)) AS combined
FROM conversations GROUP BY conv_id
""")(lambda spark, sf: fx.read_table(spark, sf, "conversations")
     .groupBy("conv_id")
     .agg(arrays.ordered_list("text", F.col("turn")).alias("texts"))
     .select("conv_id", text.combine_messages("texts").alias("combined")))


# --- dates (D2-D4, S13) -------------------------------------------------------

register("date_coerce", f"""
SELECT o_orderkey, strftime({_d_coerce('raw_date', AS_OF)}, '%Y-%m-%d %H:%M:%S') AS ts
FROM {fx.for_duck(fx.order_dates)} o
""")(lambda spark, sf: fx.for_spark(spark, sf, fx.order_dates).select(
    "o_orderkey", dates.sql_format(dates.coerce_timestamp("raw_date", AS_OF)).alias("ts")))

register("iso_encode", """
SELECT CAST(event_id AS VARCHAR) AS id,
  strftime(ts, '%Y-%m-%dT%H:%M:%S') || CASE WHEN microsecond(ts) % 1000000 = 0 THEN ''
    ELSE '.' || lpad(CAST(microsecond(ts) % 1000000 AS VARCHAR), 6, '0') END AS iso
FROM events
""")(lambda spark, sf: fx.read_table(spark, sf, "events").select(
    F.col("event_id").cast("string").alias("id"), dates.iso_format(F.col("ts")).alias("iso")))

register("utc_convert", """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS utc_naive,
  strftime(ts - INTERVAL 3 HOUR, '%Y-%m-%d %H:%M:%S') AS utc_from_addis
FROM events
""")(lambda spark, sf: fx.read_table(spark, sf, "events").select(
    "event_id", dates.sql_format(dates.to_utc("ts")).alias("utc_naive"),
    dates.sql_format(dates.to_utc("ts", "Africa/Addis_Ababa")).alias("utc_from_addis")))
