"""Warehouse models (P1-P5, D1, W1, A2-A4, N1, T12) and the data tests (Q1-Q5, M3)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from chanlake.functions import arrays, dates, text
from chanlake.operators import quality
from chanlake.plans import fixtures as fx, warehouse
from chanlake.plans.catalog._base import _links_duck, d_render, d_render_nested, q, register


# --- warehouse models (P1-P5, D1, W1, A2-A4, N1, T12) -------------------------


def _wh_sources(spark, sf) -> dict[str, DataFrame]:
    return {
        "raw_data": fx.for_spark(spark, sf, fx.raw_data),
        "raw_data_flat": fx.for_spark(spark, sf, fx.raw_data_flat),
        "stg_telegram_messages": fx.for_spark(spark, sf, fx.msgs_dup),
    }


def _model(spark, sf, name) -> DataFrame:
    return warehouse.build(_wh_sources(spark, sf), [name])[name]


D_STG = f"""
SELECT _id AS raw_id, group_id, message_ids, message_text, sender, scraped_date, media_paths,
  {_links_duck('message_text', text.SQL_LINK, 0, False)} AS links, business_name, phone_number, address
FROM {fx.for_duck(fx.raw_data)} r"""
D_FACT = f"""
SELECT group_id, UNNEST(message_ids) AS message_id, message_text, UNNEST(media_paths) AS media_path,
  UNNEST(links) AS extracted_link, scraped_date FROM ({D_STG}) stg"""
D_DIM = f"""
SELECT DISTINCT group_id, business_name, phone_number, address FROM ({D_STG}) stg
WHERE business_name IS NOT NULL"""
D_CLEANED_DATA = f"""
SELECT group_id, list(message_id ORDER BY message_id, media_path NULLS FIRST, link NULLS FIRST) AS message_ids,
  max(message_text) AS message_text,
  list(media_path ORDER BY message_id, media_path NULLS FIRST, link NULLS FIRST) AS media_paths,
  list(link ORDER BY message_id, media_path NULLS FIRST, link NULLS FIRST) AS links,
  business_name, phone_number, address, scraped_date
FROM {fx.for_duck(fx.raw_data_flat)} f
GROUP BY group_id, business_name, phone_number, address, scraped_date"""
D_CLEAN_MESSAGES = f"""
SELECT message_id, sender_id, trim(message_text) AS message_text, message_date,
  coalesce(media_path, 'No Media') AS media_path, channel
FROM {fx.for_duck(fx.msgs_dup)} m WHERE message_text IS NOT NULL"""
D_DEDUP = f"""
SELECT DISTINCT ON (message_id) * FROM ({D_CLEAN_MESSAGES}) c
ORDER BY message_id, message_date DESC NULLS FIRST, message_text DESC NULLS LAST,
  sender_id DESC NULLS LAST, media_path DESC NULLS LAST, channel DESC NULLS LAST"""
D_FILLED = f"""
SELECT message_id, coalesce(sender_id, 'Unknown Sender') AS sender_id,
  coalesce(message_text, 'No Text') AS message_text, message_date,
  coalesce(media_path, 'No Media') AS media_path, channel FROM ({D_DEDUP}) d"""
D_STANDARDIZED = f"""
SELECT message_id, sender_id, lower(trim(message_text)) AS message_text,
  try_strptime(message_date, '%Y-%m-%d %H:%M:%S') AS formatted_date, media_path, channel
FROM ({D_FILLED}) f"""

register("stg_telegram", f"""
SELECT raw_id, group_id, {d_render('message_ids')} AS message_ids, message_text, sender, scraped_date,
  {d_render('media_paths')} AS media_paths, {d_render('links')} AS links, business_name, phone_number, address
FROM ({D_STG}) s""")(lambda spark, sf: _model(spark, sf, "stg_telegram").select(
    "raw_id", "group_id", arrays.render("message_ids").alias("message_ids"), "message_text", "sender",
    "scraped_date", arrays.render("media_paths").alias("media_paths"),
    arrays.render("links").alias("links"), "business_name", "phone_number", "address"))

register("dim_businesses", D_DIM)(lambda spark, sf: _model(spark, sf, "dim_businesses"))
register("fact_interactions", D_FACT)(
    lambda spark, sf: _model(spark, sf, "fact_business_interactions"))

register("transformed_data", f"""
SELECT group_id, {d_render_nested('list_sort(list(DISTINCT message_ids))')} AS message_ids,
  max(message_text) AS message_text, sender, max(scraped_date) AS scraped_date,
  {d_render_nested('list_sort(list(DISTINCT media_paths))')} AS media_paths,
  {d_render_nested('list_sort(list(DISTINCT links))')} AS links
FROM ({D_STG}) s GROUP BY group_id, sender""")(
    lambda spark, sf: _model(spark, sf, "transformed_telegram_data").select(
        "group_id", arrays.render_nested("message_ids").alias("message_ids"), "message_text",
        "sender", "scraped_date", arrays.render_nested("media_paths").alias("media_paths"),
        arrays.render_nested("links").alias("links")))

register("cleaned_data", f"""
SELECT group_id, {d_render('message_ids')} AS message_ids, message_text,
  {d_render('media_paths')} AS media_paths, {d_render('links')} AS links,
  business_name, phone_number, address, scraped_date
FROM ({D_CLEANED_DATA}) c""")(lambda spark, sf: _model(spark, sf, "cleaned_data").select(
    "group_id", arrays.render("message_ids").alias("message_ids"), "message_text",
    arrays.render("media_paths").alias("media_paths"), arrays.render("links").alias("links"),
    "business_name", "phone_number", "address", "scraped_date"))

register("clean_messages", D_CLEAN_MESSAGES)(lambda spark, sf: _model(spark, sf, "clean_messages"))
register("remove_duplicates", D_DEDUP)(lambda spark, sf: _model(spark, sf, "remove_duplicates"))
register("handle_missing", D_FILLED)(lambda spark, sf: _model(spark, sf, "handle_missing"))
register("standardize_formats", f"""
SELECT message_id, sender_id, message_text, strftime(formatted_date, '%Y-%m-%d %H:%M:%S') AS formatted_date,
  media_path, channel FROM ({D_STANDARDIZED}) s""")(
    lambda spark, sf: _model(spark, sf, "standardized").withColumn(
        "formatted_date", dates.sql_format("formatted_date")))


# --- data tests (Q1-Q5, M3) ---------------------------------------------------

D_MODELS = {
    "stg_telegram": D_STG, "fact_business_interactions": D_FACT, "dim_businesses": D_DIM,
    "cleaned_data": D_CLEANED_DATA, "standardized": D_STANDARDIZED,
}


def _d_test(t) -> str:
    src = f"({D_MODELS[t.model]}) m"
    if t.test == "not_null":
        n = f"SELECT count(*) FROM {src} WHERE {t.column} IS NULL"
    elif t.test == "unique":
        n = (f"SELECT count(*) FROM (SELECT {t.column} FROM {src} WHERE {t.column} IS NOT NULL "
             f"GROUP BY {t.column} HAVING count(*) > 1) u")
    elif t.test == "accepted_values":
        vals = ", ".join(q(v) for v in t.values)
        n = f"SELECT count(DISTINCT {t.column}) FROM {src} WHERE {t.column} NOT IN ({vals})"
    else:
        n = f"SELECT count(*) FROM {src} WHERE {t.predicate}"
    return (f"SELECT {q(t.model)} AS model, {q(t.column)} AS \"column\", {q(t.label)} AS test, "
            f"CAST(({n}) AS BIGINT) AS failures")


def _dq_report(spark, sf):
    return quality.run_tests(warehouse.build(_wh_sources(spark, sf)))


def _dq_oracle() -> str:
    return "\nUNION ALL\n".join(_d_test(t) for t in quality.DECLARED_TESTS)


register("dq_report", _dq_oracle())(_dq_report)
