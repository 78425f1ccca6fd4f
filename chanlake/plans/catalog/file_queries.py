"""File sources and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from chanlake.functions import arrays, text
from chanlake.plans import fixtures as fx
from chanlake.sources import files
from chanlake.plans.catalog._base import _conv, _customer, _msgs, _work, d_render, q, register
from chanlake.plans.catalog.album_queries import D_ALBUMS, _albums


# --- file sources and sinks (S1-S8, S12) ------------------------------------------


def _csv_roundtrip(spark, sf):
    src = _conv(spark, sf)
    path = _work(spark, "conversations.csv")
    files.save_csv(src, path)
    return files.load_csv(spark, path, schema=src.schema, lossless=True)


register("csv_roundtrip", "SELECT conv_id, turn, role, text FROM conversations")(_csv_roundtrip)


def _load_save(name):
    """``save`` then ``load`` by extension with the defaults of both."""
    def run(spark, sf):
        path = _work(spark, "turns") + name
        m = _msgs(spark, sf).select("message_id", "grouped_id", "channel", "message_text", "raw_message")
        files.save(m, path)
        return files.load(spark, path, schema=m.schema).select(*m.columns)
    return run


for _ext in ("json", "csv"):
    register(f"load_save_{_ext}", f"""
SELECT message_id, grouped_id, channel, message_text, raw_message FROM {fx.for_duck(fx.msgs)} m""")(
        _load_save(f".{_ext}"))


def _scan_csv(spark, sf):
    path = _work(spark, "customer.csv")
    files.save_csv(_customer(spark, sf), path, lossless=False)
    return files.load_csv(spark, path, infer=True)


register("scan_csv", """
SELECT CAST(c_custkey AS INTEGER) AS c_custkey, c_name, CAST(c_nationkey AS INTEGER) AS c_nationkey,
  c_acctbal, c_mktsegment FROM customer""")(_scan_csv)


def _json_roundtrip(spark, sf):
    path = _work(spark, "conversations.json")
    files.save_json(_conv(spark, sf), path)
    return files.load_json(spark, path, array_form=False).select("conv_id", "turn", "role", "text")


register("json_roundtrip", "SELECT conv_id, turn, role, text FROM conversations")(_json_roundtrip)


def _scan_json(spark, sf):
    path = _work(spark, "customer_arrays.json")
    files.save_json_array(_customer(spark, sf), path)
    out = files.load_json(spark, path, array_form=True)
    return out.select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")


register("scan_json", """
SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, c_mktsegment
FROM customer""")(_scan_json)


# --- layouts that only their structure tells apart -------------------------------------

def _scan_json_layouts(spark, sf):
    """All customers with a nested list, a third each as compact one-line arrays, several records on a line and
    indented arrays, read by one load."""
    c = _customer(spark, sf).withColumn("parts", F.transform(
        F.sequence(F.lit(0), F.col("c_custkey") % 3), lambda i: F.struct(i.alias("n"), F.concat(
            F.lit('} ", { \\ '), "c_name").alias("name"))))
    path = _work(spark, "layouts")
    for i, layout in enumerate(("compact", "joined", "indented")):
        files.save_json_layout(c.where(F.col("c_custkey") % 3 == i), f"{path}/{layout}", layout)
    back = files.load_json(spark, path)
    return back.select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment", F.size("parts").alias("n_parts"),
                       F.element_at("parts", -1)["name"].alias("last_name"))


register("scan_json_layouts", """
SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, c_mktsegment,
  CAST(c_custkey % 3 + 1 AS INTEGER) AS n_parts, '} ", { \\ ' || c_name AS last_name FROM customer""".replace("\\\\", "\\"))(
    _scan_json_layouts)


def _scan_csv_spans(spark, sf):
    """Whole documents as CSV, most of whose records span lines and hold quotes, in many splits."""
    docs = fx_documents(spark, sf)
    path = _work(spark, "spans.csv")
    files.save_csv(docs, path)
    return files.load_csv(spark, path, schema=docs.schema)


register("scan_csv_spans", """
SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN '"' || text || chr(10) || '5" x 4", "' ELSE text || chr(10) || lang END AS text,
  lang, source FROM documents""")(_scan_csv_spans)


def fx_documents(spark, sf):
    t = F.col("text")
    marked = F.when(F.col("doc_id") % 7 == 0, F.concat(F.lit('"'), t, F.lit('\n5" x 4", "'))).otherwise(
        F.concat(t, F.lit("\n"), F.col("lang")))
    return spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", marked.alias("text"), "lang", "source")


def _conll_source(spark, sf):
    """Sentences from whole conversation turns: tokens split on whitespace,
    a label per token by length; every fifth conversation has one label
    fewer than tokens (the writer cuts to the shorter list)."""
    tokens = F.filter(F.split("text", text.WS_CLASS + "+"), lambda t: t != F.lit(""))
    c = _conv(spark, sf).select("conv_id", tokens.alias("tokens"))
    labels = F.transform("tokens", lambda t: F.when(F.length(t) > 6, "B-LONG").otherwise("O"))
    labels = F.when(F.col("conv_id") % 5 == 0, F.slice(labels, 1, F.greatest(F.size("tokens") - 1, F.lit(0)))) \
        .otherwise(labels)
    return c.select("tokens", labels.alias("labels"))


def _conll_roundtrip(spark, sf):
    path = _work(spark, "sentences.conll")
    files.save_conll(_conll_source(spark, sf), path)
    back = files.load_conll(spark, path)
    return back.select(F.array_join("tokens", " ").alias("tokens"),
                       F.array_join("labels", " ").alias("labels"),
                       F.size("tokens").alias("n_tokens"))


register("conll_roundtrip", f"""
WITH t AS (SELECT conv_id, list_filter(regexp_split_to_array(text, {q(text.WS_CLASS + '+')}), lambda x: x <> '')
             AS tokens FROM conversations),
l AS (SELECT conv_id, tokens, list_transform(tokens, lambda x: CASE WHEN length(x) > 6 THEN 'B-LONG' ELSE 'O' END)
        AS labels FROM t),
c AS (SELECT tokens, CASE WHEN conv_id % 5 = 0 THEN labels[1:greatest(len(tokens) - 1, 0)] ELSE labels END AS labels
      FROM l),
z AS (SELECT tokens[1:least(len(tokens), len(labels))] AS tokens,
             labels[1:least(len(tokens), len(labels))] AS labels FROM c)
SELECT array_to_string(tokens, ' ') AS tokens, array_to_string(labels, ' ') AS labels,
  CAST(len(tokens) AS INTEGER) AS n_tokens FROM z WHERE len(tokens) > 0""")(_conll_roundtrip)

MSG_COLS = ["message_id", "grouped_id", "sender_id", "message_text", "media_path", "message_date",
            "channel"]


def _channel_store(spark, sf):
    m = _msgs(spark, sf).select(*MSG_COLS)
    path = _work(spark, "by_channel")
    files.save_by_channel(m, path, fmt="json")
    schema = m.drop("channel").schema
    return spark.read.schema(schema).json(path).select(*MSG_COLS)


register("channel_store", f"SELECT {', '.join(MSG_COLS)} FROM {fx.for_duck(fx.msgs)} m")(_channel_store)

ALBUM_COLS = ["group_id", "message_ids", "text", "message", "date", "sender_id", "media_slots"]
CSV_CHANNELS = ("chan4", "chan5", "chan6")


# Channel names as the merge must return them: marks, spaces, path characters.
ODD_CHANNELS = {"chan0": "a+b", "chan1": "a:b", "chan2": "a/b", "chan3": "shop one", "chan4": "a%b", "chan5": "a=b"}


def _merge_array_files(spark, sf):
    """Array files (one record per line), JSON Lines and CSV files with reordered headers, under
    awkward channel names; NULL fields and lists that hold NULL survive."""
    odd = F.coalesce(*[F.when(F.col("channel") == k, F.lit(v)) for k, v in ODD_CHANNELS.items()])
    m = _msgs(spark, sf).select(
        odd.alias("channel"), "message_id", "message_text", F.array("media_path", "sender").alias("media"))
    jpath, apath, cpath = (_work(spark, n) for n in ("lines", "arrays", "headers"))
    files.save_by_channel(m.where(F.col("channel").isin("a+b", "a:b", "a/b")), jpath, fmt="json")
    files.save_json_array(m.where(F.col("channel").isNull()).drop("channel"), f"{apath}/channel=__HIVE_DEFAULT_PARTITION__")
    files.save_by_channel(m.where(F.col("channel").isin("shop one", "a%b")), cpath, fmt="csv")
    files.save_by_channel(m.where(F.col("channel") == "a=b").select("media", "message_text", "message_id", "channel"),
                          cpath, fmt="csv")
    schema = m.drop("channel").schema
    out = files.merge_channels(spark, schema, f"{jpath}/*/*.json", f"{cpath}/*/*.csv").unionByName(
        files.merge_channels(spark, schema, f"{apath}/*/*.txt"))
    return out.select("channel", "message_id", "message_text", arrays.render("media").alias("media"))


register("merge_array_files", f"""
SELECT CASE channel {' '.join(f"WHEN {q(k)} THEN {q(v)}" for k, v in ODD_CHANNELS.items())} END AS channel,
  message_id, message_text, {d_render('[media_path, sender]')} AS media FROM {fx.for_duck(fx.msgs)} m""")(
    _merge_array_files)


def _merge_channels(spark, sf):
    records = _albums(spark, sf).select("channel", *ALBUM_COLS)
    jpath, cpath = _work(spark, "landed_json"), _work(spark, "landed_csv")
    files.save_by_channel(records.where(~F.col("channel").isin(*CSV_CHANNELS)), jpath, fmt="json")
    files.save_by_channel(records.where(F.col("channel").isin(*CSV_CHANNELS)), cpath, fmt="csv")
    schema = records.drop("channel").schema
    merged = files.merge_channels(spark, schema, json_glob=f"{jpath}/*/*.json",
                                  csv_glob=f"{cpath}/*/*.csv")
    return merged.select("channel", "group_id", F.array_join("message_ids", ",").alias("message_ids"),
                         "text", "message", "date", "sender_id", "media_slots")


register("merge_channels", f"""
SELECT channel, group_id, array_to_string(message_ids, ',') AS message_ids, text, message, date,
  sender_id, media_slots FROM ({D_ALBUMS}) a""")(_merge_channels)
