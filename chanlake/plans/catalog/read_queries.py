"""Served reads, profile and detections."""

from __future__ import annotations

from pyspark.sql import functions as F

from chanlake.functions import arrays
from chanlake.operators import media, reads
from chanlake.plans import fixtures as fx
from chanlake.sources import files, store
from chanlake.plans.catalog._base import _customer, _work, d_render, q, register


# --- served reads, profile, detections (P6-P8, P12, P14, L1-L3, A6, A7, N3) -----

REGEX_PATTERN = "ÇUSTOMER#0000001"
EQ_QUERY = {"c_mktsegment": "BUILDING", "c_nationkey": 3}


register("eq_filter", """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
WHERE c_mktsegment = 'BUILDING' AND c_nationkey = 3""")(
    lambda spark, sf: store.eq_filter(
        _customer(spark, sf), EQ_QUERY))


def _regex_filter(spark, sf):
    return reads.regex_filter(fx.for_spark(spark, sf, fx.biz), "business_name", REGEX_PATTERN).select(
        "id", "business_name", "phone_number", "address", "scraped_date")


register("regex_filter", f"""
SELECT CAST(id AS VARCHAR) AS id, business_name, phone_number, address, scraped_date
FROM {fx.for_duck(fx.biz)} b WHERE regexp_matches(business_name, {q(REGEX_PATTERN)}, 'i')
ORDER BY b.id LIMIT 10""")(_regex_filter)

register("scraped_data", f"""
SELECT _id, group_id, {d_render('message_ids')} AS message_ids, message_text, sender, scraped_date
FROM {fx.for_duck(fx.raw_data)} r ORDER BY _id LIMIT 10""")(
    lambda spark, sf: reads.scraped_rows(fx.for_spark(spark, sf, fx.raw_data)).select(
        "_id", "group_id", arrays.render("message_ids").alias("message_ids"), "message_text", "sender",
        "scraped_date"))

register("slice_rows", """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
ORDER BY c_custkey LIMIT 5 OFFSET 10""")(
    lambda spark, sf: reads.slice_rows(
        _customer(spark, sf), "c_custkey", 10, 15))


def _served(spark, sf):
    out = reads.served_rows(fx.for_spark(spark, sf, fx.biz), limit=None)
    return out.select("id", "business_name", "phone_number", "address", "scraped_date",
                      F.array_join("media_paths", ",").alias("media_paths"),
                      F.array_join("links", ",").alias("links"),
                      F.size("links").alias("n_links"))


register("served_rows", f"""
SELECT id, business_name, phone_number, address, scraped_date,
  array_to_string(coalesce(CAST(media_paths AS JSON)::VARCHAR[], CAST([] AS VARCHAR[])), ',') AS media_paths,
  array_to_string(coalesce(CAST(links AS JSON)::VARCHAR[], CAST([] AS VARCHAR[])), ',') AS links,
  CAST(len(coalesce(CAST(links AS JSON)::VARCHAR[], CAST([] AS VARCHAR[]))) AS INTEGER) AS n_links
FROM {fx.for_duck(fx.biz)} b""")(_served)


def _profile(spark, sf):
    return reads.profile(fx.for_spark(spark, sf, fx.biz))


def _d_profile() -> str:
    cols = [("id", "bigint"), ("business_name", "string"), ("phone_number", "string"),
            ("address", "string"), ("scraped_date", "string"), ("media_paths", "string"),
            ("links", "string")]
    parts = [f"SELECT '{c}' AS \"column\", '{t}' AS dtype, count({c}) AS non_null, count(*) AS \"rows\" "
             f"FROM {fx.for_duck(fx.biz)} b" for c, t in cols]
    return "\nUNION ALL\n".join(parts)


register("profile", _d_profile())(_profile)


def _nested(spark, sf):
    return media.nest_detections(fx.for_spark(spark, sf, fx.dets))


D_NESTED = f"""
SELECT image_path, list(class ORDER BY box_no, class, confidence, bbox) AS classes,
  list(confidence ORDER BY box_no, class, confidence, bbox) AS confs,
  list(list_transform(bbox, lambda v: CAST(round(v * 100) AS BIGINT)) ORDER BY box_no, class, confidence, bbox) AS boxes,
  count(*) AS n FROM {fx.for_duck(fx.dets)} d GROUP BY image_path"""

register("detections_nest", f"""
SELECT image_path, CAST(n AS INTEGER) AS n_detections, array_to_string(classes, '|') AS classes,
  array_to_string(list_transform(confs, lambda c: CAST(round(c * 100) AS BIGINT)), ',') AS confidence_pct,
  array_to_string(list_transform(boxes, lambda b: array_to_string(b, ',')), '|') AS boxes_pct
FROM ({D_NESTED}) n""")(lambda spark, sf: _nested(spark, sf).select(
    "image_path", F.size("detections").alias("n_detections"),
    F.array_join(F.transform("detections", lambda d: d["class"]), "|").alias("classes"),
    F.array_join(F.transform("detections", lambda d: F.round(d["confidence"] * 100).cast("bigint")),
                 ",").alias("confidence_pct"),
    F.array_join(F.transform("detections", lambda d: F.array_join(F.transform(
        d["bbox"], lambda v: F.round(v * 100).cast("bigint")), ",")), "|").alias("boxes_pct")))


def _flat(spark, sf):
    out = media.flatten_detections(_nested(spark, sf))
    return out.select("image_path", F.col("box_no").cast("int").alias("box_no"), "class",
                      "confidence", "x1", "y1", "x2", "y2")


D_FLAT = f"""
SELECT image_path,
  CAST(row_number() OVER (PARTITION BY image_path ORDER BY box_no, class, confidence, bbox) AS INTEGER) AS box_no,
  class, confidence, bbox[1] AS x1, bbox[2] AS y1, bbox[3] AS x2, bbox[4] AS y2
FROM {fx.for_duck(fx.dets)} d"""

register("detections_flat", D_FLAT)(_flat)

def _detections_store(spark, sf):
    """The nested detection records written as a JSON document store and
    read back with the declared schema, then flattened."""
    from chanlake.schemas import DETECTIONS
    path = _work(spark, "detected_objects.json")
    files.save_json(_nested(spark, sf), path)
    back = files.load_json(spark, path, schema=DETECTIONS)
    out = media.flatten_detections(back)
    return out.select("image_path", F.col("box_no").cast("int").alias("box_no"), "class",
                      "confidence", "x1", "y1", "x2", "y2")


register("detections_store", D_FLAT)(_detections_store)

DETECTION_PATTERN = "BÓX"


def _detection_filter(spark, sf):
    out = reads.detection_filter(_nested(spark, sf), DETECTION_PATTERN, limit=None)
    return out.select("image_path", F.size("detections").alias("n_detections"))


register("detection_filter", f"""
SELECT image_path, CAST(count(*) AS INTEGER) AS n_detections FROM {fx.for_duck(fx.dets)} d
GROUP BY image_path HAVING bool_or(regexp_matches(class, {q(DETECTION_PATTERN)}, 'i'))""")(
    _detection_filter)
