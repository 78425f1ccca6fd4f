"""Injected model calls (F2, F3), the model graph (M1, M2) and the batch scrape end to end."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from chanlake.functions import arrays
from chanlake.operators import albums, media, quality
from chanlake.plans import fixtures as fx, warehouse
from chanlake.plans.catalog._base import ORACLES, _msgs, _work, d_render, q, register
from chanlake.plans.catalog.warehouse_queries import (
    D_CLEANED_DATA, D_CLEAN_MESSAGES, D_DEDUP, D_DIM, D_FACT, D_FILLED, D_STANDARDIZED, D_STG,
    _wh_sources,
)
from chanlake.plans.catalog.album_queries import D_MEDIA, NEWEST_N, d_albums


# --- model calls with injected functions (F2, F3) ----------------------------------

FAKE_CLASSES = ("person", "bottle", "pill")


def fake_detector_loader():
    """Deterministic stand-in detector (no model weights here): the number of
    boxes and their classes come from the MD5 hex digest of the path."""
    import hashlib

    def detect(path: str) -> list[dict]:
        h = hashlib.md5(path.encode()).hexdigest()
        n = int(h[0], 16) % 4
        return [{"class": FAKE_CLASSES[int(h[1 + k], 16) % 3],
                 "confidence": int(h[5 + 2 * k:7 + 2 * k], 16) / 255.0,
                 "bbox": [float(k), float(k + 1), float(k + 10), float(k + 11)]} for k in range(n)]
    return lambda paths: [detect(p) for p in paths]


def fake_ocr(path: str) -> str:
    if path.endswith("3.jpg"):
        raise OSError("unreadable image")
    return "ጽሑፍ " + path.rsplit("/", 1)[-1]


def _d_hexdigit(h: str, pos: str) -> str:
    return f"(instr('0123456789abcdef', substr({h}, {pos}, 1)) - 1)"


D_IMAGES = f"(SELECT DISTINCT image_path FROM {fx.for_duck(fx.dets)} d)"


def _detect_udf(spark, sf):
    images = fx.for_spark(spark, sf, fx.dets).select("image_path").distinct()
    out = media.detect(images, fake_detector_loader)
    return out.select("image_path", F.size("detections").alias("n_detections"),
                      F.array_join(F.transform("detections", lambda d: d["class"]), "|").alias("classes"))


def _ocr_udf(spark, sf):
    images = fx.for_spark(spark, sf, fx.dets).select("image_path").distinct()
    return media.extract_text(images, fake_ocr)


register("detect_udf", f"""
SELECT image_path, CAST(n AS INTEGER) AS n_detections,
  array_to_string(list_transform(range(n), lambda k: ['person', 'bottle', 'pill'][({_d_hexdigit('h', '2 + k')}) % 3 + 1]), '|')
    AS classes
FROM (SELECT image_path, md5(image_path) AS h, {_d_hexdigit('md5(image_path)', '1')} % 4 AS n
      FROM {D_IMAGES} i) x""")(_detect_udf)

register("ocr_udf", f"""
SELECT image_path, CASE WHEN image_path LIKE '%3.jpg' THEN NULL
  ELSE 'ጽሑፍ ' || regexp_extract(image_path, '[^/]*$', 0) END AS ocr_text
FROM {D_IMAGES} i""")(_ocr_udf)


# --- model graph and materialisation (M1, M2) ----------------------------------------

D_TRANSFORMED = f"""SELECT group_id, sender, max(message_text) AS message_text, max(scraped_date) AS scraped_date
FROM ({D_STG}) s GROUP BY group_id, sender"""
# Per model: its SQL, and the columns whose contents are compared (as text, NULL spelled out).
WAREHOUSE_CONTENTS = {
    "stg_telegram": (D_STG, ["raw_id", "group_id", "[message_ids]", "message_text", "[media_paths]", "[links]"]),
    "dim_businesses": (D_DIM, ["group_id", "business_name", "phone_number", "address"]),
    "fact_business_interactions": (D_FACT, ["group_id", "message_id", "media_path", "extracted_link"]),
    "transformed_telegram_data": (D_TRANSFORMED, ["group_id", "sender", "message_text", "scraped_date"]),
    "cleaned_data": (D_CLEANED_DATA, ["group_id", "[message_ids]", "[media_paths]", "[links]", "message_text"]),
    "clean_messages": (D_CLEAN_MESSAGES, ["message_id", "sender_id", "message_text", "message_date", "media_path"]),
    "remove_duplicates": (D_DEDUP, ["message_id", "sender_id", "message_text", "message_date", "media_path"]),
    "handle_missing": (D_FILLED, ["message_id", "sender_id", "message_text", "message_date", "media_path"]),
    "standardized": (D_STANDARDIZED, ["message_id", "sender_id", "message_text", "media_path", "channel"]),
}


def _content_spark(cols) -> Column:
    parts = [arrays.render(c[1:-1]) if c[0] == "[" else F.col(c).cast("string") for c in cols]
    return F.md5(F.concat_ws("|", *[F.coalesce(p, F.lit("~")) for p in parts]))


def _content_duck(cols) -> str:
    parts = [d_render(c[1:-1]) if c[0] == "[" else f"CAST({c} AS VARCHAR)" for c in cols]
    return "md5(concat_ws('|', " + ", ".join(f"coalesce({p}, '~')" for p in parts) + "))"


def _warehouse_build(spark, sf):
    """Every model stored along the graph and read back: rows and a digest of their contents per model."""
    done = warehouse.build_stored(spark, _wh_sources(spark, sf), _work(spark, "warehouse"))
    out = None
    for name, df in done.items():
        digest = F.min(_content_spark(WAREHOUSE_CONTENTS[name][1])).alias("least"), F.max(
            _content_spark(WAREHOUSE_CONTENTS[name][1])).alias("greatest")
        heads = F.sum(F.conv(F.substring(_content_spark(WAREHOUSE_CONTENTS[name][1]), 1, 8), 16, 10).cast("bigint"))
        part = df.agg(F.count(F.lit(1)).alias("n_rows"), heads.alias("digest_sum"), *digest).select(
            F.lit(name).alias("model"), "n_rows", "digest_sum", "least", "greatest")
        out = part if out is None else out.unionByName(part)
    return out


register("warehouse_build", "\nUNION ALL\n".join(
    f"SELECT {q(name)} AS model, count(*) AS n_rows, "
    f"CAST(sum(CAST('0x' || substr(h, 1, 8) AS BIGINT)) AS BIGINT) AS digest_sum, min(h) AS least, max(h) AS greatest "
    f"FROM (SELECT {_content_duck(cols)} AS h FROM ({sql}) m) c"
    for name, (sql, cols) in WAREHOUSE_CONTENTS.items()))(_warehouse_build)


def _warehouse_gate(spark, sf):
    """M3: models stored, report stored, then the gate; the given data fails some tests, and the stored
    report is what the failing run leaves behind."""
    location = _work(spark, "gated")
    try:
        return warehouse.run(spark, _wh_sources(spark, sf), location)
    except quality.DataTestFailure:
        return spark.read.parquet(f"{location}/{warehouse.REPORT}")


register("warehouse_gate", ORACLES["dq_report"])(_warehouse_gate)


# --- the batch scrape end to end (W2 -> A1 -> J1/J2) -------------------------------

def _scrape(spark, sf):
    out = albums.scrape_records(_msgs(spark, sf), fx.for_spark(spark, sf, fx.media), NEWEST_N,
                                msg_id="message_id", text="message_text", message="raw_message",
                                date="message_date", has_media=F.col("media_kind").isNotNull())
    return out.select("channel", "group_id", F.array_join("message_ids", ",").alias("message_ids"),
                      "text", "message", "date", "sender_id", "media_slots",
                      F.array_join("media_paths", ",").alias("media_paths"))


D_SCRAPE_SRC = f"""(
  SELECT n.*, md.path FROM (
    SELECT * FROM (SELECT m.*, row_number() OVER (PARTITION BY channel ORDER BY message_id DESC) AS rn
                   FROM {fx.for_duck(fx.msgs)} m) r WHERE rn <= {NEWEST_N}) n
  LEFT JOIN {D_MEDIA} md ON n.channel = md.channel AND n.message_id = md.id)"""

register("channel_scrape", f"""
SELECT channel, group_id, array_to_string(message_ids, ',') AS message_ids, text, message, date, sender_id,
  media_slots, array_to_string(coalesce(paths, CAST([] AS VARCHAR[])), ',') AS media_paths
FROM ({d_albums(D_SCRAPE_SRC, ", list(path ORDER BY message_id DESC) FILTER (WHERE path IS NOT NULL) AS paths")}) a
""")(_scrape)
