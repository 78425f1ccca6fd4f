"""Relations derived from the driver tables, written once as SQL text.

The same text builds the Spark input (``spark.sql(text, **frames)``) and the
DuckDB oracle input (CTEs over the registered views), so both sides start
from identical rows. Only a few spellings differ between the dialects; the
``Dialect`` object supplies them.

All derivations are row-wise over whole tables (no sampling or id subsets):
the work grows with the tables.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Dialect:
    name: str

    @property
    def spark(self) -> bool:
        return self.name == "spark"

    def arr(self, *items: str) -> str:
        return ("array(" if self.spark else "list_value(") + ", ".join(items) + ")"

    def list_ordered(self, value: str, key: str) -> str:
        """Ordered list aggregate that keeps NULL elements."""
        if self.spark:
            return (f"transform(array_sort(collect_list(named_struct('k', {key}, 'v', {value}))),"
                    f" s -> s.v)")
        return f"list({value} ORDER BY {key})"

    def list_ordered_nonnull(self, value: str, key: str) -> str:
        if self.spark:
            return f"filter({self.list_ordered(value, key)}, v -> v IS NOT NULL)"
        return f"list_filter(list({value} ORDER BY {key}), lambda v: v IS NOT NULL)"

    def table(self, name: str) -> str:
        """Table reference: a format placeholder for Spark, the view for DuckDB."""
        return "{" + name + "}" if self.spark else name


SPARK = Dialect("spark")
DUCK = Dialect("duckdb")

# Snippets spliced into whole document texts: the driver's text has no emoji,
# Ethiopic letters or URLs. They are written as literal characters (no
# backslash escapes, which the two SQL dialects read differently).
NBSP, IDEO_SPACE, TAB, CR, LF = " ", "　", "\t", "\r", "\n"
SNIP_AMHARIC = "ሐኪም። ዓለም፣፣ ዐዑዒዓዔዕዖኣ ኀኁኂኃኄኅኆ ሠሡሢሣሤሥሦ ዋጋ፡ 10000 ብር"
SNIP_EMOJI = "Helloo 😀😀 world ❤️ 👨‍👩‍👧 fam © 2024 ™ Hi 🇪🇹 ok"
SNIP_URL = ("see http://a.b/c?x=1?y=2 ok www.shop.com now https://www.x.com/?a=1?b=2, "
            "end https://a.b/c, www.k.com. mid-texthttp://q.r/s")
SNIP_SPACE = (f"{LF}{LF}a{TAB}b{CR}{CR} x  {NBSP} y{IDEO_SPACE}  Call 0911-22-33 "
              f"{LF}   ")


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def texts(d: Dialect) -> str:
    """``(doc_id, message)``: every document with snippets spliced in by id,
    plus NULL and '' rows, plus every page URL in a sentence."""
    docs, pages = d.table("documents"), d.table("pages")
    return f"""
SELECT doc_id,
  CASE doc_id % 10
    WHEN 0 THEN NULL
    WHEN 1 THEN ''
    WHEN 2 THEN {_q(SNIP_AMHARIC + ' ')} || text
    WHEN 3 THEN text || {_q(' ' + SNIP_EMOJI)}
    WHEN 4 THEN {_q(SNIP_URL + ' ')} || text
    WHEN 5 THEN {_q(SNIP_SPACE)} || text || {_q(SNIP_SPACE)}
    WHEN 6 THEN {_q(SNIP_AMHARIC + ' ' + SNIP_EMOJI + ' ' + SNIP_URL + SNIP_SPACE)} || text
    ELSE text END AS message
FROM {docs}
UNION ALL
SELECT page_id + 1000000000 AS doc_id,
  'visit ' || url || ' and ' || url || '?z=9 ok ' || url || '#x' AS message
FROM {pages}
"""


def msgs(d: Dialect) -> str:
    """One row per message, from ``conversations`` ((conv_id, turn) is unique).

    ``message_id`` starts at 1, ``grouped_id`` is an album id, 0 or NULL,
    ``sender`` is a string, ``sender_id`` a number (0 and NULL are falsy).
    """
    conv = d.table("conversations")
    return f"""
SELECT
  CAST(conv_id * 100 + turn + 1 AS BIGINT) AS message_id,
  conv_id, turn,
  CASE conv_id % 3 WHEN 0 THEN NULL WHEN 1 THEN CAST(conv_id + 100000 AS BIGINT)
       ELSE CAST(0 AS BIGINT) END AS grouped_id,
  CASE WHEN turn % 4 = 3 THEN NULL ELSE role END AS sender,
  CASE WHEN turn % 5 = 4 THEN NULL WHEN role = 'system' THEN CAST(0 AS BIGINT)
       ELSE CAST(conv_id * 10 + length(role) AS BIGINT) END AS sender_id,
  CASE WHEN (conv_id + turn) % 11 = 0 THEN NULL
       WHEN (conv_id + turn) % 13 = 0 THEN ''
       WHEN (conv_id + turn) % 17 = 0 THEN '  ' || text || '   '
       WHEN (conv_id + turn) % 7 = 0 THEN text || ' https://shop.example/p/' || CAST(conv_id AS STRING) || '?ref=tg'
       ELSE text END AS message_text,
  'chan' || CAST(conv_id % 7 AS STRING) AS channel,
  CASE turn % 3 WHEN 0 THEN NULL WHEN 1 THEN 'photo' ELSE 'document' END AS media_kind,
  CASE WHEN turn % 3 = 2 AND conv_id % 2 = 0 THEN 'image/png' END AS mime_type,
  CASE WHEN turn % 2 = 0 THEN 'media/chan' || CAST(conv_id % 7 AS STRING) || '/'
       || CAST(conv_id * 100 + turn + 1 AS STRING)
       || CASE turn % 8 WHEN 0 THEN '.jpg' WHEN 2 THEN '.png' WHEN 4 THEN '.JPG' ELSE '.jpeg' END
       END AS media_path,
  CASE WHEN turn % 3 = 1 THEN '' WHEN turn % 5 = 0 THEN NULL
       ELSE text || ' #' || CAST(turn AS STRING) END AS raw_message,
  CASE WHEN (conv_id + turn) % 19 = 0 THEN NULL
       WHEN (conv_id + turn) % 23 = 0 THEN 'not a date'
       ELSE '2024-01-' || lpad(CAST(1 + conv_id % 28 AS STRING), 2, '0') || ' '
            || lpad(CAST(turn AS STRING), 2, '0') || ':' || lpad(CAST(conv_id % 60 AS STRING), 2, '0')
            || ':00' END AS message_date
FROM {conv}
"""


def msgs_dup(d: Dialect) -> str:
    """Per-message staging rows with re-sent copies: older copies, copies
    with a NULL date (newest under DESC NULLS FIRST) and exact date ties."""
    m = f"({msgs(d)})"
    cols = "message_id, sender AS sender_id, message_text, message_date, media_path, channel"
    return f"""
SELECT {cols} FROM {m} m0
UNION ALL
SELECT message_id, sender, message_text || ' (old)',
       '2023-12-31 23:59:59', media_path, channel FROM {m} m1 WHERE conv_id % 4 = 0
UNION ALL
SELECT message_id, sender, message_text, NULL, NULL, channel FROM {m} m2 WHERE conv_id % 8 = 1
UNION ALL
SELECT message_id, 'user', message_text || ' v2', message_date, media_path, channel
FROM {m} m3 WHERE conv_id % 10 = 2
"""


def _group_cols() -> dict[str, str]:
    return {
        "scraped_date": "CASE conv_id % 3 WHEN 0 THEN '2024-01-01' WHEN 1 THEN '2024-01-02' "
                        "ELSE '2024-01-03' END",
        "business_name": "CASE WHEN conv_id % 10 = 0 THEN NULL ELSE 'Shop ' || CAST(conv_id % 40 AS STRING) END",
        "phone_number": "CASE WHEN conv_id % 6 = 0 THEN NULL ELSE '+2519' || "
                        "lpad(CAST(conv_id * 7919 % 100000000 AS STRING), 8, '0') END",
        "address": "CASE WHEN conv_id % 5 = 0 THEN NULL ELSE 'Addis Ababa, block ' || "
                   "CAST(conv_id % 9 AS STRING) END",
    }


def raw_data(d: Dialect) -> str:
    """Group-level staging source, one row per conversation. A few group ids
    repeat so the ``unique`` test has something to find."""
    m = f"({msgs(d)})"
    g = _group_cols()
    return f"""
SELECT
  'r' || CAST(conv_id AS STRING) AS _id,
  CAST(CASE WHEN conv_id % 25 = 24 THEN conv_id - 1 ELSE conv_id END AS BIGINT) AS group_id,
  {d.list_ordered('message_id', 'turn')} AS message_ids,
  max(CASE WHEN turn = 0 THEN message_text END)
    || CASE conv_id % 4 WHEN 0 THEN ' https://shop.example/p/' || CAST(conv_id AS STRING) || '?ref=tg'
                        WHEN 1 THEN ' http://a.example/x and https://b.example/y,' ELSE '' END AS message_text,
  max(CASE WHEN turn = 0 THEN sender END) AS sender,
  {g['scraped_date']} AS scraped_date,
  {d.list_ordered_nonnull('media_path', 'turn')} AS media_paths,
  {g['business_name']} AS business_name,
  {g['phone_number']} AS phone_number,
  {g['address']} AS address
FROM {m} m GROUP BY conv_id
"""


def raw_data_flat(d: Dialect) -> str:
    """Per-message rows carrying group attributes (input of ``cleaned_data``); some messages come twice
    with other media and links."""
    m = f"({msgs(d)})"
    g = _group_cols()
    return f"""
SELECT
  CASE WHEN conv_id % 13 = 0 THEN NULL ELSE CAST(conv_id AS BIGINT) END AS group_id,
  message_id, message_text, media_path,
  CASE WHEN turn % 3 = 0 THEN NULL ELSE 'https://l.example/' || CAST(message_id AS STRING) END AS link,
  {g['business_name']} AS business_name,
  {g['phone_number']} AS phone_number,
  {g['address']} AS address,
  {g['scraped_date']} AS scraped_date
FROM {m} m
UNION ALL
SELECT CASE WHEN conv_id % 13 = 0 THEN NULL ELSE CAST(conv_id AS BIGINT) END, message_id, message_text,
  'media/second.jpg', 'https://a.example/' || CAST(turn AS STRING),
  {g['business_name']}, {g['phone_number']}, {g['address']}, {g['scraped_date']}
FROM {m} m2 WHERE conv_id % 4 = 2
"""


def media(d: Dialect) -> str:
    """Download results per media message; failed downloads NULL, some downloaded twice."""
    m = f"({msgs(d)})"
    return f"""
SELECT channel, message_id AS id,
  CASE WHEN (conv_id + turn) % 6 = 5 THEN NULL
       ELSE 'media/' || channel || '/' || CAST(message_id AS STRING) || '.jpg' END AS path
FROM {m} m WHERE media_kind IS NOT NULL
UNION ALL
SELECT channel, message_id AS id, 'media/' || channel || '/' || CAST(message_id AS STRING) || '-again.png' AS path
FROM {m} m2 WHERE media_kind = 'photo' AND conv_id % 5 = 1
"""


def dets(d: Dialect) -> str:
    """Flat detection boxes from ``lineitem``: image = order, box = line."""
    li = d.table("lineitem")
    bbox = d.arr("l_quantity", "l_extendedprice / 1000.0", "l_tax * 100.0",
                 "CAST(l_linenumber AS DOUBLE)")
    return f"""
SELECT 'img/' || CAST(l_orderkey AS STRING) || '.jpg' AS image_path,
  l_linenumber AS box_no,
  CASE l_returnflag WHEN 'R' THEN 'Bottle' WHEN 'A' THEN 'pill bóx' ELSE 'Person' END AS class,
  l_discount AS confidence,
  {bbox} AS bbox
FROM {li}
"""


def biz(d: Dialect) -> str:
    """Businesses from ``customer``: name NULL for every tenth key."""
    c = d.table("customer")
    n = d.table("nation")
    return f"""
SELECT c.c_custkey AS id,
  CASE WHEN c.c_custkey % 10 = 0 THEN NULL WHEN c.c_custkey % 2 = 0 THEN replace(c.c_name, 'C', 'Ç')
       ELSE replace(c.c_name, 'C', 'ç') END AS business_name,
  CASE WHEN c.c_custkey % 4 = 0 THEN NULL ELSE '+2519' || lpad(CAST(c.c_custkey AS STRING), 8, '0') END AS phone_number,
  n.n_name AS address,
  '2024-01-' || lpad(CAST(1 + c.c_custkey % 28 AS STRING), 2, '0') AS scraped_date,
  CASE WHEN c.c_custkey % 5 = 0 THEN NULL
       ELSE '["media/' || CAST(c.c_custkey AS STRING) || '.jpg","media/' || CAST(c.c_custkey AS STRING) || '.png"]' END AS media_paths,
  CASE WHEN c.c_custkey % 3 = 0 THEN '[]'
       WHEN c.c_custkey % 3 = 1 THEN NULL
       ELSE '["https://' || lower(c.c_mktsegment) || '.example/' || CAST(c.c_custkey AS STRING) || '"]' END AS links
FROM {c} c JOIN {n} n ON c.c_nationkey = n.n_nationkey
"""


def frame(d: Dialect) -> str:
    """Scraped group records for the frame cleaning job, from ``texts``."""
    t = f"({texts(d)})"
    media_arr = d.arr("'media/' || CAST(doc_id AS STRING) || '.jpg'")
    return f"""
SELECT doc_id AS group_id, message,
  CASE doc_id % 4 WHEN 0 THEN '  chan' || CAST(doc_id % 5 AS STRING) || {_q(TAB)}
       WHEN 1 THEN NULL ELSE 'chan' || CAST(doc_id % 5 AS STRING) END AS channel,
  CASE doc_id % 6 WHEN 0 THEN NULL WHEN 1 THEN 'garbage'
       WHEN 2 THEN '2024-01-' || lpad(CAST(1 + doc_id % 28 AS STRING), 2, '0') || 'T10:11:12+03:00'
       WHEN 3 THEN '2024-02-' || lpad(CAST(1 + doc_id % 28 AS STRING), 2, '0') || 'T08:00:00'
       ELSE '2024-03-' || lpad(CAST(1 + doc_id % 28 AS STRING), 2, '0') || ' 07:06:05' END AS date,
  CASE WHEN doc_id % 3 = 0 THEN NULL ELSE {media_arr} END AS media_path
FROM {t} t
"""


def order_dates(d: Dialect) -> str:
    """Date strings in several spellings, from ``orders``."""
    o = d.table("orders")
    return f"""
SELECT o_orderkey,
  CASE o_orderkey % 6
    WHEN 0 THEN NULL
    WHEN 1 THEN 'n/a'
    WHEN 2 THEN strftime_iso_t
    WHEN 3 THEN strftime_iso_t || '+03:00'
    WHEN 4 THEN strftime_space
    ELSE strftime_space || 'x' END AS raw_date
FROM (
  SELECT o_orderkey,
    CAST(CAST(o_orderdate AS DATE) AS STRING) || 'T' || lpad(CAST(o_orderkey % 24 AS STRING), 2, '0') || ':30:00' AS strftime_iso_t,
    CAST(CAST(o_orderdate AS DATE) AS STRING) || ' ' || lpad(CAST(o_orderkey % 24 AS STRING), 2, '0') || ':15:45' AS strftime_space
  FROM {o}) o
"""


def read_table(spark, sf_dir: str, name: str):
    """A driver table. Each test file is a single row group and scans as one
    task; ``spread`` redistributes such a scan when that gains four times the
    tasks, and never more than a gigabyte."""
    from chanlake.session import spread
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def for_spark(spark, sf_dir: str, sql_fn, **extra_frames):
    """Run a fixture text on Spark over the parquet tables it names."""
    text = sql_fn(SPARK)
    frames = {}
    for name in ("conversations", "documents", "pages", "lineitem", "customer", "nation",
                 "orders", "events"):
        if "{" + name + "}" in text:
            frames[name] = read_table(spark, sf_dir, name)
    frames.update(extra_frames)
    return spark.sql(text, **frames)


def for_duck(sql_fn) -> str:
    return f"({sql_fn(DUCK)})"
