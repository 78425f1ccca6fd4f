"""Registry, SQL-literal and DuckDB text helpers, shared readers of the driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from chanlake.functions import text
from chanlake.plans import fixtures as fx
from chanlake.session import ensure_checkpoint_dir, shared_path, ship_package


QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}

AS_OF = "2025-01-01 00:00:00"      # stands in for "now" in D2, so runs repeat


def register(key: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[key] = fn
        if oracle is not None:
            ORACLES[key] = oracle
        return fn
    return deco


def q(s: str) -> str:
    """SQL string literal (no backslash escapes: DuckDB reads them literally)."""
    return "'" + s.replace("'", "''") + "'"


# --- DuckDB spellings of the text functions ---------------------------------

def d_re(x: str, pattern: str, repl: str) -> str:
    return f"regexp_replace({x}, {q(pattern)}, {q(repl)}, 'g')"


def d_collapse(x: str) -> str:
    # RE2 has no back-references: drop each character equal to its
    # predecessor unless it is a newline.
    chars = f"string_split({x}, '')"
    return (f"CASE WHEN {x} IS NULL THEN NULL ELSE array_to_string(list_transform(list_filter("
            f"list_zip({chars}, list_prepend(NULL, {chars})), "
            f"lambda p: p[2] IS NULL OR p[1] <> p[2] OR p[1] = chr(10)), lambda p: p[1]), '') END")


D_STEPS = {
    "amharic": lambda x: f"translate({x}, {q(text.AMHARIC_FOLD_FROM)}, {q(text.AMHARIC_FOLD_TO)})",
    "punct": lambda x: d_re(x, text.PUNCT_RUN, " "),
    "emoji": lambda x: d_re(x, text.EMOJI_CLASS, ""),
    "repeat": d_collapse,
    "url": lambda x: d_re(x, text.URL_ANYWHERE, ""),
    "link": lambda x: d_re(x, text.LINK_QUERY, "\\1"),
    "space": lambda x: f"trim({d_re(x, text.WS_CLASS + '+', ' ')})",
}
CLEAN_TEXT_STEPS = ["amharic", "punct", "emoji", "repeat", "url", "link", "space"]


def d_chain(src: str, key: str, col: str, steps: list[str], keep: str = "") -> tuple[str, str]:
    """CTE chain applying DuckDB text steps one per CTE (no nested repeats);
    returns the WITH clause and the name of the last CTE."""
    ctes = [f"s0 AS (SELECT {key}, {keep}{col} AS m0, {col} AS m FROM {src} src)"]
    for i, step in enumerate(steps, 1):
        ctes.append(f"s{i} AS (SELECT * REPLACE ({D_STEPS[step]('m')} AS m) FROM s{i - 1})")
    return "WITH " + ",\n".join(ctes) + f"\n", f"s{len(steps)}"


# --- shared readers of the driver tables and derived relations -------------

def _texts(spark, sf):
    return fx.for_spark(spark, sf, fx.texts)


def _work(spark, name: str) -> str:
    return shared_path(spark, "io", name)


def _conv(spark, sf):
    return fx.read_table(spark, sf, "conversations")


def _customer(spark, sf):
    return fx.read_table(spark, sf, "customer")


def _msgs(spark, sf) -> DataFrame:
    return fx.for_spark(spark, sf, fx.msgs)


# --- DuckDB rendering of arrays and links ------------------------------------

def d_render(x: str) -> str:
    return f"array_to_string(list_transform({x}, lambda e: coalesce(CAST(e AS VARCHAR), 'NULL')), ',')"


def d_render_nested(x: str) -> str:
    return (f"array_to_string(list_transform({x}, lambda a: CASE WHEN a IS NULL THEN 'NULL' "
            f"ELSE '[' || {d_render('a')} || ']' END), ';')")


def _links_duck(x: str, pattern: str, group: int, blank_empty: bool) -> str:
    found = f"regexp_extract_all({x}, {q(pattern)}, {group})"
    if blank_empty:
        return f"CASE WHEN {x} IS NULL OR {x} = '' THEN CAST([] AS VARCHAR[]) ELSE {found} END"
    return f"coalesce({found}, CAST([] AS VARCHAR[]))"


# --- session settings ---------------------------------------------------------

def prepare(spark: SparkSession) -> None:
    """Session settings the queries rely on (UTC rendering, shared folder), and this package on the workers."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
