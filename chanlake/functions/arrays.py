"""Array helpers (N1, N4-N6, and the ordered aggregates of A2/A3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unnest_lockstep(df: DataFrame, arrays: dict[str, str], keep: list[str]) -> DataFrame:
    """Several ``UNNEST`` in one SELECT: element i of every array on row i,
    shorter arrays padded with NULL; rows whose arrays are all empty or NULL
    vanish. ``arrays_zip`` pads but is NULL when any input is NULL, hence
    the ``coalesce`` to an empty array first."""
    zipped = F.arrays_zip(*[
        F.coalesce(F.col(src), F.array().cast(df.schema[src].dataType)).alias(dst)
        for src, dst in arrays.items()])
    return df.select(*keep, F.explode(zipped).alias("_z")).select(
        *keep, *[F.col("_z")[dst].alias(dst) for dst in arrays.values()])


def ordered_list(value: str, order: Column) -> Column:
    """``ARRAY_AGG(value ORDER BY order)`` keeping NULL elements (plain
    ``collect_list`` drops them; wrapping each in a struct keeps them)."""
    items = F.collect_list(F.struct(order.alias("k"), F.col(value).alias("v")))
    return F.transform(F.array_sort(items), lambda s: s["v"])


def ordered_lists(order: list[str], values: list[str]) -> Column:
    """Several ``ARRAY_AGG`` over one input in one order: position i of every list comes from the same row. One
    struct per row crosses the shuffle; ties of ``order`` are broken by the values."""
    items = F.collect_list(F.struct(*[F.col(c) for c in dict.fromkeys([*order, *values])]))
    rows = F.array_sort(items)
    return F.struct(*[F.transform(rows, _pick(c)).alias(c) for c in values])


def _pick(name: str):
    return lambda s: s[name]


def distinct_arrays(value: str) -> Column:
    """``ARRAY_AGG(DISTINCT array_col)``: the distinct arrays, sorted, NULL
    arrays kept as one element."""
    items = F.collect_set(F.struct(F.col(value).alias("v")))
    return F.transform(F.array_sort(items), lambda s: s["v"])


def join_nonblank(col, sep: str = "\n") -> Column:
    """Join the non-blank strings of an array."""
    c = F.col(col) if isinstance(col, str) else col
    return F.array_join(F.filter(c, lambda x: x.isNotNull() & (x != F.lit(""))), sep)


def render(col, sep: str = ",", null: str = "NULL") -> Column:
    """Array -> string with NULL elements spelled out (for reports/compares)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.array_join(F.transform(c, lambda x: F.coalesce(x.cast("string"), F.lit(null))), sep)


def render_nested(col, sep: str = ";") -> Column:
    """array<array<...>> -> '[a,b];[c]'."""
    c = F.col(col) if isinstance(col, str) else col
    return F.array_join(F.transform(
        c, lambda a: F.when(a.isNull(), F.lit("NULL")).otherwise(
            F.concat(F.lit("["), render(a), F.lit("]")))), sep)
