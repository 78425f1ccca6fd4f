"""Date functions (D1-D4, S13). Session time zone is UTC (see session.py)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SQL_FORMAT = "yyyy-MM-dd HH:mm:ss"   # TO_TIMESTAMP(text, 'YYYY-MM-DD HH24:MI:SS')


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_sql_timestamp(col) -> Column:
    """Fixed-format parse; malformed input gives NULL instead of failing."""
    return F.try_to_timestamp(_c(col), F.lit(SQL_FORMAT))


def coerce_timestamp(col, as_of: str) -> Column:
    """Parse any ISO-8601 spelling (an offset converts to UTC; a naive
    value is taken as UTC); unparsable or NULL -> ``as_of``."""
    return F.coalesce(F.try_to_timestamp(_c(col)), F.lit(as_of).cast("timestamp"))


def to_utc(col, zone: str | None = None) -> Column:
    """A naive wall-clock value in ``zone`` (default: already UTC) -> UTC."""
    c = _c(col)
    ts = c.cast("timestamp")
    return F.to_utc_timestamp(ts, zone) if zone else ts


def iso_format(col) -> Column:
    """``datetime.isoformat()``: seconds, plus ``.ffffff`` only when the
    microseconds are non-zero."""
    c = _c(col)
    micros = F.date_format(c, "SSSSSS")
    base = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
    return F.when(micros == F.lit("000000"), base).otherwise(F.concat(base, F.lit("."), micros))


def sql_format(col) -> Column:
    return F.date_format(_c(col), SQL_FORMAT)
