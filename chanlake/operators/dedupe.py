"""Keep-one-row-per-key operators (W1, W3) as aggregates, not windows.

``DISTINCT ON (key) ... ORDER BY key, d DESC`` keeps the newest row per key.
Expressed as ``max_by(row, ordering)`` it is a declarative aggregate: Spark
plans a partial aggregate before the shuffle, so a key holding a third of all
rows is reduced to one row per map task before anything moves, instead of
sorting the whole hot group inside one window task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_latest(df: DataFrame, key: str | Sequence[str], order_by: str,
                nulls_first: bool = True, tiebreak: Sequence[str] | None = None) -> DataFrame:
    """Newest row per ``key`` by ``order_by`` descending.

    ``nulls_first`` follows Postgres ``DESC`` (NULL sorts first, so a NULL
    date wins). Ties on ``order_by`` are broken by ``tiebreak`` columns,
    largest first with NULL last, so the result is deterministic.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys]
    tiebreak = list(tiebreak) if tiebreak is not None else [c for c in rest if c != order_by]
    o = F.col(order_by)
    # struct ordering: NULL fields sort lowest, booleans false < true
    ordering = F.struct(o.isNull() if nulls_first else o.isNotNull(), o,
                        *[F.col(c) for c in tiebreak])
    row = F.struct(*[F.col(c) for c in rest])
    picked = df.groupBy(*keys).agg(F.max_by(row, ordering).alias("_row"))
    return picked.select(*keys, *[F.col("_row")[c].alias(c) for c in rest])
