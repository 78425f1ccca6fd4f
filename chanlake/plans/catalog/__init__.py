"""Registered queries: each key pairs a Spark job over the driver tables with
an equivalent DuckDB SQL text (the oracle). Result columns are plain scalars:
arrays are rendered to strings and timestamps formatted, so both sides hash
the same way. One module per operator group; importing them registers the
queries in this order."""

from chanlake.plans.catalog._base import ORACLES, QUERIES, prepare, register  # noqa: F401
from chanlake.plans.catalog import (  # noqa: F401  (registration on import)
    text_queries, warehouse_queries, album_queries, read_queries, file_queries, stream_queries,
    model_queries,
)
