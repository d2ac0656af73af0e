"""Registered queries: key -> (Spark job over a data directory, DuckDB twin).

Every job reads the driver tables of ``sf_dir`` (through the bindings) so
its work grows with the data; the twin computes the same result in DuckDB
over the same Parquet files and is the correctness oracle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
TWINS: dict[str, str] = {}


def register(key: str, twin: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if twin is not None:
            TWINS[key] = twin
        return fn

    return deco


def load_all() -> None:
    """Import every query module (registration happens at import)."""
    from perkline.queries import (  # noqa: F401
        functions_q,
        ingest_q,
        mutations_q,
        notify_q,
        quality_q,
        sources_q,
        views_q,
    )
