"""All queries of the library and their SQL, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import disruption, explore, files, ingest, live, models, monitoring, nowcasts, panels, parsers, prices, seasons, shifts, streams, tables, vessels, warnings

MODULES = (vessels, panels, monitoring, explore, ingest, streams, models, warnings, disruption, seasons, shifts, tables, parsers, nowcasts, prices, live, files)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for m in MODULES for name, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.ORACLE_SQL.items()}
