"""The queries of this package and their SQL, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import alignment, boosting, decontaminate, language_model, packing, phrases, pii, quality, sharding, simhash, suffixes, urls, whitening

MODULES = (packing, decontaminate, simhash, urls, phrases, sharding, language_model, pii, quality, suffixes, alignment, whitening, boosting)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for m in MODULES for name, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.ORACLE_SQL.items()}
