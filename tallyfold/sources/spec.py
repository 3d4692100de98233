"""Sources chosen by configuration."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from .files import read_files
from .jdbc import JdbcTable, read_jdbc


def jdbc_table(spec: Mapping) -> JdbcTable:
    """``url, table`` and optionally ``fetch_size``; other entries go to the driver as they are."""
    own = ("type", "format", "url", "table", "fetch_size")
    return JdbcTable(spec["url"], spec["table"], int(spec.get("fetch_size", 10000)),
                     {k: str(v) for k, v in spec.items() if k not in own})


def read_source(spark: SparkSession, spec: Mapping, schema=None) -> DataFrame:
    """Open ``{"type": "jdbc" | "parquet" | "json" | ..., ...}``."""
    kind = spec["type"]
    if kind == "jdbc":
        return read_jdbc(spark, jdbc_table(spec))
    return read_files(spark, spec["path"], kind, schema, spec.get("extension"), bool(spec.get("recursive", False)))
