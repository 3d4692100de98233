"""One way to save a table, whatever the target."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


@dataclass(frozen=True)
class Target:
    """A connector: its format, the option that carries the table, and its fixed options."""

    format: str
    table_option: str
    options: Mapping[str, str] = field(default_factory=dict)
    table_layout: str = "{table}"

    def writer_options(self, table: str) -> dict[str, str]:
        return {**self.options, self.table_option: self.table_layout.format(table=table)}


def snowflake(**connection: str) -> Target:
    """``connection`` holds the connector's own options: sfURL, sfDatabase, sfSchema, ..."""
    return Target("snowflake", "dbtable", connection)


def bigquery(project: str, dataset: str, temp_bucket: str) -> Target:
    return Target("bigquery", "table", {"temporaryGcsBucket": temp_bucket}, f"{project}:{dataset}.{{table}}")


def jdbc(url: str, batch_size: int = 500, **properties: str) -> Target:
    return Target("jdbc", "dbtable", {**properties, "url": url, "batchsize": str(batch_size)})


def files(root: str, file_format: str = "parquet", max_records_per_file: int | None = None) -> Target:
    options = {} if max_records_per_file is None else {"maxRecordsPerFile": str(max_records_per_file)}
    return Target(file_format, "path", options, root.rstrip("/") + "/{table}")


def pick_target(targets: Mapping[str, Target], name: str, *, ignore_case: bool = True) -> Target:
    """Batch loads accept any case of the name; the streaming router wants it exact."""
    known = {k.lower(): t for k, t in targets.items()} if ignore_case else targets
    wanted = name.lower() if ignore_case else name
    if wanted not in known:
        raise ValueError(f"unknown target {name!r}, expected one of {sorted(targets)}")
    return known[wanted]


# Write dispositions of the warehouse and the save modes they stand for.
WRITE_DISPOSITIONS = {"WRITE_APPEND": "append", "WRITE_TRUNCATE": "overwrite", "WRITE_EMPTY": "error"}
CREATE_DISPOSITIONS = ("CREATE_IF_NEEDED", "CREATE_NEVER")


def save_mode(write_disposition: str, create_disposition: str = "CREATE_IF_NEEDED", table_exists: bool = True) -> str:
    if create_disposition not in CREATE_DISPOSITIONS:
        raise ValueError(f"unknown create disposition {create_disposition!r}")
    if create_disposition == "CREATE_NEVER" and not table_exists:
        raise ValueError("the table does not exist and may not be created")
    return WRITE_DISPOSITIONS[write_disposition]


class SchemaMismatch(ValueError):
    pass


def check_schema(df: DataFrame, expected: StructType) -> None:
    """Fail before a load when a column is missing or has another type; additional columns pass."""
    actual = {f.name: f.dataType for f in df.schema.fields}
    wrong = [f"{f.name}: expected {f.dataType.simpleString()}, "
             f"got {actual[f.name].simpleString() if f.name in actual else 'nothing'}"
             for f in expected.fields if actual.get(f.name) != f.dataType]
    if wrong:
        raise SchemaMismatch("; ".join(wrong))


def save(df: DataFrame, table: str, target: Target, mode: str = "append", prefix: str = "") -> int:
    """Write and return the row count, which is observed while writing rather than counted again."""
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    counted.write.format(target.format).options(**target.writer_options(prefix + table)).mode(mode).save()
    return seen.get["rows"]


def load(df: DataFrame, table: str, targets: Mapping[str, Target], name: str, *, expected: StructType | None = None,
         write: str = "WRITE_TRUNCATE", create: str = "CREATE_IF_NEEDED", table_exists: bool = True, prefix: str = "") -> int:
    """Batch load: replaces the table, unless ``write`` says otherwise; ``expected`` is checked before anything is written."""
    if expected is not None:
        check_schema(df, expected)
    return save(df, table, pick_target(targets, name), save_mode(write, create, table_exists), prefix)


def sink(df: DataFrame, table: str, targets: Mapping[str, Target], name: str, *, write: str = "WRITE_APPEND",
         create: str = "CREATE_IF_NEEDED", table_exists: bool = True, prefix: str = "") -> int:
    """Streaming router: appends, unless ``write`` says otherwise."""
    return save(df, table, pick_target(targets, name, ignore_case=False), save_mode(write, create, table_exists), prefix)
