"""Schemas of many files checked against an expected one, footers and headers only."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..sources.files import file_listing

EXTENSIONS = {"parquet": ".parquet", "avro": ".avro"}


def _reader(file_format: str):
    """A task function from file paths to the fields of each file.

    Files are opened through the path's own file system and only the schema is
    read: the footer of a Parquet file, the metadata block that starts an Avro file.
    That works for stores the Arrow library opens (local, HDFS, S3, GCS, ABFS). Content that is no such file
    makes a file unreadable; a store that fails or is unknown makes the task fail, and Spark tries it again.
    """

    def parquet_fields(stream):
        import pyarrow.parquet as pq

        return {f.name: str(f.type) for f in pq.read_schema(stream)}

    def avro_fields(stream):
        import json

        def number():
            shift = raw = 0
            while True:
                byte = stream.read(1)[0]
                raw |= (byte & 127) << shift
                shift += 7
                if byte < 128:
                    return (raw >> 1) ^ -(raw & 1)

        def chunk():
            return stream.read(number())

        if stream.read(4) != b"Obj\x01":
            raise ValueError("not an Avro container file")
        while (entries := number()) != 0:
            if entries < 0:
                number()
            for _ in range(abs(entries)):
                name, value = chunk(), chunk()
                if name == b"avro.schema":
                    return {f["name"]: f["type"] if isinstance(f["type"], str) else json.dumps(f["type"], sort_keys=True)
                            for f in json.loads(value)["fields"]}
        raise ValueError("the header has no schema")

    fields_of = {"parquet": parquet_fields, "avro": avro_fields}[file_format]

    def read(batches):
        import re

        from pyarrow import fs

        for batch in batches:
            fields, errors = [], []
            for path in batch["path"]:
                # Spark's names for one store differ from the reader's.
                system, inner = fs.FileSystem.from_uri(re.sub("^s3[an]:", "s3:", path))
                with system.open_input_file(inner) as stream:
                    try:
                        fields.append(fields_of(stream))
                        errors.append(None)
                    except (ValueError, IndexError, KeyError) as error:  # the content, not the store
                        fields.append(None)
                        errors.append(f"{type(error).__name__}: {error}")
            yield batch.assign(fields=fields, error=errors)

    return read


def file_fields(spark: SparkSession, path: str, file_format: str) -> DataFrame:
    """``path, fields, error`` of every file of the format under a folder."""
    if file_format not in EXTENSIONS:
        raise ValueError(f"unsupported format {file_format!r}, expected one of {sorted(EXTENSIONS)}")
    paths = file_listing(spark, path, EXTENSIONS[file_format]).select("path")
    return paths.mapInPandas(_reader(file_format), "path string, fields map<string,string>, error string")


def audit_schema(spark: SparkSession, path: str, expected: Mapping[str, str], file_format: str = "parquet") -> DataFrame:
    """``path, field, expected, actual, verdict`` for every field on either side.

    Verdicts: ``ok``, ``missing``, ``mismatch``, ``extra`` (a warning only), and
    ``unreadable`` for a whole file. A Parquet type matches when the expected
    name occurs in the actual one, whatever the case; an Avro type when equal.
    """
    wanted = F.map_from_arrays(F.array(*[F.lit(n) for n in expected]), F.array(*[F.lit(t) for t in expected.values()]))
    names = F.when(F.col("error").isNotNull(), F.array(F.lit(None).cast("string"))).otherwise(
        F.array_union(F.map_keys(wanted), F.map_keys("fields")))
    rows = file_fields(spark, path, file_format).select("path", "fields", "error", F.explode(names).alias("field"))
    rows = rows.select("path", "error", "field", wanted[F.col("field")].alias("expected"),
                       F.col("fields")[F.col("field")].alias("actual"))
    if file_format == "avro":
        same = F.col("expected") == F.col("actual")
    else:
        same = F.contains(F.lower("actual"), F.lower("expected"))
    verdict = (F.when(F.col("error").isNotNull(), "unreadable").when(F.col("actual").isNull(), "missing")
               .when(F.col("expected").isNull(), "extra").when(same, "ok").otherwise("mismatch"))
    return rows.select("path", "field", "expected", "actual", verdict.alias("verdict"))


def file_verdicts(audit: DataFrame) -> DataFrame:
    """``path, valid``; additional fields do not make a file invalid."""
    return audit.groupBy("path").agg(F.bool_and(F.col("verdict").isin("ok", "extra")).alias("valid"))


def schema_differences(spark: SparkSession, actual: StructType, expected: StructType) -> DataFrame:
    """Field differences between two table schemas, for a check before loading."""
    def listed(schema: StructType, name: str) -> DataFrame:
        return spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in schema.fields],
                                     f"field string, {name} string")

    both = listed(expected, "expected").join(listed(actual, "actual"), "field", "full_outer")
    verdict = (F.when(F.col("actual").isNull(), "missing").when(F.col("expected").isNull(), "extra")
               .when(F.col("expected") == F.col("actual"), "ok").otherwise("mismatch"))
    return both.withColumn("verdict", verdict)
