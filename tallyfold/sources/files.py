"""File sources."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import ArrayType, StructType

from ..schemas import VALIDATION_RESULT

UNNAMED_SUITE = "unknown_suite"


def read_files(spark: SparkSession, path: str, file_format: str = "parquet", schema: StructType | None = None,
               extension: str | None = None, recursive: bool = False, **options) -> DataFrame:
    """A table of files; ``extension`` keeps only files whose name ends in it."""
    reader = spark.read.format(file_format).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    if extension is not None:
        reader = reader.option("pathGlobFilter", "*" + extension)
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    return reader.load(path)


def file_listing(spark: SparkSession, path: str, extension: str = "") -> DataFrame:
    """Path, size and time of the files under a folder; file contents are not read."""
    files = read_files(spark, path, "binaryFile", extension=extension, recursive=True)
    return files.select("path", F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))


def json_records(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Records landed as JSON: one per line, or arrays of records with one per element."""
    return read_files(spark, path, "json", schema)


def json_halves(spark: SparkSession, path: str, schema: StructType, multi_line: bool = False) -> tuple[DataFrame, DataFrame]:
    """``json_records``, and apart from them the texts that could not be read, in ``value``.

    A text is a line, or a whole file with ``multi_line``, and holds a record or an array of records.
    """
    texts = spark.read.text(path, wholetext=multi_line).where(F.trim("value") != "")
    parsed = texts.select("value", F.from_json("value", ArrayType(schema)).alias("_records"))
    return (parsed.where(F.col("_records").isNotNull()).select(F.inline("_records")),
            parsed.where(F.col("_records").isNull()).select("value"))


def _statistics(raw: DataFrame, *more: str) -> DataFrame:
    stats = [F.coalesce(F.col(f"statistics.{f.name}"), F.lit(0).cast(f.dataType)).alias(f.name)
             for f in VALIDATION_RESULT["statistics"].dataType.fields]
    return raw.select(F.coalesce("meta.expectation_suite_name", F.lit(UNNAMED_SUITE)).alias("suite"), *stats, *more)


def validation_results(spark: SparkSession, path: str) -> DataFrame:
    """Statistics of every ``.json`` validation result under a folder, missing values as defaults."""
    return _statistics(read_files(spark, path, "json", VALIDATION_RESULT, ".json", recursive=True, multiLine=True))


def start_validation_results(spark: SparkSession, path: str, table: str, checkpoint: str, every: str | None = "1 minute",
                             max_files: int = 1000) -> StreamingQuery:
    """``validation_results`` of files that the checkpoint has not seen, appended to ``table``; each file is read once.

    ``path`` may hold wildcards for folders. The rows also have the ``file`` they come from.
    """
    raw = (spark.readStream.schema(VALIDATION_RESULT).option("multiLine", True).option("recursiveFileLookup", True)
           .option("pathGlobFilter", "*.json").option("maxFilesPerTrigger", max_files).json(path))
    rows = _statistics(raw.withColumn("file", F.col("_metadata.file_path")), "file")
    writer = rows.writeStream.format("parquet").option("path", table).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)
    return writer.start()


def on_day(df: DataFrame, column: str, day: date) -> DataFrame:
    """Rows of one day, as a half-open range that file and database sources can apply themselves."""
    return df.where((F.col(column) >= F.lit(day)) & (F.col(column) < F.lit(day + timedelta(days=1))))


def day_before(df: DataFrame, column: str, run_date: date) -> DataFrame:
    return on_day(df, column, run_date - timedelta(days=1))
