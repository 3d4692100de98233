"""Session settings the jobs are meant to run with."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

RECOMMENDED = {
    # Re-plan joins and partition sizes at run time.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Skip the sort of a shuffled join when every partition of one side is measured to be small enough to hash.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
}


# Bytes one shuffle task should get; partitions that turn out smaller are merged at run time.
TASK_BYTES = 128 << 20
# A shuffle of more partitions costs more in bookkeeping than its smaller tasks save; beyond it tasks get more bytes.
MAX_PARTITIONS = 20_000
# Rows are wider in a shuffle than in a compressed columnar file.
SHUFFLED_PER_STORED = 2
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
# Rows of whole texts in one Arrow batch.
BATCH_ROWS = 1024
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def tune(spark: SparkSession, shuffle_bytes: int | None = None) -> SparkSession:
    """Apply the settings that the session leaves at Spark's default.

    ``shuffle_bytes`` is the expected size of the largest shuffle of a batch
    job; shuffles then start with enough partitions for it to fit in memory, ``MAX_PARTITIONS`` at most.
    """
    given = {name for name, _ in spark.sparkContext.getConf().getAll()}
    for name, value in RECOMMENDED.items():
        if name not in given:
            spark.conf.set(name, value)
    if shuffle_bytes is not None:
        wanted = min(-(-shuffle_bytes // TASK_BYTES), MAX_PARTITIONS)
        spark.conf.set(INITIAL_PARTITIONS, str(max(wanted, _shuffle_partitions(spark))))
    return spark


def tune_batches(spark: SparkSession) -> SparkSession:
    """Rows that Python gets at a time, where the session leaves them at Spark's default.

    A batch of texts is held several times over: in the vectors of the executor, which grow by doubling, and in the worker.
    """
    if ARROW_ROWS not in {name for name, _ in spark.sparkContext.getConf().getAll()}:
        spark.conf.set(ARROW_ROWS, str(BATCH_ROWS))
    return spark


@contextmanager
def batch_rows(spark: SparkSession, rows: int):
    """Inside, Python gets at most so many rows at a time. For queries that run inside; rows there are large ones."""
    before = spark.conf.get(ARROW_ROWS)
    if int(before) <= 0 or int(before) > rows:
        spark.conf.set(ARROW_ROWS, str(rows))
    try:
        yield
    finally:
        spark.conf.set(ARROW_ROWS, before)


def input_bytes(*tables: DataFrame, unknown: int = 0) -> int:
    """Size of what the tables are read from, by the optimiser's statistics of their leaves; no job is run.

    A leaf of unknown size, such as a database table or rows given in line, has Spark's default size and counts as
    ``unknown``; with nothing, its shuffles start with the session's number of partitions.
    """
    default = tables[0].sparkSession._jsparkSession.sessionState().conf().defaultSizeInBytes()
    total = 0
    for df in tables:
        leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
        sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
        total += sum(size if size < default else unknown for size in sizes)
    return total


def folder_bytes(spark: SparkSession, path: str) -> int:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(place).getLength()


@contextmanager
def sized_for(*tables: DataFrame):
    """Inside, shuffles start with enough partitions for all of the tables to be moved."""
    spark = tables[0].sparkSession
    before = spark.conf.get(INITIAL_PARTITIONS, None)
    tune(spark, SHUFFLED_PER_STORED * input_bytes(*tables))
    try:
        yield
    finally:
        spark.conf.unset(INITIAL_PARTITIONS) if before is None else spark.conf.set(INITIAL_PARTITIONS, before)


def _shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def initial_partitions(spark: SparkSession) -> int:
    """Partitions a batch shuffle starts with."""
    return int(spark.conf.get(INITIAL_PARTITIONS, None) or _shuffle_partitions(spark))
