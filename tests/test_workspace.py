from types import SimpleNamespace

import pytest

from pyspark.sql import functions as F

from tallyfold import settings, workspace
from tallyfold.operators.ordered import moving_average, zscore_history
from tallyfold.operators.skew import heavy_keys
from tallyfold.settings import INITIAL_PARTITIONS, RECOMMENDED, initial_partitions, input_bytes, tune


def session(master, named=None, context_dir=None):
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: context_dir)
    return SimpleNamespace(conf=SimpleNamespace(get=lambda name, default: named), sparkContext=context)


def test_the_named_folder_is_used():
    assert workspace.shared_root(session("yarn", "hdfs://x/y/")) == "hdfs://x/y"
    assert workspace.shared_root(session("yarn", None, "hdfs://x/z")) == "hdfs://x/z"


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(RuntimeError):
        workspace.shared_root(session("spark://host:7077"))


def test_every_run_has_its_own_folder(spark):
    one, two = workspace.run_dir(spark, "a"), workspace.run_dir(spark, "a")
    assert one != two and one.startswith(spark.conf.get("spark.checkpoint.dir"))


def test_given_settings_stay(spark):
    tune(spark)
    assert all(spark.conf.get(name) == value for name, value in RECOMMENDED.items())


def test_shuffles_start_with_enough_partitions(spark):
    assert initial_partitions(spark) == 8
    try:
        assert initial_partitions(tune(spark, shuffle_bytes=1 << 40)) == 8192
        assert initial_partitions(tune(spark, shuffle_bytes=100 << 40)) == settings.MAX_PARTITIONS == 20_000
        assert initial_partitions(tune(spark, shuffle_bytes=1)) == 8
    finally:
        spark.conf.unset(INITIAL_PARTITIONS)


def test_scratch_folders_go_after_the_action(spark, tmp_path):
    root = workspace.shared_root(spark)
    before = set(workspace.subfolders(spark, root))
    tx = spark.range(60).select((F.col("id") % 3).cast("string").alias("customer_id"), F.col("id").cast("double").alias("amount"),
                                F.col("id").alias("order"))
    with workspace.scratch(spark):
        zscore_history(tx).write.parquet(str(tmp_path / "a"))
        moving_average(tx, order_by=["order"], heavy=heavy_keys(tx, "customer_id", min_rows=5)).write.parquet(str(tmp_path / "b"))
        assert set(workspace.subfolders(spark, root)) > before
    assert set(workspace.subfolders(spark, root)) == before
    assert spark.read.parquet(str(tmp_path / "b")).count() == 60


def test_shuffles_follow_the_size_of_the_input(spark, tmp_path, monkeypatch):
    spark.range(1000).write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    assert 1000 < input_bytes(table) < 100_000 and input_bytes(table, table) == 2 * input_bytes(table)
    monkeypatch.setattr(settings, "input_bytes", lambda *tables: 1 << 40)
    with settings.sized_for(table):
        assert initial_partitions(spark) == 2 * 8192
        plan = table.groupBy("id").count()
        assert "hashpartitioning(id" in plan._jdf.queryExecution().executedPlan().toString()
        assert "16384" in plan._jdf.queryExecution().executedPlan().toString()
    assert initial_partitions(spark) == 8


def test_inputs_of_unknown_size(spark, tmp_path):
    """In-line rows and database tables come with 8 EiB, which is no size."""
    rows = spark.createDataFrame([(1,)], "id int")
    spark.range(1000).write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    assert input_bytes(rows) == 0 and input_bytes(rows, table) == input_bytes(table) > 0
    assert input_bytes(table.join(rows.withColumn("more", F.lit(1)), "id")) == input_bytes(table)
    with settings.sized_for(rows, table):
        assert initial_partitions(spark) == 8


def test_runs_follow_the_measured_pieces(spark):
    heavy = heavy_keys(spark.range(1000).select(F.lit("h").alias("k")), "k", shares=100, min_rows=10)
    assert heavy.pieces == 100
