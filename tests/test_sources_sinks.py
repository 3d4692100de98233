import json
from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyfold.plans.batch import run_batch
from tallyfold.plans.quality import store_quality
from tallyfold.quality.rules import Rule
from tallyfold.schemas import LOAD_AUDIT, RAW_CUSTOMER
from tallyfold.sinks import warehouse
from tallyfold.sinks.audit import (TooManyBadRecords, audited_save, check_bad_records, prune_audit, read_audit, save_within_limit,
                                   within_retention)
from tallyfold.sinks.keyed_log import KeyedLog
from tallyfold.sinks.layout import land_extract, save_partitioned
from tallyfold.sources.files import (day_before, file_listing, json_halves, json_records, on_day, read_files,
                                     start_validation_results, validation_results)
from tallyfold.sources.jdbc import JdbcTable, split_options
from tallyfold.sources.kafka import kafka_options
from tallyfold.sources.spec import jdbc_table, read_source


def test_jdbc_options():
    source = jdbc_table({"type": "jdbc", "format": "postgres", "url": "jdbc:x", "table": "t", "user": "u", "fetch_size": 5})
    assert source == JdbcTable("jdbc:x", "t", 5, {"user": "u"})
    assert source.options() == {"user": "u", "url": "jdbc:x", "dbtable": "t", "fetchsize": "5"}
    assert JdbcTable("jdbc:x", "t").options()["fetchsize"] == "10000"
    assert split_options("d", 1, 9, 4) == {"partitionColumn": "d", "lowerBound": "1", "upperBound": "9", "numPartitions": "4"}


def test_kafka_options():
    assert kafka_options("h:1", "t") == {"kafka.bootstrap.servers": "h:1", "subscribe": "t", "startingOffsets": "latest"}
    more = kafka_options("h:1", "t", "earliest", 1000, False)
    assert (more["startingOffsets"], more["maxOffsetsPerTrigger"], more["failOnDataLoss"]) == ("earliest", "1000", "false")


def test_day_is_a_pushed_range(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    plan = day_before(orders, "o_orderdate", date(1998, 9, 2))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate,1998-09-01" in plan and "LessThan(o_orderdate,1998-09-02" in plan


def test_day_bounds(spark):
    df = spark.createDataFrame([(datetime(2025, 1, 1, h, m),) for h, m in ((0, 0), (23, 59))] + [(datetime(2025, 1, 2),)], "t timestamp_ntz")
    assert on_day(df, "t", date(2025, 1, 1)).count() == 2


def test_files(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.json").write_text('{"customer_id": "1", "age": 3}\n{"customer_id": "2"}\n')
    (tmp_path / "a" / "y.txt").write_text("no")
    assert read_files(spark, str(tmp_path), "json", RAW_CUSTOMER, ".json", recursive=True).count() == 2
    listing = file_listing(spark, str(tmp_path), ".txt").collect()
    assert len(listing) == 1 and listing[0].bytes == 2
    assert read_source(spark, {"type": "json", "path": str(tmp_path / "a"), "extension": ".json"}, RAW_CUSTOMER).count() == 2


def test_json_arrays(spark, tmp_path):
    (tmp_path / "c.json").write_text(json.dumps([{"customer_id": "1"}, {"customer_id": "2", "extra": 1}]))
    assert json_records(spark, str(tmp_path), RAW_CUSTOMER).count() == 2


def test_validation_results(spark, tmp_path):
    full = {"meta": {"expectation_suite_name": "s", "other": 1},
            "statistics": {"success_percent": 50.0, "evaluated_expectations": 2, "successful_expectations": 1, "unsuccessful_expectations": 1}}
    for name, content in (("a/1.json", full), ("a/b/2.json", {"meta": {}}), ("3.json", {"statistics": {"success_percent": 100}})):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(json.dumps(content, indent=2))
    (tmp_path / "notes.txt").write_text("x")
    got = sorted(map(tuple, validation_results(spark, str(tmp_path)).collect()))
    assert got == [("s", 50.0, 2, 1, 1), ("unknown_suite", 0.0, 0, 0, 0), ("unknown_suite", 100.0, 0, 0, 0)]


def test_targets():
    targets = {"snowflake": warehouse.snowflake(sfURL="u"), "bigquery": warehouse.bigquery("p", "d", "b")}
    assert warehouse.pick_target(targets, "SnowFlake").writer_options("T") == {"sfURL": "u", "dbtable": "T"}
    assert targets["bigquery"].writer_options("t") == {"temporaryGcsBucket": "b", "table": "p:d.t"}
    assert warehouse.jdbc("jdbc:x").writer_options("t") == {"url": "jdbc:x", "batchsize": "500", "dbtable": "t"}
    with pytest.raises(ValueError):
        warehouse.pick_target(targets, "SnowFlake", ignore_case=False)
    with pytest.raises(ValueError):
        warehouse.pick_target(targets, "oracle")


def test_dispositions():
    assert warehouse.save_mode("WRITE_APPEND") == "append"
    assert warehouse.save_mode("WRITE_TRUNCATE", "CREATE_NEVER") == "overwrite"
    with pytest.raises(ValueError):
        warehouse.save_mode("WRITE_APPEND", "CREATE_NEVER", table_exists=False)
    with pytest.raises(ValueError):
        warehouse.save_mode("WRITE_APPEND", "CREATE_SOMETIMES")


def test_save_load_sink(spark, tmp_path):
    targets = {"files": warehouse.files(str(tmp_path))}
    df = spark.range(7)
    assert warehouse.load(df, "t", targets, "FILES") == 7
    assert warehouse.sink(df, "t", targets, "files") == 7
    assert spark.read.parquet(str(tmp_path / "t")).count() == 14
    assert warehouse.load(df.limit(0), "t", targets, "files") == 0
    assert warehouse.save(df, "t", targets["files"], prefix="prod_") == 7
    assert spark.read.parquet(str(tmp_path / "prod_t")).count() == 7


def test_audit(spark, tmp_path):
    log = str(tmp_path / "log")
    done = audited_save(spark.range(3), "t", warehouse.files(str(tmp_path)), log, prefix="prod_")
    with pytest.raises(Exception):
        audited_save(spark.range(3), "t", warehouse.Target("no-such-format", "path"), log)
    got = {r.load_id: r for r in read_audit(spark, log).collect()}
    assert len(got) == 2
    assert (got[done].table, got[done].rows, got[done].status) == ("prod_t", 3, "ok")
    assert [(r.rows, r.status) for k, r in got.items() if k != done] == [(None, "error")]


def test_unreadable_json_is_kept_apart(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"k": 1}\n[\n\n{"k": 3}\n]\n{bad\n[{"k": 4}, {"k": 5}]\n')
    schema = StructType.fromDDL("k int")
    good, bad = json_halves(spark, str(tmp_path / "a.json"), schema)
    assert sorted(r.k for r in good.collect()) == [1, 3, 4, 5]
    assert sorted(r.value for r in bad.collect()) == ["[", "]", "{bad"]
    (tmp_path / "b.json").write_text('[\n{"k": 2},\n{"k": 3}\n]')
    good, bad = json_halves(spark, str(tmp_path / "b.json"), schema, multi_line=True)
    assert sorted(r.k for r in good.collect()) == [2, 3] and bad.count() == 0


def test_retention(spark):
    as_of = datetime(2025, 3, 31, tzinfo=timezone.utc)
    rows = [(str(d), "t", 1, None, as_of - timedelta(days=d), "ok") for d in (0, 30, 31)]
    kept = within_retention(spark.createDataFrame(rows, LOAD_AUDIT), F.lit(as_of))
    assert sorted(r.load_id for r in kept.collect()) == ["0", "30"]


def test_prune(spark, tmp_path):
    log = str(tmp_path / "log")
    audited_save(spark.range(1), "t", warehouse.files(str(tmp_path)), log)
    prune_audit(spark, log, F.current_timestamp())
    assert read_audit(spark, log).count() == 1
    prune_audit(spark, log, F.current_timestamp() + F.expr("interval 31 days"))
    assert read_audit(spark, log).count() == 0
    assert [p.name for p in tmp_path.iterdir() if "kept" in p.name] == []


def test_schema_is_checked_before_a_load(spark):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    warehouse.check_schema(df, StructType.fromDDL("a int"))
    with pytest.raises(warehouse.SchemaMismatch, match="b: expected int, got string; c: expected int, got nothing"):
        warehouse.check_schema(df, StructType.fromDDL("a int, b int, c int"))


def test_bad_record_limit(spark):
    check_bad_records(spark.range(5))
    with pytest.raises(TooManyBadRecords):
        check_bad_records(spark.range(6))


def test_partitions_are_replaced_one_by_one(spark, tmp_path):
    path = str(tmp_path / "days")
    rows = [("1", date(2025, 1, 1), 1), ("2", date(2025, 1, 1), 2), ("1", date(2025, 1, 2), 3), ("1", None, 4)]
    df = spark.createDataFrame(rows, "customer_id string, transaction_date date, v int")
    assert save_partitioned(df, path) == 4
    assert save_partitioned(df.where("v = 3").withColumn("v", F.lit(30)), path) == 1
    back = spark.read.parquet(path)
    assert sorted(r.v for r in back.collect()) == [1, 2, 4, 30]
    plan = back.where("transaction_date = date'2025-01-02'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(transaction_date" in plan


def test_a_large_folder_is_written_by_several_tasks(spark, tmp_path):
    path = str(tmp_path / "skewed")
    day = F.when(F.col("id") % 10 == 0, F.lit("2025-01-02")).otherwise(F.lit("2025-01-01")).cast("date")
    rows = spark.range(0, 400_000, 1, 16).select(F.xxhash64("id").cast("string").alias("customer_id"), day.alias("transaction_date"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        save_partitioned(rows, path)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list((tmp_path / "skewed" / "transaction_date=2025-01-01").glob("*.parquet"))) > 3
    assert spark.read.parquet(path).count() == 400_000


def test_landing_twice_leaves_one_copy(spark, tmp_path):
    path = str(tmp_path / "landed")
    for day in (date(2025, 1, 1), date(2025, 1, 2), date(2025, 1, 2)):
        land_extract(spark.range(3), path, day)
    assert spark.read.parquet(path).groupBy("extraction_date").count().orderBy("extraction_date").collect() == [
        (date(2025, 1, 1), 3), (date(2025, 1, 2), 3)]


def test_keyed_log(spark, tmp_path):
    schema = spark.createDataFrame([], "k string, v int").schema
    log = KeyedLog(str(tmp_path / "log"), ["k"], schema)
    log.create(spark)
    assert log.current(spark).count() == 0
    log.write(spark.createDataFrame([("a", 1), ("b", 1)], schema), 0)
    for _ in range(2):
        log.write(spark.createDataFrame([("a", 2)], schema), 10)
    log.write(spark.createDataFrame([("a", 3)], schema), 9)
    assert sorted(map(tuple, log.current(spark).collect())) == [("a", 2), ("b", 1)]
    packed = log.compact(spark, str(tmp_path / "packed"))
    assert packed.history(spark).count() == 2 and packed.current(spark).count() == 2


def test_run_batch_by_day(spark, tmp_path):
    tx = spark.createDataFrame([("t1", "1", "5", "2025-01-01", "usd", "SUCCESS"), ("t1", "1", "5", "2025-01-01", "usd", "SUCCESS"),
                                ("t2", None, "x", "bad", "eur", "FAILED")],
                               "transaction_id string, customer_id string, amount string, transaction_date string, currency string, status string")
    crm = spark.createDataFrame([("1", "A", "B", "a@b.c", "1", "fr", "active", 30)], RAW_CUSTOMER)
    path = str(tmp_path / "out")
    assert run_batch(tx, crm, path, run_ts=datetime(2025, 1, 2)) == 2
    got = {r.transaction_id: r for r in spark.read.parquet(path).collect()}
    assert got["t1"].crm_status == "active" and got["t1"].status == "SUCCESS" and got["t1"].transaction_date == date(2025, 1, 1)
    assert got["t2"].full_name is None and got["t2"].transaction_date is None
    assert got["t1"].etl_timestamp == datetime(2025, 1, 2)


def test_store_quality(spark, tmp_path):
    target = warehouse.files(str(tmp_path))
    tables = {"a": spark.createDataFrame([(1,), (None,)], "x int"), "b": spark.createDataFrame([(1,)], "y int")}
    suites = {"a": [Rule("not_null", "x"), Rule("unique", "x")],
              "b": [Rule("exists_in", "y", reference_table="a", reference_column="x")]}
    for run in ("r1", "r2"):
        store_quality(tables, suites, target, run, datetime(2025, 1, 1))
    assert spark.read.parquet(str(tmp_path / "quality_results")).count() == 6
    reports = spark.read.parquet(str(tmp_path / "quality_reports")).orderBy("run_id").collect()
    assert [(r.run_id, r.global_success_rate, r.total_checks, r.total_failures, r.level) for r in reports] == [
        (run, 75.0, 3, 1, "Critique") for run in ("r1", "r2")]


def test_too_many_bad_records_leave_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    rows, bad = spark.range(20), F.col("id") % 4 == 0
    assert save_within_limit(rows, bad, path, limit=5) == 15
    with pytest.raises(TooManyBadRecords):
        save_within_limit(spark.range(100), bad, path, limit=5)
    assert spark.read.parquet(path).count() == 15 and list((tmp_path / "t.waiting").glob("load=*")) == []
    assert save_within_limit(spark.range(3), F.lit(None).cast("boolean"), path) == 3
    assert spark.read.parquet(path).count() == 18
    assert save_within_limit(spark.range(7), bad, path, mode="overwrite") == 5
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [1, 2, 3, 5, 6]


def test_validation_results_are_read_once(spark, tmp_path):
    source, out, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ck")

    def result(name, evaluated):
        file = source / name
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_text('{"meta": {"expectation_suite_name": "%s"},\n "statistics": {"evaluated_expectations": %d}}' % (file.parent.name, evaluated))

    def run():
        start_validation_results(spark, str(source), out, checkpoint, every=None).awaitTermination()
        return sorted((r.suite, r.evaluated_expectations, r.successful_expectations) for r in spark.read.parquet(out).collect())

    result("a/1.json", 3)
    result("b/deep/1.json", 4)
    (source / "a" / "note.txt").write_text("no result")
    assert run() == [("a", 3, 0), ("deep", 4, 0)] and run() == [("a", 3, 0), ("deep", 4, 0)]
    result("a/2.json", 5)
    result("a/1.json", 3)  # an old name is an old file
    assert run() == [("a", 3, 0), ("a", 5, 0), ("deep", 4, 0)] == sorted(
        (r.suite, r.evaluated_expectations, r.successful_expectations) for r in validation_results(spark, str(source)).collect())
