"""Weekly job: rules, statistics, report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..quality.report import concat_results, quality_metrics, stamp_run, suite_statistics, with_level
from ..quality.rules import Rule
from ..quality.suite import run_suite
from ..settings import sized_for
from ..sinks.warehouse import Target, save
from ..workspace import scratch


def suite_results(tables: Mapping[str, DataFrame], suites: Mapping[str, Sequence[Rule]], *,
                  as_of: datetime | None = None, references: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Rule results of several suites; ``tables`` and ``suites`` share their names."""
    return concat_results([run_suite(tables[name], name, rules, references=references or tables, as_of=as_of)
                           for name, rules in suites.items()])


def store_quality(tables: Mapping[str, DataFrame], suites: Mapping[str, Sequence[Rule]], target: Target, run_id: str,
                  run_ts: datetime, references: Mapping[str, DataFrame] | None = None) -> None:
    """Append the results of one run, then the report row computed from what was stored."""
    spark = next(iter(tables.values())).sparkSession
    with sized_for(*tables.values()), scratch(spark):
        results = stamp_run(suite_results(tables, suites, as_of=run_ts, references=references), run_id, run_ts)
        save(results, "quality_results", target, "append")
        stored = (spark.read.format(target.format).options(**target.writer_options("quality_results")).load()
                  .where(F.col("run_id") == run_id))
        report = with_level(quality_metrics(suite_statistics(stored)))
        save(stamp_run(report, run_id, run_ts), "quality_reports", target, "append")
