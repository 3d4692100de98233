"""The registered form of a job against the obvious form, at one scale."""

import json
import time

import bench
from tallyfold.operators.clean import clean_transactions, standardise_customers, standardise_transactions
from tallyfold.plans.batch import joined_transactions
from tallyfold.quality.report import concat_results
from tallyfold.quality.rules import TRANSACTION_SUITE
from tallyfold.quality.suite import run_suite
from tallyfold.settings import tune
from tallyfold.workload.batch import newest_first
from tallyfold.workload.tables import crm_raw, tx_raw


def fastest(build):
    times = []
    for _ in range(bench.RUNS):
        start = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        times.append(time.perf_counter() - start)
    return round(min(times), 3)


def main():
    spark = tune(bench.session(bench.tempfile.mkdtemp(prefix="tallyfold-compare-")))
    spark.sparkContext.setLogLevel("ERROR")
    crm, tx = crm_raw(spark, bench.SF_DIR), tx_raw(spark, bench.SF_DIR)
    std = standardise_transactions(tx)

    def any_row_joined():
        people = standardise_customers(crm).dropDuplicates(["customer_id"]).withColumnsRenamed(
            {"status": "crm_status", "ingest_seq": "crm_ingest_seq"})
        return std.dropDuplicates(["transaction_id"]).join(people, "customer_id", "left")

    took = {
        "suite in one pass": lambda: run_suite(std, "t", TRANSACTION_SUITE),
        "suite rule by rule": lambda: concat_results([run_suite(std, "t", [rule]) for rule in TRANSACTION_SUITE]),
        "ordered dedup": lambda: clean_transactions(tx, newest_first()),
        "dropDuplicates": lambda: std.dropDuplicates(["transaction_id"]),
        "ordered dedup, skew measured, join": lambda: joined_transactions(tx, crm, latest_first=newest_first()),
        "dropDuplicates, join": any_row_joined,
    }
    print(json.dumps({name: fastest(build) for name, build in took.items()}, indent=1))
    spark.stop()


if __name__ == "__main__":
    main()
