"""Message stream source. The connector is supplied with the session."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def kafka_options(servers: str, topic: str, starting: str = "latest", max_per_trigger: int | None = None,
                  fail_on_data_loss: bool | None = None) -> dict[str, str]:
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting}
    if max_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    if fail_on_data_loss is not None:
        options["failOnDataLoss"] = str(fail_on_data_loss).lower()
    return options


def read_kafka(spark: SparkSession, servers: str, topic: str, **limits) -> DataFrame:
    return spark.readStream.format("kafka").options(**kafka_options(servers, topic, **limits)).load()
