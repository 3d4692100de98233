"""Explicit schemas; readers never infer."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields.items()])


STREAM_TRANSACTION = _struct(
    transaction_id=T.StringType(),
    customer_id=T.StringType(),
    amount=T.DoubleType(),
    timestamp=T.TimestampType(),
)

RAW_CUSTOMER = _struct(
    customer_id=T.StringType(),
    first_name=T.StringType(),
    last_name=T.StringType(),
    email=T.StringType(),
    phone=T.StringType(),
    country=T.StringType(),
    status=T.StringType(),
    age=T.LongType(),
)

RAW_TRANSACTION = _struct(
    transaction_id=T.StringType(),
    customer_id=T.StringType(),
    amount=T.StringType(),
    transaction_date=T.StringType(),
    currency=T.StringType(),
    status=T.StringType(),
)

VALIDATION_RESULT = _struct(
    meta=_struct(expectation_suite_name=T.StringType()),
    statistics=_struct(
        success_percent=T.DoubleType(),
        evaluated_expectations=T.LongType(),
        successful_expectations=T.LongType(),
        unsuccessful_expectations=T.LongType(),
    ),
)

BATCH_METRIC = _struct(
    pipeline=T.StringType(),
    batch_id=T.LongType(),
    started=T.TimestampType(),
    finished=T.TimestampType(),
    records=T.LongType(),
    status=T.StringType(),
)

OBSERVED_COUNTER = _struct(
    pipeline=T.StringType(),
    batch_id=T.LongType(),
    observed=T.StringType(),
    name=T.StringType(),
    value=T.LongType(),
)

LOAD_AUDIT = _struct(
    load_id=T.StringType(),
    table=T.StringType(),
    rows=T.LongType(),
    started=T.TimestampType(),
    finished=T.TimestampType(),
    status=T.StringType(),
)

# Dataframe-library type names used by type rules -> Spark type names.
TYPE_NAMES = {
    "bool": "boolean",
    "int8": "tinyint",
    "int16": "smallint",
    "int32": "int",
    "int64": "bigint",
    "float32": "float",
    "float64": "double",
    "str": "string",
    "object": "string",
    "datetime64[ns]": "timestamp",
}
