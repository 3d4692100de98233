"""Standard form of the two raw tables."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import cleaning as c
from .dedup import dedup_by_key


def standardise_customers(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "email": c.squeezed_lower(F.col("email")),
        "phone": c.ascii_digits(F.col("phone")),
        "country": c.squeezed_upper(F.col("country")),
        "is_active": c.flag(F.col("status") == "active"),
        "full_name": c.joined_name(F.col("first_name"), F.col("last_name")),
    })


def standardise_transactions(df: DataFrame) -> DataFrame:
    """Values that cannot be read become null; ``is_valid`` judges the number, not the text."""
    amount = c.lenient_double(F.col("amount"))
    return df.withColumns({
        "transaction_date": c.lenient_day(F.col("transaction_date"), df.schema["transaction_date"].dataType),
        "amount": amount,
        "currency": c.squeezed_upper(F.col("currency")),
        "is_valid": F.coalesce(amount > 0, F.lit(False)),
    })


def clean_customers(df: DataFrame, latest_first: Sequence[Column] = (), null_keys: str = "collapse") -> DataFrame:
    return dedup_by_key(standardise_customers(df), ["customer_id"], latest_first, null_keys)


def clean_transactions(df: DataFrame, latest_first: Sequence[Column] = (), null_keys: str = "collapse") -> DataFrame:
    return dedup_by_key(standardise_transactions(df), ["transaction_id"], latest_first, null_keys)


def normalise_names(df: DataFrame) -> DataFrame:
    """Lower-case column names with underscores for spaces and dashes."""
    names = [re.sub(r"[ -]", "_", name.lower()) for name in df.columns]
    clashes = sorted(name for name, n in Counter(names).items() if n > 1)
    if clashes:
        raise ValueError(f"columns fall together after renaming: {clashes}")
    return df.toDF(*names)


def mask_customers(df: DataFrame, masked: Sequence[str] = ("phone",), hashed: Sequence[str] = ("email",)) -> DataFrame:
    return df.withColumns({
        **{name: c.masked_text(F.col(name)) for name in masked},
        **{name: c.hashed_text(F.col(name)) for name in hashed},
    })
