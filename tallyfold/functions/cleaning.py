"""Text, number and date clean-up that never raises on bad input."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, types as T
from pyspark.sql import functions as F

DAY_FORMAT = "yyyy-MM-dd"
ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss"


def squeezed_lower(c: Column) -> Column:
    """Outer spaces (only spaces) removed, lower case."""
    return F.lower(F.trim(c))


def squeezed_upper(c: Column) -> Column:
    return F.upper(F.trim(c))


def ascii_digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def joined_name(*parts: Column) -> Column:
    """Null parts are left out; all parts null gives an empty string."""
    return F.concat_ws(" ", *parts)


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it does not or is unknown."""
    return F.coalesce(condition.cast("int"), F.lit(0))


def lenient_double(c: Column) -> Column:
    return c.try_cast("double")


def lenient_day(c: Column, dtype: T.DataType) -> Column:
    """Day of a date, a timestamp, or text in ``yyyy-MM-dd``; anything else is null."""
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return c.cast("date")
    return F.try_to_date(c, DAY_FORMAT)


def cast_or(c: Column, dtype: str, default) -> Column:
    """Value in another type, the default where it has none. Null input gives the default too."""
    return F.coalesce(c.try_cast(dtype), F.lit(default).cast(dtype))


def days_before(day: Column, n: int = 1) -> Column:
    return F.date_sub(day, n)


def iso_text(ts: Column, zone: str = "UTC") -> Column:
    """Wall-clock time of an instant in ``zone``, to the second."""
    return F.date_format(F.convert_timezone(None, F.lit(zone), ts.cast("timestamp_ntz")), ISO_SECONDS)


def masked_text(c: Column) -> Column:
    """Letters and digits replaced, length and punctuation kept."""
    return F.mask(c)


def hashed_text(c: Column) -> Column:
    return F.sha2(c, 256)


def moment(at: datetime) -> Column:
    """A fixed point in time; without zone it is wall-clock time, whatever the session zone."""
    return F.lit(at) if at.tzinfo else F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz")
