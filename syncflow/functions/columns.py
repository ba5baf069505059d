"""Column expressions shared by the operators. All are JVM built-ins."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The start watermark of an empty log, the mask token, and the
#: texts that stand for "no value" in data landed as text.
EPOCH = datetime(1970, 1, 1)
MASK_TOKEN = "NA"
NULL_TOKENS = ("None", "nan", "")

#: Fixed value: how dates are written where they travel as text.
DATETIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


def quoted(name: str) -> Column:
    """Column by exact name, also for names with dots or leading digits."""
    return F.col("`" + name.replace("`", "``") + "`")


def column_name(df: DataFrame, name: str) -> str:
    """The real spelling of ``name`` in ``df``; names match without case."""
    found = [c for c in df.columns if c.lower() == name.lower()]
    if len(found) != 1:
        what = "no column" if not found else "more than one column"
        raise ValueError(f"{what} named {name!r} in {df.columns}")
    return found[0]


def as_datetime(value: datetime | str) -> datetime:
    """A UTC wall-clock ``datetime`` without zone."""
    if isinstance(value, str):
        value = datetime.fromisoformat(value)
    if value.tzinfo is not None:
        value = value.astimezone(timezone.utc).replace(tzinfo=None)
    return value


def instant(value: datetime | str, dtype: T.DataType | None = None) -> Column:
    """Literal of a UTC instant, typed like the column it is compared with.

    The text carries its own zone, so neither the session zone nor the zone of
    the Python process changes it, and the literal folds to a constant that
    reaches the scan.
    """
    text = as_datetime(value).isoformat(sep=" ", timespec="microseconds")
    if isinstance(dtype, T.TimestampNTZType):
        return F.lit(text).cast("timestamp_ntz")
    return F.lit(text + "Z").cast("timestamp")


def all_set(columns: Sequence[str]) -> Column:
    """True if none of the columns is null."""
    condition = F.lit(True)
    for name in columns:
        condition = condition & quoted(name).isNotNull()
    return condition


def blank(column: Column) -> Column:
    """True for null and for the empty string."""
    return column.isNull() | (F.length(column) == 0)


#: The texts Spark reads as boolean true.
TRUE_TEXTS = ("t", "true", "y", "yes", "1")

#: Any text Spark can read as a whole number matches: a digit, and no letter.
_MAYBE_INTEGER = "^[^A-Za-z]*[0-9][^A-Za-z]*$"


def is_true(column: Column) -> Column:
    """True for boolean true and for its spellings as text; false otherwise."""
    text = F.lower(F.trim(column.cast("string")))
    return F.coalesce(text.isin(*TRUE_TEXTS), F.lit(False))


def lenient_cast(column: Column, source: T.DataType, target: T.DataType) -> Column:
    """``try_cast`` that is quick on bad values too.

    ``try_cast`` raises and catches an exception per bad value, some 15
    microseconds each. The usual bad values, words for numbers and numbers too
    large for a decimal, are sorted out by a cheap test first. The test lets
    every good value pass, so the result is the same.
    """
    if isinstance(source, T.StringType) and isinstance(target, T.IntegralType):
        column = F.when(column.rlike(_MAYBE_INTEGER), column)
    elif isinstance(source, T.NumericType) and isinstance(target, T.DecimalType):
        bound = F.lit(f"1e{target.precision - target.scale}").cast("double")
        column = F.when(F.abs(column.cast("double")) <= bound, column)
    return column.try_cast(target)


def truncated(column: Column, dtype: T.DataType, precision: str | None) -> Column:
    """Cut a timestamp to ``"ms"`` or ``"s"``; ``None`` keeps microseconds."""
    units = {"ms": "MILLISECOND", "s": "SECOND"}
    if precision is None:
        return column
    return F.date_trunc(units[precision], column).cast(dtype)


def epoch_millis_text(column: Column, zone: str = "UTC") -> Column:
    """``yyyy-MM-dd HH:mm:ss`` in ``zone``; sub-second digits are cut towards zero."""
    whole = F.timestamp_seconds(F.call_function("div", column, F.lit(1000)))
    return datetime_text(whole, zone)


def datetime_text(column: Column, zone: str = "UTC") -> Column:
    """A timestamp as ``yyyy-MM-dd HH:mm:ss`` in ``zone``, cut to the second."""
    whole = F.date_trunc("SECOND", column)
    return F.convert_timezone(None, F.lit(zone), whole).cast("string")


def epoch_millis_instant(column: Column) -> Column:
    """Timestamp that keeps the milliseconds."""
    return F.timestamp_millis(column)
