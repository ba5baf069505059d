"""Row-local reshaping: mapping, masking, casting, token clean-up."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from syncflow.functions.columns import (
    DATETIME_FORMAT,
    MASK_TOKEN,
    NULL_TOKENS,
    blank,
    column_name,
    epoch_millis_instant,
    epoch_millis_text,
    lenient_cast,
    quoted,
)

_CHARACTER_TYPE = re.compile(r"^\s*n?(?:var)?char\s*\(\s*(\d+|max)\s*\)\s*$", re.IGNORECASE)


@dataclass(frozen=True)
class ColumnMap:
    """One line of a mapping: source column, target column, optional SQL type."""

    source: str
    target: str
    dtype: str | None = None

    @property
    def max_length(self) -> int | None:
        """``n`` of ``varchar(n)``; ``None`` for every other type."""
        match = _CHARACTER_TYPE.match(self.dtype or "")
        return int(match.group(1)) if match and match.group(1).isdigit() else None

    @property
    def spark_type(self) -> str | None:
        """The type to cast to. Length limits are a separate rule."""
        if self.dtype and _CHARACTER_TYPE.match(self.dtype):
            return "string"
        return self.dtype


def check_mapping(df: DataFrame, maps: Sequence[ColumnMap]) -> list[str]:
    """Source columns as spelled in ``df``; raises on absent or doubled names."""
    present = {name.lower() for name in df.columns}
    missing = [m.source for m in maps if m.source.lower() not in present]
    if missing:
        raise ValueError(f"mapped columns absent from the source: {missing}")
    targets = [m.target.lower() for m in maps]
    doubled = sorted({t for t in targets if targets.count(t) > 1})
    if doubled:
        raise ValueError(f"mapping names a target more than once: {doubled}")
    return [column_name(df, m.source) for m in maps]


def apply_mapping(
    df: DataFrame,
    maps: Sequence[ColumnMap],
    cast: str | None = "try",
    truncate: bool = False,
    keep: dict[str, Column] | None = None,
) -> DataFrame:
    """Rename, prune, reorder and cast in a single projection.

    ``cast="try"`` turns malformed and overflowing values into null,
    ``"strict"`` raises on them, ``None`` keeps the source types. ``truncate``
    cuts text to the length its mapped type allows. ``keep`` adds columns
    computed from the source row after the mapped ones.
    """
    if cast not in ("try", "strict", None):
        raise ValueError(f"cast must be 'try', 'strict' or None, not {cast!r}")
    projected = []
    for source, m in zip(check_mapping(df, maps), maps):
        value = quoted(source)
        if cast and m.spark_type:
            target = T.DataType.fromDDL(m.spark_type)
            if cast == "try":
                value = lenient_cast(value, df.schema[source].dataType, target)
            else:
                value = value.cast(target)
        if truncate and m.max_length is not None:
            value = F.substring(value, 1, m.max_length)
        projected.append(value.alias(m.target))
    projected += [column.alias(name) for name, column in (keep or {}).items()]
    return df.select(*projected)


def unfit_values(
    df: DataFrame, maps: Sequence[ColumnMap], overlong: bool = False
) -> Column:
    """Targets whose value does not fit its mapped type, comma-joined; null if all fit.

    A value does not fit if a lenient cast would turn it into null, or, with
    ``overlong``, if it is a text longer than its type allows.
    """
    found = []
    for source, m in zip(check_mapping(df, maps), maps):
        value, unfit = quoted(source), F.lit(False)
        if m.spark_type:
            target = T.DataType.fromDDL(m.spark_type)
            cast = lenient_cast(value, df.schema[source].dataType, target)
            unfit = value.isNotNull() & cast.isNull()
        if overlong and m.max_length is not None:
            too_long = F.length(value.cast("string")) > m.max_length
            unfit = unfit | F.coalesce(too_long, F.lit(False))
        found.append(F.when(unfit, F.lit(m.target)))
    return F.nullif(F.concat_ws(",", *found), F.lit(""))


def overlong_rows(df: DataFrame, maps: Sequence[ColumnMap]) -> DataFrame:
    """Rows with a text longer than its mapped type allows (to reject, not cut)."""
    condition = F.lit(False)
    for source, m in zip(check_mapping(df, maps), maps):
        if m.max_length is not None:
            too_long = F.length(quoted(source).cast("string")) > m.max_length
            condition = condition | F.coalesce(too_long, F.lit(False))
    return df.where(condition)


def mask_closed(
    df: DataFrame, value_col: str, end_col: str, token: str = MASK_TOKEN, move_last: bool = False
) -> DataFrame:
    """Keep the value while the end date is null, else show ``token``.

    The column stays in place; ``move_last`` puts it at the end instead.
    """
    name = column_name(df, value_col)
    masked = F.when(quoted(end_col).isNull(), quoted(name)).otherwise(F.lit(token))
    if not move_last:
        return df.withColumn(name, masked)
    others = [quoted(c) for c in df.columns if c != name]
    return df.select(*others, masked.alias(name))


def epoch_millis_to_datetime(
    df: DataFrame,
    columns: Sequence[str],
    as_string: bool = False,
    zone: str = "UTC",
    move_last: bool = False,
) -> DataFrame:
    """Epoch milliseconds to timestamps, or to second-precision text in ``zone``."""
    names = [column_name(df, c) for c in columns]

    def convert(name: str) -> Column:
        value = quoted(name)
        value = epoch_millis_text(value, zone) if as_string else epoch_millis_instant(value)
        return value.alias(name)

    if move_last:
        kept = [quoted(c) for c in df.columns if c not in names]
        return df.select(*kept, *[convert(c) for c in names])
    return df.select(*[convert(c) if c in names else quoted(c) for c in df.columns])


def text_to_datetime(
    df: DataFrame, columns: Sequence[str], pattern: str = DATETIME_FORMAT
) -> DataFrame:
    """Dates written as text to timestamps; text in another form becomes null.

    Maxima and watermarks need this first: text only sorts like time as long as
    the form has a fixed width.
    """
    names = [column_name(df, c) for c in columns]
    return df.withColumns({c: F.try_to_timestamp(quoted(c), F.lit(pattern)) for c in names})


def nullify_tokens(
    df: DataFrame, columns: Sequence[str], tokens: Sequence[str] = NULL_TOKENS
) -> DataFrame:
    """Turn texts that stand for "no value" into null."""
    names = [column_name(df, c) for c in columns]
    return df.withColumns(
        {c: F.when(~quoted(c).cast("string").isin(*tokens), quoted(c)) for c in names}
    )


def _any_blank(df: DataFrame, columns: Sequence[str]) -> Column:
    condition = F.lit(False)
    for name in columns:
        condition = condition | blank(quoted(column_name(df, name)).cast("string"))
    return condition


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows in which none of ``columns`` is null or empty."""
    return df.where(~_any_blank(df, columns))


def missing_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The other rows: at least one of ``columns`` is null or empty."""
    return df.where(_any_blank(df, columns))
