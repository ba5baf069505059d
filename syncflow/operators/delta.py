"""Reading the high watermark and selecting the rows above it."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from syncflow.functions.columns import EPOCH, as_datetime, column_name, instant, quoted, truncated

NEXT_RULES = ("greatest", "created_only", "day_gap")


def watermark_row(
    log: DataFrame,
    ts_col: str,
    object_name: str | None = None,
    object_col: str | None = None,
    default: datetime | str = EPOCH,
    success_only: bool = True,
    status_col: str = "is_success",
    precision: str | None = None,
) -> DataFrame:
    """One row, one column ``watermark``: the newest mark in the log.

    An empty log, or one that holds only nulls, gives ``default``. Rows of
    failed runs (status 0) are left out unless ``success_only`` is off; a log
    without the status column is taken whole.
    """
    if object_name is not None:
        log = log.where(quoted(object_col) == F.lit(object_name))
    if success_only and status_col in log.columns:
        log = log.where(quoted(status_col) != 0)
    dtype = log.schema[column_name(log, ts_col)].dataType
    newest = truncated(F.max(quoted(ts_col)), dtype, precision)
    return log.agg(F.coalesce(newest, instant(default, dtype).cast(dtype)).alias("watermark"))


def watermark(
    log: DataFrame, ts_col: str, override: datetime | str | None = None, **options
) -> datetime:
    """The watermark as a UTC wall-clock value; ``override`` (a backfill) wins.

    This one scalar is all that a run brings to the driver.
    """
    if override is not None:
        return as_datetime(override)
    row = watermark_row(log, ts_col, **options)
    if isinstance(row.schema["watermark"].dataType, T.TimestampType):
        # An instant is collected in UTC whatever the zone of the Python process.
        row = row.select(
            F.convert_timezone(None, F.lit("UTC"), F.col("watermark")).alias("watermark")
        )
    return row.select(F.col("watermark").cast("timestamp_ntz")).first()[0]


def watermark_by_object(
    log: DataFrame,
    ts_col: str,
    object_col: str = "object_name",
    success_only: bool = True,
    status_col: str = "is_success",
) -> DataFrame:
    """The newest mark of every object in one pass (partial maximum per task)."""
    if success_only and status_col in log.columns:
        log = log.where(quoted(status_col) != 0)
    return log.groupBy(quoted(object_col).alias(object_col)).agg(
        F.max(quoted(ts_col)).alias("watermark")
    )


def newer_than(
    df: DataFrame, mark: datetime | str, columns: Sequence[str], strict: bool = True
) -> Column:
    """Predicate: any of ``columns`` lies above ``mark``.

    A null in one column does not stop the others. ``strict=False`` also takes
    the rows at the mark itself; with a keyed target that loses no late row.
    """
    condition = None
    for name in columns:
        dtype = df.schema[column_name(df, name)].dataType
        bound = instant(mark, dtype)
        one = quoted(name) > bound if strict else quoted(name) >= bound
        condition = one if condition is None else condition | one
    return condition


def delta_scan(
    df: DataFrame,
    mark: datetime | str,
    created: str,
    updated: str | None = None,
    strict: bool = True,
    extra: Column | None = None,
) -> DataFrame:
    """Rows created or updated after ``mark``.

    The bound is a literal, so parquet and JDBC scans receive the filter.
    """
    columns = [created] if updated is None else [created, updated]
    condition = newer_than(df, mark, columns, strict)
    return df.where(condition if extra is None else condition & extra)


def delta_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Row count and the maximum of each column, in one aggregation."""
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        *[F.max(quoted(name)).alias(f"max_{name}") for name in columns],
    )


def observed_stats(
    df: DataFrame, columns: Sequence[str], taken: Column | None = None
) -> dict[str, Column]:
    """The aggregates of ``delta_stats`` as metrics that a write observes.

    Metrics come to the driver as Python values. Instants are observed as microseconds and
    other values as text, so that no time zone of the process changes them.
    """
    metrics = {"row_count": F.count(F.lit(1) if taken is None else F.when(taken, 1))}
    for name in columns:
        value = quoted(name) if taken is None else F.when(taken, quoted(name))
        if isinstance(df.schema[column_name(df, name)].dataType, T.TimestampType):
            metrics[f"max_{name}"] = F.max(F.unix_micros(value))
        else:
            metrics[f"max_{name}"] = F.max(value).cast("string")
    return metrics


def stats_row(df: DataFrame, columns: Sequence[str], seen: dict) -> DataFrame:
    """The row of ``delta_stats`` from observed metrics of ``df``."""
    values = [F.lit(seen["row_count"]).cast("bigint").alias("row_count")]
    for name in columns:
        dtype, value = df.schema[column_name(df, name)].dataType, F.lit(seen[f"max_{name}"])
        if isinstance(dtype, T.TimestampType):
            value = F.timestamp_micros(value.cast("bigint"))
        values.append(value.cast(dtype).alias(f"max_{name}"))
    return df.sparkSession.range(1).select(*values)


def next_watermark(
    stats: DataFrame,
    old: datetime | str,
    created: str,
    updated: str | None = None,
    rule: str = "greatest",
) -> DataFrame:
    """Add ``next_watermark`` to the row of ``delta_stats``.

    ``greatest`` takes the newer of both maxima. ``created_only`` ignores
    updates. ``day_gap`` takes the update maximum only if it is a whole day or
    more past the creation maximum. None goes below ``old`` or to null.
    """
    if rule not in NEXT_RULES:
        raise ValueError(f"rule must be one of {NEXT_RULES}, not {rule!r}")
    made = quoted(f"max_{created}")
    dtype = stats.schema[f"max_{created}"].dataType
    if updated is None or rule == "created_only":
        mark = made
    else:
        touched = quoted(f"max_{updated}")
        if rule == "greatest":
            mark = F.greatest(touched, made)
        else:
            mark = F.when(touched >= made + F.expr("INTERVAL '24' HOUR"), touched).otherwise(made)
    floor = instant(old, dtype)
    return stats.withColumn("next_watermark", F.greatest(F.coalesce(mark, floor), floor))
