"""Audit rows, batch registration and batch-tagged snapshots."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from syncflow.functions.columns import instant, quoted
from syncflow.sources import files

#: Fixed values of the status column.
STATUS = {"failure": 0, "success": 1, "no_data": 2}


@dataclass(frozen=True)
class AuditColumns:
    """Column names of an audit log; ``None`` leaves an optional column out."""

    start: str = "execution_start_time"
    end: str = "execution_end_time"
    status: str = "is_success"
    count: str = "record_count"
    mark: str = "watermark"
    object_name: str | None = "object_name"
    failed_count: str | None = "failed_count"

    def schema(self) -> T.StructType:
        fields = [
            (self.start, T.TimestampType()),
            (self.end, T.TimestampType()),
            (self.status, T.IntegerType()),
            (self.count, T.LongType()),
            (self.mark, T.TimestampType()),
            (self.object_name, T.StringType()),
            (self.failed_count, T.LongType()),
        ]
        return T.StructType([T.StructField(n, t) for n, t in fields if n])


def audit_row(
    spark: SparkSession,
    start: datetime | str,
    end: datetime | str | None,
    status: str,
    count: int,
    mark: datetime | str,
    object_name: str | None = None,
    failed_count: int = 0,
    columns: AuditColumns = AuditColumns(),
) -> DataFrame:
    """One typed audit row. ``end=None`` is the time at which the row is written."""
    values = {
        columns.start: instant(start),
        columns.end: F.current_timestamp() if end is None else instant(end),
        columns.status: F.lit(STATUS[status]),
        columns.count: F.lit(count),
        columns.mark: instant(mark),
        columns.object_name: F.lit(object_name),
        columns.failed_count: F.lit(failed_count),
    }
    schema = columns.schema()
    return spark.range(1).select(
        *[values[f.name].cast(f.dataType).alias(f.name) for f in schema.fields]
    )


@dataclass(frozen=True)
class BatchColumns:
    """Column names of a batch registry."""

    object_name: str = "object_name"
    created: str = "created_on_date"
    merged: str = "is_merged"
    batch: str = "batch_id"

    def schema(self) -> T.StructType:
        return T.StructType(
            [
                T.StructField(self.object_name, T.StringType()),
                T.StructField(self.created, T.TimestampType()),
                T.StructField(self.merged, T.IntegerType()),
                T.StructField(self.batch, T.LongType()),
            ]
        )


def next_batch_id(registry: DataFrame, columns: BatchColumns = BatchColumns()) -> DataFrame:
    """One row: the id that follows the greatest one of all objects."""
    newest = F.coalesce(F.max(quoted(columns.batch)), F.lit(0))
    return registry.agg((newest + 1).cast("bigint").alias(columns.batch))


def register_batch(
    registry: DataFrame,
    object_name: str,
    run_ts: datetime | str,
    batch_id: int | None = None,
    columns: BatchColumns = BatchColumns(),
) -> DataFrame:
    """The registry row of a new batch, not merged yet.

    The id is computed here, or handed in, and stored with the row; it is not
    read back after an append. One writer at a time per registry.
    """
    if batch_id is None:
        row = next_batch_id(registry, columns)
    else:
        row = registry.sparkSession.range(1).select(
            F.lit(batch_id).cast("bigint").alias(columns.batch)
        )
    return row.select(
        F.lit(object_name).alias(columns.object_name),
        instant(run_ts).alias(columns.created),
        F.lit(0).alias(columns.merged),
        quoted(columns.batch),
    )


def claim_batch_id(
    registry: DataFrame, claims: str, owner: str, columns: BatchColumns = BatchColumns()
) -> int:
    """A batch id that no other run gets, although runs may ask at the same time.

    The id that follows the registry is claimed by creating a note of its name under
    ``claims``. The file system lets one of several writers create it; the others try
    the next id. A claim is kept when its run fails: ids grow, but may leave gaps.
    """
    spark = registry.sparkSession
    batch_id = next_batch_id(registry, columns).first()[0]
    while not files.create_note(spark, f"{claims.rstrip('/')}/{batch_id:020d}", owner):
        batch_id += 1
    return batch_id


def latest_batch(
    registry: DataFrame, object_name: str, columns: BatchColumns = BatchColumns()
) -> DataFrame:
    """One row: the newest batch id of an object, null if it has none."""
    mine = registry.where(quoted(columns.object_name) == F.lit(object_name))
    return mine.agg(F.max(quoted(columns.batch)).alias(columns.batch))


def tag_snapshot(
    df: DataFrame,
    batch_id: int,
    run_ts: datetime | str | None = None,
    load_col: str | None = "time_stamp",
    batch_col: str = "batch_id",
) -> DataFrame:
    """Add the load time (unless ``load_col`` is ``None``) and the batch id.

    Without ``run_ts`` the load time is the time of the query.
    """
    if load_col:
        loaded = F.current_timestamp() if run_ts is None else instant(run_ts)
        df = df.withColumn(load_col, loaded)
    return df.withColumn(batch_col, F.lit(batch_id).cast("bigint"))
