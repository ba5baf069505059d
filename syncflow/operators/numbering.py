"""Gap-free row numbers and delivery batches without a one-partition window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from syncflow.functions.columns import quoted
from syncflow.staging import Staging

# monotonically_increasing_id keeps the partition above this bit and the
# position inside the partition below it.
_PARTITION_SHIFT = 33


#: Parquet bytes that are sorted by one task.
RANGE_BYTES = 32 * 1024 * 1024


def ranges_for(bytes_in: int) -> int:
    """Ranges to sort an input of that size in."""
    return max(1, -(-bytes_in // RANGE_BYTES))


def number_rows(
    df: DataFrame,
    order: Sequence[str],
    staging: Staging | None = None,
    unique: bool = False,
    name: str = "row_num",
    bytes_in: int | None = None,
) -> DataFrame:
    """Add ``name``: 1, 2, 3, ... over ``order`` (nulls first), without gaps.

    A global window would sort everything in one task. Here Spark range-sorts
    the rows, and the sorted rows are written with their position inside their
    partition. The row number is that position plus the number of rows in the
    partitions before it. Only those counts, one per partition, are broadcast.

    The written copy is needed because range bounds come from a sample: counted
    and numbered in two evaluations, the partitions might differ.

    Rows equal in all of ``order`` would be stuck in one range. Unless the
    caller knows that ``order`` is ``unique``, every row is first written with
    an id of its own, which breaks the ties and lets Spark split them.

    The number of ranges follows the input: rows are written and measured first,
    unless ``bytes_in`` says how large the table is that they are read from.
    """
    staging = staging or Staging(df.sparkSession, "numbered")
    keys = [quoted(c).asc_nulls_first() for c in order]
    if not unique:
        df = df.withColumn("_tie", F.monotonically_increasing_id())
        keys.append(F.col("_tie").asc())
    if not unique or bytes_in is None:
        before = staging.size()
        df = staging.write(df, "input")
        bytes_in = staging.size() - before
    ranged = df.repartitionByRange(ranges_for(bytes_in), *keys).sortWithinPartitions(*keys)
    placed = staging.write(ranged.withColumn("_place", F.monotonically_increasing_id()), "sorted")

    part = F.shiftright("_place", _PARTITION_SHIFT)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
    # One row per range partition, so this window and the broadcast are bounded
    # by the shuffle partition count, not by the data.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset")
    )
    place = F.col("_place").bitwiseAND(F.lit((1 << _PARTITION_SHIFT) - 1))
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + place + 1)
        .drop("_part", "_offset", "_place", "_tie")
    )


def assign_batches(
    df: DataFrame,
    order: Sequence[str],
    size: int,
    staging: Staging | None = None,
    unique: bool = False,
) -> DataFrame:
    """Add ``row_num`` and ``batch_num`` (from 1), ``size`` rows per batch."""
    numbered = number_rows(df, order, staging, unique)
    batch = F.floor((F.col("row_num") - 1) / F.lit(size)) + 1
    return numbered.withColumn("batch_num", batch.cast("bigint"))


def batch_rows(
    df: DataFrame, size: int, staging: Staging, batch: str = "batch", row: str = "batch_row"
) -> DataFrame:
    """Rows dealt to batches of at most ``size``: ``batch``, and ``row`` counted from 1 in it.

    Batches are the files that tasks write, and a row's number is its place in its file,
    which the scan knows. So nothing is shuffled, sorted or counted, and the numbers stay
    as they are however often the written rows are read.
    """
    path = staging.folder("batches")
    df.write.option("maxRecordsPerFile", size).parquet(path)
    written = staging.spark.read.schema(df.schema).parquet(path)
    file, place = F.col("_metadata.file_name"), F.col("_metadata.row_index")
    number = F.concat_ws(
        "-", *[F.regexp_extract(file, r"^part-(\d+)-.*[-.]c(\d+)", i) for i in (1, 2)]
    )
    return written.select("*", number.alias(batch), (place + 1).alias(row))


def preview(df: DataFrame, order: Sequence[str], rows: int = 10) -> DataFrame:
    """The first rows by ``order``: a top-k report, merged from per-task top-k."""
    return df.orderBy(*[quoted(c).asc_nulls_first() for c in order]).limit(rows)
