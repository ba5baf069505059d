"""CSV delivery batches and batch-partitioned snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from syncflow.sources.tables import TableRef, append_table

#: Fixed value: rows per delivery batch.
BATCH_SIZE = 100_000

#: Quotes are doubled and blanks kept, so that any text survives the trip.
CSV_OPTIONS = {
    "header": "true",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def export_batches(
    df: DataFrame, path: str, size: int = BATCH_SIZE, batch: str | None = None
) -> None:
    """Write CSV files of at most ``size`` rows each, every one with a header.

    Each task writes its own files: nothing is shuffled, sorted or collected. With
    ``batch``, a column that numbers batches, each batch has a folder of its own.
    """
    writer = df.write.options(**CSV_OPTIONS).option("maxRecordsPerFile", size)
    (writer if batch is None else writer.partitionBy(batch)).csv(path)


def append_snapshot(df: DataFrame, ref: TableRef, partition: Sequence[str] = ("batch_id",)) -> None:
    """Append one tagged batch.

    In a file table the batch is a partition of its own and is replaced as a
    whole, so repeating the batch after a crash changes nothing and no other
    batch is touched. A JDBC table gets a plain append (at least once).
    """
    if ref.path is None:
        append_table(df, ref)
        return
    (
        df.write.format(ref.format)
        .options(**ref.options)
        .option("partitionOverwriteMode", "dynamic")
        .mode("overwrite")
        .partitionBy(*partition)
        .save(ref.path)
    )
