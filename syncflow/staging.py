"""Staging: cutting lineage with a written table in a shared folder.

A step that reads its input more than once needs the same rows each time, even
if an executor is lost in between or the source moves on. Such input is written
once as parquet under ``spark.checkpoint.dir`` and read back from there.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from syncflow.functions.columns import quoted
from syncflow.sources import files

CHECKPOINT_DIR = "spark.checkpoint.dir"

#: Written rows are broadcast up to these sizes: bytes of parquet, bytes decoded.
SMALL_ON_DISK = 16 * 1024 * 1024
SMALL_DECODED = 64 * 1024 * 1024


def staging_root(spark: SparkSession) -> str:
    """The shared folder of the session; a temporary one only in local mode."""
    root = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder all executors can reach")
    root = tempfile.mkdtemp(prefix="syncflow-")
    spark.conf.set(CHECKPOINT_DIR, root)
    return root


#: Parquet bytes that one shuffle partition should hold at most.
PARTITION_BYTES = 128 * 1024 * 1024

_PARTITIONS = "spark.sql.shuffle.partitions"


@contextmanager
def sized_shuffles(spark: SparkSession, bytes_in: int) -> Iterator[int]:
    """Shuffles inside have enough partitions for ``bytes_in`` of parquet input.

    The setting is only raised, never lowered: too many partitions are joined at
    run time, too few cannot be split. It is put back at the end.
    """
    before = spark.conf.get(_PARTITIONS)
    wanted = max(int(before), -(-bytes_in // PARTITION_BYTES))
    spark.conf.set(_PARTITIONS, str(wanted))
    try:
        yield wanted
    finally:
        spark.conf.set(_PARTITIONS, before)


def decoded_bytes(df: DataFrame) -> int:
    """Bytes of all rows: 16 per column, plus the length of texts and nested values."""
    row = F.lit(16 * len(df.columns))
    for field in df.schema.fields:
        value = quoted(field.name)
        if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
            value = F.to_json(F.struct(value))
        elif not isinstance(field.dataType, (T.StringType, T.BinaryType)):
            continue
        row = row + F.coalesce(F.octet_length(value), F.lit(0))
    return df.agg(F.sum(row.cast("bigint"))).first()[0] or 0


class Staging:
    """Written intermediate tables of one run.

    ``with`` removes them at its end. Otherwise they stay as long as the
    application, since the rows handed out are read from them.
    """

    def __init__(self, spark: SparkSession, label: str = "stage"):
        self.spark = spark
        self.path = f"{staging_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
        self._count = 0
        files.make_scratch(spark, self.path)

    def folder(self, name: str) -> str:
        self._count += 1
        return f"{self.path}/{self._count:03d}-{name}"

    def write(self, df: DataFrame, name: str = "rows") -> DataFrame:
        """Write ``df`` once and return the written rows."""
        path = self.folder(name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def write_observed(
        self, df: DataFrame, metrics: dict[str, Column], name: str = "rows"
    ) -> tuple[DataFrame, dict]:
        """``write``, and aggregates of the rows that were taken while they were written.

        The metrics are observed above everything else, so in the tasks that write. Of a
        task that runs twice, only the attempt that is committed counts.
        """
        observation = Observation()
        named = [column.alias(key) for key, column in metrics.items()]
        written = self.write(df.observe(observation, *named), name)
        return written, observation.get

    def size(self) -> int:
        """Bytes written so far."""
        return files.size(self.spark, self.path)

    def write_checked(self, df: DataFrame, name: str = "rows") -> tuple[DataFrame, bool]:
        """``write``, and whether the rows are small enough to be broadcast.

        Parquet may shrink repeated values without limit, so small files are
        measured once more by the size of their decoded rows.
        """
        written = self.write(df, name)
        on_disk = files.size(self.spark, f"{self.path}/{self._count:03d}-{name}")
        small = on_disk <= SMALL_ON_DISK and decoded_bytes(written) <= SMALL_DECODED
        return written, small

    def __enter__(self) -> Staging:
        return self

    def __exit__(self, *_exc) -> None:
        files.delete(self.spark, self.path)
