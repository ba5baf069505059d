from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import forget_last_commit, rows_of
from syncflow.sinks.keyed_table import KeyedTable
from syncflow.sources.tables import TableRef, read_table
from syncflow.streaming import incremental

SCHEMA = T.StructType().add("k", T.IntegerType()).add("at", T.LongType()).add("v", T.StringType())


@pytest.fixture
def run(spark, folder):
    target = KeyedTable(spark, folder("target"), SCHEMA, ["k"], buckets=2)

    def start(**options):
        stream = incremental.read_landing(spark, folder("landing"), SCHEMA)
        incremental.stream_incremental(
            stream, target, folder("checkpoint"), ["at"], **options
        ).awaitTermination()
        return rows_of(target.read())

    return start


def land(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").json(folder("landing"))


def test_new_files_are_upserted_once(spark, folder, run):
    land(spark, folder, [(1, 1, "a"), (1, 2, "b"), (2, 1, "c"), (None, 1, "no key")])
    assert run() == [(1, 2, "b"), (2, 1, "c")]
    land(spark, folder, [(2, 5, "d"), (3, 1, "e")])
    assert run() == [(1, 2, "b"), (2, 5, "d"), (3, 1, "e")]
    assert run() == [(1, 2, "b"), (2, 5, "d"), (3, 1, "e")]


def test_a_transform_is_applied_to_each_batch(spark, folder, run):
    land(spark, folder, [(1, 1, "a"), (2, 1, "b")])
    assert run(transform=lambda rows: rows.withColumn("v", F.upper("v"))) == [(1, 1, "A"), (2, 1, "B")]


def test_a_repeated_micro_batch_is_skipped(spark, folder):
    target = KeyedTable(spark, folder("target"), SCHEMA, ["k"], buckets=2)

    def run(checkpoint):
        stream = incremental.read_landing(spark, folder("landing"), SCHEMA)
        incremental.stream_incremental(
            stream, target, folder(checkpoint), ["at"], writer="w"
        ).awaitTermination()

    land(spark, folder, [(1, 1, "a")])
    run("checkpoint")
    forget_last_commit(folder)
    run("checkpoint")
    assert rows_of(target.read()) == [(1, 1, "a")] and target._versions() == [1]

    # A new checkpoint counts from 0 again, and is not taken for a repetition.
    land(spark, folder, [(2, 1, "b")])
    run("new")
    assert rows_of(target.read()) == [(1, 1, "a"), (2, 1, "b")]


def test_snapshots_carry_their_batch_and_are_replaced_when_repeated(spark, folder):
    ref = TableRef(path=folder("snapshot"))

    def run(checkpoint):
        stream = incremental.read_landing(spark, folder("landing"), SCHEMA)
        incremental.stream_snapshots(stream, ref, folder(checkpoint)).awaitTermination()
        return rows_of(read_table(spark, ref).select("v", "batch_id"))

    land(spark, folder, [(1, 1, "a")])
    run("checkpoint")
    land(spark, folder, [(1, 2, "b")])
    assert run("checkpoint") == [("a", 0), ("b", 1)]
    forget_last_commit(folder)
    assert run("checkpoint") == [("a", 0), ("b", 1)]
    # Another stream has partitions of its own.
    assert run("new") == [("a", 0), ("a", 0), ("b", 0), ("b", 1)]


def test_an_interval_keeps_the_stream_running(spark, folder):
    assert incremental.CADENCE == "5 minutes"
    land(spark, folder, [(1, 1, "a")])
    target = KeyedTable(spark, folder("target"), SCHEMA, ["k"], buckets=2)
    stream = incremental.read_landing(spark, folder("landing"), SCHEMA, max_files=1)
    started = incremental.stream_incremental(
        stream, target, folder("checkpoint"), ["at"], every="1 second"
    )
    try:
        started.processAllAvailable()
        assert started.isActive and target.read().count() == 1
    finally:
        started.stop()


EVENTS = T.StructType().add("k", T.StringType()).add("at", T.TimestampType()).add("v", T.StringType())


def test_repeats_within_the_horizon_are_left_out(spark, folder):
    ref = TableRef(path=folder("snapshot"))

    def land_and_run(*rows):
        frame = spark.createDataFrame(rows, "k string, at string, v string")
        frame = frame.withColumn("at", F.col("at").cast("timestamp"))
        frame.coalesce(1).write.mode("append").parquet(folder("events"))
        stream = incremental.read_landing(spark, folder("events"), EVENTS, "parquet")
        once = incremental.drop_repeats(stream, ["k"], "at", "1 hour")
        incremental.stream_snapshots(once, ref, folder("checkpoint")).awaitTermination()
        return sorted(r["v"] for r in read_table(spark, ref).collect())

    assert land_and_run(("a", "2024-01-01 10:00", "1"), ("a", "2024-01-01 10:10", "2")) in (["1"], ["2"])
    # A repeat in a later file, and a new key.
    seen = land_and_run(("a", "2024-01-01 10:30", "3"), ("b", "2024-01-01 10:30", "4"))
    assert len(seen) == 2 and "4" in seen
    # Long after, the key's state is gone: the record counts as a new one.
    land_and_run(("c", "2024-01-02 10:00", "5"))
    land_and_run(("d", "2024-01-02 10:01", "6"))
    assert "7" in land_and_run(("a", "2024-01-02 10:05", "7"))
    # Older than the watermark: late, and left out.
    assert "8" not in land_and_run(("e", "2024-01-01 10:00", "8"))
