from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows_of
from syncflow.sinks.keyed_table import KeyedTable
from syncflow.sources import files

SCHEMA = T.StructType().add("k", T.IntegerType()).add("a", T.StringType()).add("n", T.LongType())


@pytest.fixture
def table(spark, folder):
    return KeyedTable(spark, folder("target"), SCHEMA, ["k"], buckets=4)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_a_new_table_is_empty(table):
    assert table.read().isEmpty() and table.read().columns == ["k", "a", "n"]


def test_upserts_agree_with_brute_force(spark, table):
    rng, want = random.Random(5), {}
    for step in range(4):
        rows = [(rng.randrange(60), f"s{step}", i) for i in range(40)]
        for row in rows:
            want[row[0]] = row  # n rises within a step, so the last row is the newest
        assert table.upsert(frame(spark, rows), order=["n"])
    assert rows_of(table.read()) == sorted(want.values(), key=repr)


def test_a_delta_costs_its_own_size(spark, table):
    rows = spark.range(20_000).selectExpr("cast(id as int) as k", "uuid() as a", "id as n")
    table.upsert(rows)
    table.compact()
    before = files.size(spark, f"{table.path}/data")
    table.upsert(frame(spark, [(7, "new", 1), (30_000, "added", 1)]))
    assert files.size(spark, f"{table.path}/data") - before < before / 50
    assert table.read().count() == 20_001 and table.read().where("k = 7").first()["a"] == "new"


def test_deltas_are_folded_in_after_some(spark, folder):
    table = KeyedTable(spark, folder("t"), SCHEMA, ["k"], buckets=4, compact_after=3)
    for step in range(7):
        table.upsert(frame(spark, [(k, f"s{step}", step) for k in range(step, 10)]))
    assert len(table._commit()["deltas"]) == 1
    assert rows_of(table.read()) == [(k, f"s{min(k, 6)}", min(k, 6)) for k in range(10)]


def test_vacuum_leaves_a_commit_in_flight(spark, table, monkeypatch):
    table.upsert(frame(spark, [(1, "x", 1)]))
    publish = table._publish

    def vacuum_first(*args):
        table.vacuum(keep=1)
        publish(*args)

    monkeypatch.setattr(table, "_publish", vacuum_first)
    table.upsert(frame(spark, [(1, "y", 2), (2, "z", 2)]))
    table.compact()
    assert rows_of(table.read()) == [(1, "y", 2), (2, "z", 2)]


def test_only_touched_buckets_are_rewritten(spark, table):
    table.upsert(frame(spark, [(k, "old", 0) for k in range(100)]), compact=True)
    before = table._commit()["current"]
    table.upsert(frame(spark, [(7, "new", 1)]), compact=True)
    after = table._commit()["current"]
    assert sum(before[b] != after[b] for b in before) == 1
    assert table.read().count() == 100 and table.read().where("k = 7").first()["a"] == "new"


def test_a_batch_is_taken_once_per_writer(spark, table):
    assert table.upsert(frame(spark, [(1, "x", 1)]), writer="w", batch=0)
    assert not table.upsert(frame(spark, [(1, "again", 1)]), writer="w", batch=0)
    assert table.upsert(frame(spark, [(1, "y", 1)]), writer="other", batch=0)
    assert table.upsert(frame(spark, []), writer="w", batch=1)
    assert rows_of(table.read()) == [(1, "y", 1)]


def test_nothing_to_do_commits_nothing(spark, table):
    assert not table.upsert(frame(spark, [(None, "no key", 1)]))
    assert table._versions() == []


def test_readers_keep_the_commit_they_opened(spark, table):
    table.upsert(frame(spark, [(1, "x", 1)]))
    opened = table.read()
    table.upsert(frame(spark, [(1, "y", 2)]))
    assert (rows_of(opened), rows_of(table.read())) == ([(1, "x", 1)], [(1, "y", 2)])


def test_a_crash_before_the_commit_leaves_the_table_as_it_was(spark, table, monkeypatch):
    table.upsert(frame(spark, [(1, "x", 1)]))

    def crash(*_):
        raise OSError("driver lost")

    with monkeypatch.context() as patched:
        patched.setattr(table, "_publish", crash)
        with pytest.raises(OSError):
            table.upsert(frame(spark, [(1, "y", 2), (2, "z", 2)]))
    assert rows_of(table.read()) == [(1, "x", 1)]
    table.upsert(frame(spark, [(1, "y", 2), (2, "z", 2)]))
    assert rows_of(table.read()) == [(1, "y", 2), (2, "z", 2)]


def test_bucket_count_is_fixed_at_creation_and_keys_are_typed(spark, table, folder):
    table.upsert(frame(spark, [(1, "x", 1)]))
    again = KeyedTable(spark, folder("target"), SCHEMA, ["k"], buckets=99)
    assert again.buckets == 4
    again.upsert(spark.createDataFrame([(1, "wide")], "k long, a string"))
    assert rows_of(again.read()) == [(1, "wide", 1)]


def test_keys_that_differ_only_before_typing_are_one_key(spark, table):
    table.upsert(spark.createDataFrame([("1", "a", 1), ("01", "b", 2)], "k string, a string, n long"), ["n"])
    assert rows_of(table.read()) == [(1, "b", 2)]


def test_rows_may_be_ordered_by_a_column_the_table_lacks(spark, table):
    rows = spark.createDataFrame([(1, "a", 9), (1, "b", 3)], "k int, a string, seen int")
    table.upsert(rows, ["seen"])
    assert rows_of(table.read()) == [(1, "a", None)]


def test_keep_policy_and_compaction(spark, table):
    table.upsert(frame(spark, [(1, "x", 1)]))
    table.upsert(frame(spark, [(1, None, 2)]), null_policy="keep", compact=True)
    assert rows_of(table.read()) == [(1, "x", 2)]


def test_changes(spark, table):
    table.upsert(frame(spark, [(1, "x", 1)]))
    got = table.changes(frame(spark, [(1, "y", 1), (2, "z", 1)]))
    assert {r["k"]: r["action"] for r in got.collect()} == {1: "update", 2: "insert"}


def test_vacuum_drops_what_no_kept_commit_needs(spark, table):
    for step in range(4):
        table.upsert(frame(spark, [(k, f"s{step}", step) for k in range(20)]))
    want = rows_of(table.read())
    assert table.vacuum(keep=1) == []  # the deltas are needed
    table.compact()
    assert table.vacuum(keep=1)
    assert rows_of(table.read()) == want
    assert len(files.list_names(spark, f"{table.path}/commits")) == 1
    assert table.vacuum(keep=1) == []


def test_large_delta_goes_through_the_rebalanced_path(spark, table, monkeypatch):
    monkeypatch.setattr("syncflow.staging.SMALL_ON_DISK", 0)
    rows = spark.range(500).select(
        F.col("id").cast("int").alias("k"), F.lit("a").alias("a"), F.col("id").alias("n")
    )
    table.upsert(rows)
    table.upsert(rows.where("k >= 250").withColumn("a", F.lit("b")), compact=True)
    assert rows_of(table.read().groupBy("a").count()) == [("a", 250), ("b", 250)]
