from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import plan_of, rows_of
from syncflow.operators.key_filter import key_filter, may_match
from syncflow.session import footer_session
from syncflow.sinks.bucketed_table import BucketedTable
from syncflow.staging import Staging

SCHEMA = T.StructType().add("k", T.IntegerType()).add("a", T.StringType()).add("odd `n`", T.LongType())


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture
def table(spark, folder):
    return BucketedTable(spark, folder("it's a target"), SCHEMA, ["k"], buckets=4, compact_after=3)


def test_upserts_agree_with_brute_force(spark, table):
    assert table.read().isEmpty()
    rng, want = random.Random(5), {}
    for step in range(9):
        rows = [(rng.randrange(60), f"s{step}", i) for i in range(40)]
        for row in rows:
            want[row[0]] = row
        assert table.upsert(frame(spark, rows), order=["odd `n`"], compact=step == 6)
        assert rows_of(table.read()) == sorted(want.values(), key=repr)
    assert len(table._commit()["deltas"]) < 3


def test_merges_do_not_shuffle_the_base(spark, table, monkeypatch):
    monkeypatch.setattr("syncflow.staging.SMALL_ON_DISK", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        rows = spark.range(1000).select(
            F.col("id").cast("int").alias("k"), F.lit("a").alias("a"), F.col("id").alias("odd `n`")
        )
        table.upsert(rows, compact=True)
        table.upsert(rows.where("k % 3 = 0").withColumn("a", F.lit("b")))
        merged = table.read()
        # One exchange: of the delta's keys.
        assert plan_of(merged).count("Exchange") == 1 and "Bucketed: true" in plan_of(merged)
        assert rows_of(merged.groupBy("a").count()) == [("a", 666), ("b", 334)]
        changes, _ = table._changes(table._commit()["deltas"])
        assert plan_of(table._merged(table._base(table._commit()), changes)).count("Exchange") == 1
        table.compact()
        assert plan_of(table.read()).count("Exchange") == 0
        assert rows_of(table.read().groupBy("a").count()) == [("a", 666), ("b", 334)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_small_deltas_are_folded_and_large_ones_merged(spark, folder):
    table = BucketedTable(spark, folder("t"), SCHEMA, ["k"], buckets=2, compact_after=2)
    rows = spark.range(50_000).selectExpr("cast(id as int) as k", "uuid() as a", "id as `odd ``n```")
    table.upsert(rows, compact=True)
    base = table._commit()["current"]
    for step in range(5):
        table.upsert(frame(spark, [(step, "x", step)]))
        assert len(table._commit()["deltas"]) <= 2 and table._commit()["current"] == base
    table.upsert(rows)
    assert table._commit()["current"] != base and table._commit()["deltas"] == []
    assert table.read().count() == 50_000


def test_another_session_declares_the_table_again(spark, table, folder):
    table.upsert(frame(spark, [(1, "x", 1), (2, "y", 2)]), compact=True)
    name = table._name(table._commit()["current"]["base"])
    spark.sql(f"DROP TABLE {name}")
    again = BucketedTable(spark, table.path, SCHEMA, ["k"], buckets=99)
    assert again.buckets == 4 and rows_of(again.read()) == [(1, "x", 1), (2, "y", 2)]
    assert spark.catalog.tableExists(name)


def test_vacuum(spark, table):
    for step in range(3):
        table.upsert(frame(spark, [(k, f"s{step}", step) for k in range(9)]), compact=True)
    removed = table.vacuum(keep=1)
    assert removed and not any(spark.catalog.tableExists(table._name(f)) for f in removed)
    assert table.read().count() == 9


def test_a_crash_before_the_commit_changes_nothing(spark, table, monkeypatch):
    table.upsert(frame(spark, [(1, "x", 1)]), compact=True)
    table.upsert(frame(spark, [(1, "y", 2)]))

    def crash(*_):
        raise OSError("driver lost")

    with monkeypatch.context() as patched:
        patched.setattr(table, "_publish", crash)
        with pytest.raises(OSError):
            table.compact()
    assert rows_of(table.read()) == [(1, "y", 2)]
    assert table.compact() and rows_of(table.read()) == [(1, "y", 2)]


# -- filters of keys --------------------------------------------------------------


@pytest.mark.parametrize("n", [0, 1, 50, 20_000])
def test_matching_rows_pass_and_few_others(spark, n):
    with Staging(spark) as staging:
        keys = staging.write(spark.range(0, 2 * n, 2).selectExpr("id", "cast(id as string) as t"))
        rows = spark.range(0, 100_000).selectExpr("cast(id as int) as id", "cast(id as string) as t", "1 as v")
        rows = rows.union(rows.limit(5).selectExpr("cast(null as int)", "t", "2"))
        passed = may_match(rows, ["id", "t"], key_filter(keys, ["id", "t"], staging))
        assert passed.columns == rows.columns
        got = {r["id"] for r in passed.collect()}
        want = set(range(0, 2 * n, 2)) & set(range(100_000))
        assert want <= got and len(got - want) <= 0.01 * 100_000


def test_a_filter_that_is_too_large_passes_everything(spark, monkeypatch):
    monkeypatch.setattr("syncflow.staging.SMALL_ON_DISK", 0)
    with Staging(spark) as staging:
        known = key_filter(spark.range(10), ["id"], staging)
        assert not known.small and may_match(spark.range(50), ["id"], known).count() == 50


def test_partial_rows_are_completed_from_filtered_old_ones(spark, table, monkeypatch):
    monkeypatch.setattr("syncflow.staging.SMALL_ON_DISK", 0)
    table.upsert(frame(spark, [(k, f"a{k}", k) for k in range(50)]), compact=True)
    table.upsert(spark.createDataFrame([(3, "new"), (77, "other")], "k int, a string"))
    got = {r["k"]: tuple(r)[1:] for r in table.read().collect()}
    assert got[3] == ("new", 3) and got[77] == ("other", None) and got[4] == ("a4", 4)


# -- footers ----------------------------------------------------------------------


def test_extremes_come_from_footers(spark, folder):
    spark.range(1000).selectExpr("id", "id % 7 as g", "date'2024-01-01' as d").write.parquet(folder("t"))
    beside = footer_session(spark)
    rows = beside.read.parquet(folder("t"))
    top = rows.agg(F.max("id").alias("most"), F.count(F.lit(1)).alias("n"), F.max("d").alias("d"))
    assert "PushedAggregation: [MAX(id), COUNT(*), MAX(d)]" in plan_of(top)
    assert tuple(top.first())[:2] == (999, 1000)
    # What footers cannot answer is scanned.
    assert rows.where("g = 3").agg(F.max("id")).first()[0] == 997
    plain = spark.read.parquet(folder("t")).agg(F.max("id"))
    assert "PushedAggregation" not in plan_of(plain)
    assert beside.conf.get("spark.sql.session.timeZone") == spark.conf.get("spark.sql.session.timeZone")
