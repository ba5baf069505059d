from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from conftest import plan_of, rows_of
from syncflow.operators import merge
from syncflow.operators.merge import dedup_latest, upsert
from syncflow.staging import Staging


def test_latest_row_per_key_nulls_least_ties_by_the_rest(spark):
    rows = spark.createDataFrame(
        [("a", 1, "x"), ("a", 3, "y"), ("a", 3, "z"), ("a", None, "zz"), ("b", None, "q")],
        "k string, at int, v string",
    )
    assert rows_of(merge.dedup_latest(rows, ["k"], ["at"])) == [("a", 3, "z"), ("b", None, "q")]


def test_latest_row_agrees_with_brute_force_on_a_hot_key(spark):
    rng = random.Random(7)
    data = [
        (0 if i % 3 == 0 else rng.randrange(200), rng.randrange(50), rng.randrange(50))
        for i in range(3000)
    ]
    best = {}
    for k, at, v in data:
        best[k] = max(best.get(k, (-1, -1)), (at, v))
    rows = spark.createDataFrame(data, "k int, at int, v int").repartition(6)
    got = {r["k"]: (r["at"], r["v"]) for r in merge.dedup_latest(rows, ["k"], ["at"]).collect()}
    assert got == best


def test_groups_are_cut_before_the_shuffle(spark):
    rows = spark.createDataFrame([(1, 1)], "id int, at int")
    plan = plan_of(merge.dedup_latest(rows, ["id"], ["at"]))
    assert plan.count("WindowGroupLimit") == 2 and "Exchange hashpartitioning" in plan


TARGET = "id int, a string, b string"


@pytest.fixture
def target(spark):
    return spark.createDataFrame([(1, "a1", "b1"), (2, "a2", "b2")], TARGET)


def test_upsert_overwrites_and_inserts(spark, target):
    source = spark.createDataFrame([(2, None, "B2"), (3, "a3", None)], TARGET)
    assert rows_of(merge.upsert(target, source, ["id"])) == [
        (1, "a1", "b1"), (2, None, "B2"), (3, "a3", None),
    ]


def test_upsert_keeping_target_values_for_nulls(spark, target):
    source = spark.createDataFrame([(2, None, "B2")], TARGET)
    assert rows_of(merge.upsert(target, source, ["id"], "keep"))[1] == (2, "a2", "B2")


def test_columns_the_source_lacks_keep_their_values(spark, target):
    source = spark.createDataFrame([("B2", 2), ("B3", 3)], "b string, id int")
    assert rows_of(merge.upsert(target, source, ["id"])) == [
        (1, "a1", "b1"), (2, "a2", "B2"), (3, None, "B3"),
    ]


def test_repeated_and_null_keys_in_the_source(spark, target):
    source = spark.createDataFrame([(2, "x", "1"), (2, "y", "2"), (None, "n", "n")], TARGET)
    assert rows_of(merge.upsert(target, source, ["id"], order=["b"])) == [
        (1, "a1", "b1"), (2, "y", "2"),
    ]
    assert rows_of(merge.unkeyed_rows(source, ["id"])) == [(None, "n", "n")]


def test_upsert_twice_is_upsert_once(spark, target):
    source = spark.createDataFrame([(2, "x", "y"), (9, "p", "q")], TARGET)
    once = merge.upsert(target, source, ["id"])
    assert rows_of(merge.upsert(once, source, ["id"])) == rows_of(once)


def test_upsert_refuses_unknown_columns_and_policies(spark, target):
    with pytest.raises(ValueError, match="absent from the target"):
        merge.upsert(target, target.withColumn("c", F.lit(1)), ["id"])
    with pytest.raises(ValueError, match="null_policy"):
        merge.upsert(target, target, ["id"], "drop")


def test_upsert_agrees_with_brute_force(spark):
    rng = random.Random(3)
    old = {k: (k, f"a{k}", f"b{k}") for k in range(300)}
    new = {k: (k, rng.choice([None, f"A{k}"]), f"B{k}") for k in rng.sample(range(500), 200)}
    got = merge.upsert(
        spark.createDataFrame(list(old.values()), TARGET),
        spark.createDataFrame(list(new.values()), TARGET),
        ["id"],
    )
    assert rows_of(got) == sorted({**old, **new}.values(), key=repr)


def test_small_delta_does_not_shuffle_the_target(spark, folder, monkeypatch):
    monkeypatch.setattr("syncflow.staging.SMALL_ON_DISK", 10_000)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        spark.range(50_000).select("id", F.lit("a").alias("a")).write.parquet(folder("target"))
        target = spark.read.parquet(folder("target"))
        with Staging(spark) as staging:
            few = spark.range(49_995, 50_005).select("id", F.lit("b").alias("a"))
            merged = merge.upsert(target, few, ["id"], staging=staging)
            changed, added = plan_of(merged).split("LeftAnti", 1)
            assert "BroadcastHashJoin" in changed and "Exchange hash" not in changed.split("LeftOuter")[0]
            assert "BroadcastHashJoin" in added
            assert rows_of(merged.groupBy("a").count()) == [("a", 49_995), ("b", 10)]

            many = spark.range(25_000, 75_000).select("id", F.lit("b").alias("a"))
            merged = merge.upsert(target, many, ["id"], staging=staging)
            assert "BroadcastHashJoin" not in plan_of(merged)
            assert rows_of(merged.groupBy("a").count()) == [("a", 25_000), ("b", 50_000)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_classify(spark, target):
    source = spark.createDataFrame([(2, "x"), (2, "y"), (7, "z"), (None, "n")], "id int, a string")
    got = merge.classify_changes(target, source, ["id"])
    assert got.columns == ["id", "a", "action"]
    assert rows_of(got) == [
        (2, "x", "update"), (2, "y", "update"), (7, "z", "insert"), (None, "n", "insert"),
    ]


def test_large_upsert_scans_the_target_once(spark, folder):
    spark.range(100).selectExpr("id as k", "id as v").write.parquet(folder("t"))
    target = spark.read.parquet(folder("t"))
    source = spark.range(50, 150).selectExpr("id as k", "-id as v")
    got = upsert(target, source, ["k"])
    assert plan_of(got).count("FileScan") == 1 and "FullOuter" in plan_of(got)
    assert rows_of(got) == sorted([(i, i if i < 50 else -i) for i in range(150)], key=repr)


def test_columns_without_an_order_break_ties_by_their_text(spark):
    rows = spark.createDataFrame([(1, {"a": 1}), (1, {"a": 2})], "k int, m map<string,int>")
    assert dedup_latest(rows, ["k"], []).collect() == [(1, {"a": 2})]
