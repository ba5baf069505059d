from __future__ import annotations

import random

import pytest

from conftest import plan_of, rows_of
from syncflow.operators.merge import classify_changes
from syncflow.operators.reconcile import align_by_key
from syncflow.operators.skew import join_one


@pytest.fixture
def tables(spark):
    rng = random.Random(11)
    hot = [0, 1, None]
    many = [(rng.choice(hot) if i % 2 else rng.randrange(2, 60), i) for i in range(800)]
    one = [(k, f"v{k}") for k in range(0, 60, 2)]  # 1 is hot and has no partner
    return (
        many, dict(one),
        spark.createDataFrame(many, "k int, i int").repartition(5),
        spark.createDataFrame(one, "k int, v string"),
    )


@pytest.mark.parametrize("hot_rows", [0, 50, 10_000])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_join_agrees_with_brute_force(tables, how, hot_rows):
    many, one, left, right = tables
    want = [(k, i, one.get(k)) for k, i in many if how == "left" or k in one]
    got = join_one(left, right, ["k"], how, hot_rows)
    assert got.columns == ["k", "i", "v"] and rows_of(got) == sorted(want, key=repr)


def test_two_key_columns(spark):
    left = spark.createDataFrame([(1, "a", 1)] * 5 + [(1, "b", 2), (None, "a", 3)], "x int, y string, i int")
    right = spark.createDataFrame([(1, "a", "v")], "x int, y string, v string")
    got = rows_of(join_one(left, right, ["x", "y"], "left", hot_rows=3))
    assert got == [(1, "a", 1, "v")] * 5 + [(1, "b", 2, None), (None, "a", 3, None)]


def test_only_bounded_sides_are_broadcast(spark, tables):
    """The hot keys and their measured partners are; neither input is."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plain = plan_of(join_one(tables[2], tables[3], ["k"]))
        split = plan_of(join_one(tables[2], tables[3], ["k"], hot_rows=10))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Without a hot key there is one join; otherwise the hot keys are joined apart.
    assert plain.count("SortMergeJoin") == 1 and "Broadcast" not in plain
    assert split.count("SortMergeJoin") == 1 and split.count("BroadcastHashJoin") == 3


def test_large_partners_are_salted(spark, tables, monkeypatch):
    many, one, left, right = tables
    want = rows_of(join_one(left, right, ["k"], "left", 10))
    monkeypatch.setattr("syncflow.staging.SMALL_ON_DISK", 0)
    got = join_one(left, right, ["k"], "left", 10)
    assert "_salt" in plan_of(got) and rows_of(got) == want


def test_operators_give_the_same_with_and_without_hot_keys(spark, tables):
    _, _, left, right = tables
    assert rows_of(classify_changes(right, left, ["k"], 10)) == rows_of(
        classify_changes(right, left, ["k"])
    )
    assert rows_of(align_by_key(left, right, "k", ["v"], hot_rows=10)) == rows_of(
        align_by_key(left, right, "k", ["v"])
    )


def test_other_joins_are_refused(tables):
    with pytest.raises(ValueError, match="how"):
        join_one(tables[2], tables[3], ["k"], "full")
