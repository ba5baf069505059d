from __future__ import annotations

import random

import pytest

from conftest import plan_of, rows_of
from syncflow.operators.digest import differing_ranges, range_digests, table_differences
from syncflow.staging import Staging

SCHEMA = "a string, b long, v double, w string"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def rows(n, seed=1):
    rng = random.Random(seed)
    return {
        (f"k{i % 97}", i): (rng.choice([None, 0.0, 1.5]), rng.choice([None, "", "-", "1:-", "x,y"]))
        for i in range(n)
    }


def as_list(table):
    return [(*k, *v) for k, v in table.items()]


@pytest.mark.parametrize("levels", [(1,), (1, 2), (2, 4, 6)])
@pytest.mark.parametrize("limit", [0, 10**7])
def test_against_brute_force(spark, monkeypatch, levels, limit):
    monkeypatch.setattr("syncflow.staging.SMALL_ON_DISK", limit)
    target = rows(500)
    source = {k: v for i, (k, v) in enumerate(target.items()) if i % 50}
    changed = list(source)[7::90]
    for k in changed:
        v, w = source[k]
        source[k] = (v, "new") if v is None else (None, w)
    added = [("new", i) for i in range(4)]
    source |= {k: (None, None) for k in added}
    expected = {k: "vanished" for k in target if k not in source}
    expected |= {k: "changed" for k in changed} | {k: "added" for k in added}
    found = table_differences(
        frame(spark, as_list(target) + [(None, 1, None, None)]),
        frame(spark, as_list(source) + [("z", None, None, None)]),
        ["a", "b"],
        ["v", "w"],
        levels=levels,
    )
    assert {(r["a"], r["b"]): r["change"] for r in found.collect()} == expected


def test_equal_tables_do_not_differ(spark):
    some = as_list(rows(300))
    ranges, few = differing_ranges(
        frame(spark, some), frame(spark, some[::-1]), ["a", "b"], ["v", "w"], Staging(spark)
    )
    assert ranges.collect() == [] and few
    empty = frame(spark, [])
    assert table_differences(empty, empty, ["a"], ["v"]).collect() == []


def test_nulls_and_texts_do_not_run_together(spark):
    one = frame(spark, [("1", 1, None, "1:x"), ("2", 2, 1.0, None)])
    two = frame(spark, [("1", 1, None, "x"), ("2", 2, 1.0, "-")])
    found = table_differences(one, two, ["a"], ["v", "w"])
    assert rows_of(found) == [("1", "changed"), ("2", "changed")]


def test_digests_are_reduced_before_the_shuffle(spark):
    digests = range_digests(frame(spark, as_list(rows(50))), ["a", "b"], ["v"], 1)
    assert digests.count() <= 16
    assert plan_of(digests).count("Exchange") == 1
