from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from conftest import plan_of, rows_of
from syncflow.operators import numbering
from syncflow.staging import Staging


def test_numbers_follow_the_order_without_gaps_nulls_first(spark):
    values = random.Random(1).sample(range(5000), 1999)
    rows = spark.createDataFrame([(v,) for v in [None, *values]], "v int").repartition(7)
    got = {r["row_num"]: r["v"] for r in numbering.number_rows(rows, ["v"], unique=True).collect()}
    assert got == dict(enumerate([None, *sorted(values)], start=1))


@pytest.fixture
def many_partitions(spark):
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    yield
    spark.conf.set(key, "true")


def test_ties_are_numbered_once_each_and_spread_over_tasks(spark, many_partitions, monkeypatch):
    """A third of the rows and more share one order value."""
    monkeypatch.setattr(numbering, "RANGE_BYTES", 8192)
    rows = spark.range(9000).select(
        "id", F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 10).alias("v")
    )
    staging = Staging(spark, "test")
    numbered = numbering.number_rows(rows.repartition(4), ["v"], staging)
    got = numbered.collect()
    assert sorted(r["row_num"] for r in got) == list(range(1, 9001))
    assert len({r["id"] for r in got}) == 9000
    by_number = [r["v"] for r in sorted(got, key=lambda r: r["row_num"])]
    assert by_number == sorted(by_number)
    placed = spark.read.parquet(f"{staging.path}/002-sorted").where("v = 5")
    assert placed.select(F.shiftright("_place", 33)).distinct().count() > 1


def test_data_is_never_in_one_partition(spark):
    rows = spark.range(1000).select("id", F.lit("x" * 20).alias("text"))
    plan = plan_of(numbering.number_rows(rows, ["id"], unique=True))
    single = plan[plan.index("SinglePartition"):]
    assert "text" not in single and "BroadcastHashJoin" in plan


def test_numbering_nothing(spark):
    assert numbering.number_rows(spark.createDataFrame([], "v int"), ["v"]).count() == 0


def test_batches_hold_size_rows_each(spark):
    rows = spark.range(25)
    got = numbering.assign_batches(rows, ["id"], 10, unique=True).groupBy("batch_num").count()
    assert rows_of(got) == [(1, 10), (2, 10), (3, 5)]


def test_preview(spark):
    rows = spark.createDataFrame([(3,), (1,), (None,), (2,)], "v int")
    assert [r["v"] for r in numbering.preview(rows, ["v"], 3).collect()] == [None, 1, 2]


@pytest.mark.parametrize("unique", [True, False])
def test_ranges_follow_the_input(spark, monkeypatch, unique):
    monkeypatch.setattr(numbering, "RANGE_BYTES", 4096)
    rows = spark.range(20_000).selectExpr("id", "uuid() as text")
    staging = Staging(spark, "ranges")
    numbered = numbering.number_rows(rows, ["id"], staging, unique=unique)
    assert [r["row_num"] for r in numbered.orderBy("id").limit(3).collect()] == [1, 2, 3]
    placed = spark.read.parquet(f"{staging.path}/002-sorted")
    assert placed.select(F.shiftright("_place", 33)).distinct().count() > 50
