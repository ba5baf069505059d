from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import plan_of, rows_of
from syncflow.operators import reconcile
from syncflow.operators.reconcile import align_by_key, delivery_verdicts
from syncflow.staging import Staging

D = [datetime(2022, 1, day) for day in range(1, 8)]
RESULTS = "id string, success string, error string, key string, seq int"


@pytest.fixture
def results(spark):
    return spark.createDataFrame(
        [
            ("r1", "true", None, "a", 1),
            ("r2", "false", "bad,\"value\"\nhere", "b", 2),
            ("r3", None, None, "c", 3),
        ],
        RESULTS,
    )


@pytest.fixture
def sent(spark):
    return spark.createDataFrame(
        [("b", D[1]), ("a", D[0]), ("c", D[2])], "key string, created timestamp_ntz"
    )


def test_a_result_without_verdict_counts_as_failed(results):
    assert [r["id"] for r in reconcile.failures(results).orderBy("id").collect()] == ["r2", "r3"]
    assert [r["id"] for r in reconcile.failures(results, False).collect()] == ["r2"]


@pytest.mark.parametrize("options", [{}, {"mode": "position", "order": ["created"], "result_order": ["seq"]}])
def test_failure_log(results, sent, options):
    log = reconcile.failure_log(results, sent, "key", "created", **options)
    assert log.columns == ["key", "error_message", "created_on_date"]
    assert rows_of(log) == [("b", "bad,\"value\"\nhere", D[1]), ("c", None, D[2])]


def test_no_results_give_an_empty_log(spark, sent):
    empty = spark.createDataFrame([], RESULTS)
    assert reconcile.failure_log(empty, sent, "key", "created").isEmpty()


def test_a_repeated_key_does_not_multiply(spark):
    results = spark.range(300).select(
        F.lit("false").alias("success"), F.lit("e").alias("error"), F.lit("hot").alias("key")
    )
    sent = spark.range(200).select(
        F.lit("hot").alias("key"), F.col("id").cast("int").alias("created")
    )
    log = reconcile.failure_log(results, sent, "key", "created")
    assert rows_of(log.groupBy("created_on_date").count()) == [(199, 300)]


def test_keys_are_compared_as_text(spark):
    results = spark.createDataFrame([("7", "false", "e")], "key string, success string, error string")
    sent = spark.createDataFrame([(7, D[0])], "key long, created timestamp_ntz")
    assert reconcile.failure_log(results, sent, "key", "created").count() == 1


def test_positions_need_a_total_order(spark, results, sent):
    tied = sent.withColumn("created", F.lit(str(D[0])).cast("timestamp_ntz"))
    with pytest.raises(ValueError, match="tied"):
        reconcile.align_by_position(results, tied, ["created"], ["seq"], ["key"])


def test_positions_need_as_many_results_as_rows(results, sent):
    with pytest.raises(ValueError, match="2 results for 3 sent rows"):
        reconcile.align_by_position(
            results.where("seq < 3").select("seq", "success"), sent, ["created"], ["seq"], ["key"]
        )


def test_unknown_mode(results, sent):
    with pytest.raises(ValueError, match="mode"):
        reconcile.failure_log(results, sent, "key", "created", mode="guess")


def test_summary(spark):
    log = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", None)], "k string, error_message string")
    assert rows_of(reconcile.failure_summary(log)) == [("x", 2), (None, 1)]


def test_few_results_do_not_shuffle_the_sent_rows(spark, folder):
    staging = Staging(spark, "few")
    sent = staging.write(spark.range(5000).selectExpr("id as k", "id * 2 as v"), "sent")
    results = spark.createDataFrame([("7",), ("9",), (None,), ("x",)], "k string")
    got = align_by_key(results, sent, "k", ["v"], staging=staging)
    assert rows_of(got.select("k", "v")) == [("7", 14), ("9", 18)]
    plan = plan_of(got)
    below_scan = [line for line in plan.split("\n") if "Exchange hashpartitioning(id" in line]
    assert not below_scan and "BroadcastHashJoin" in plan


def test_verdicts(spark):
    sent = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, "d")], "k long, v string")
    results = spark.createDataFrame(
        [("1", "true", None), ("2", "true", None), ("2", "false", "no"), ("2", "false", "bad"),
         ("4", None, None), ("9", "true", None), (None, "false", "lost")],
        "k string, success string, error string",
    )
    got = delivery_verdicts(results, sent, "k")
    assert rows_of(got.select("k", "v", "verdict", "error", "result_key")) == sorted(
        [
            (1, "a", "delivered", None, "1"),
            (2, "b", "failed", "bad", "2"),
            (3, "c", "unanswered", None, None),
            (4, "d", "failed", None, "4"),
            (None, None, "unmatched", None, "9"),
            (None, None, "unmatched", "lost", None),
        ],
        key=repr,
    )
    plain = delivery_verdicts(results, sent, "k", null_is_failure=False)
    assert plain.where("k = 4").first()["verdict"] == "delivered"
    failed = reconcile.failed_results(results, got, "k")
    assert rows_of(failed.select("k", "v", "error")) == [
        (2, "b", "bad"), (2, "b", "no"), (4, "d", None),
    ]


def test_every_stray_result_has_its_row(spark):
    sent = spark.createDataFrame([(1,)], "k long")
    results = spark.createDataFrame(
        [("9", "false", "x"), ("9", "false", "x"), ("9", "true", None), (None, None, "y"), (None, None, "y")],
        "k string, success string, error string",
    )
    got = delivery_verdicts(results, sent, "k").where("verdict = 'unmatched'")
    assert rows_of(got.select("result_key", "error")) == sorted(
        [("9", "x"), ("9", "x"), ("9", None), (None, "y"), (None, "y")], key=repr
    )
    assert reconcile.failed_results(results, delivery_verdicts(results, sent, "k"), "k").isEmpty()
