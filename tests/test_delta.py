from __future__ import annotations

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from conftest import plan_of, rows_of
from syncflow.functions.columns import EPOCH
from syncflow.operators import delta

LOG = "object_name string, is_success int, mark timestamp_ntz"
D = [datetime(2022, 2, day) for day in range(1, 11)]


@pytest.fixture
def log(spark):
    return spark.createDataFrame(
        [("a", 1, D[1]), ("a", 2, D[2]), ("a", 0, D[5]), ("b", 1, D[3]), ("c", 1, None)], LOG
    )


def test_watermark_takes_the_newest_mark_of_runs_that_did_not_fail(log):
    assert delta.watermark(log, "mark") == D[3]
    assert delta.watermark(log, "mark", object_name="a", object_col="object_name") == D[2]


def test_watermark_over_all_rows_whatever_their_status(log):
    assert delta.watermark(log, "mark", success_only=False) == D[5]


def test_watermark_defaults_for_empty_and_all_null_logs(spark, log):
    assert delta.watermark(spark.createDataFrame([], LOG), "mark") == EPOCH
    only_null = {"object_name": "c", "object_col": "object_name"}
    assert delta.watermark(log, "mark", **only_null) == EPOCH
    assert delta.watermark(log, "mark", default="2020-01-01", **only_null) == datetime(2020, 1, 1)


def test_watermark_override_wins(log):
    assert delta.watermark(log, "mark", override="2021-05-06 00:00:00.000") == datetime(2021, 5, 6)


def test_watermark_keeps_microseconds_unless_cut(spark):
    log = spark.createDataFrame([(datetime(2022, 1, 1, 1, 2, 3, 456789),)], "mark timestamp_ntz")
    assert delta.watermark(log, "mark").microsecond == 456789
    assert delta.watermark(log, "mark", precision="ms").microsecond == 456000
    assert delta.watermark(log, "mark", precision="s").microsecond == 0


def test_watermark_of_an_instant_is_utc_in_any_session_zone(spark):
    log = spark.range(1).select(F.lit("2022-01-01T05:00:00Z").cast("timestamp").alias("mark"))
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        mark = delta.watermark(log, "mark")
        assert mark == datetime(2022, 1, 1, 5)
        assert delta.delta_scan(log, mark, "mark").count() == 0
        assert delta.delta_scan(log, mark - timedelta(microseconds=1), "mark").count() == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_an_aware_override_is_converted_to_utc(log):
    east = timezone(timedelta(hours=2))
    assert delta.watermark(log, "mark", override=datetime(2022, 1, 1, 2, tzinfo=east)) == datetime(
        2022, 1, 1
    )


def test_watermark_by_object_gives_every_object(log):
    got = rows_of(delta.watermark_by_object(log, "mark"))
    assert got == [("a", D[2]), ("b", D[3]), ("c", None)]


ROWS = [
    (1, D[0], None),  # old, never updated
    (2, D[4], None),  # new
    (3, D[0], D[4]),  # updated since
    (4, None, D[4]),  # creation date unknown
    (5, D[2], D[2]),  # exactly at the mark
    (6, None, None),
]


@pytest.fixture
def rows(spark):
    return spark.createDataFrame(ROWS, "id int, created timestamp_ntz, updated timestamp_ntz")


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_delta_is_strict_and_a_null_side_does_not_block(rows):
    assert ids(delta.delta_scan(rows, D[2], "created", "updated")) == [2, 3, 4]


def test_delta_inclusive_takes_rows_at_the_mark_again(rows):
    assert ids(delta.delta_scan(rows, D[2], "created", "updated", strict=False)) == [2, 3, 4, 5]


def test_delta_with_an_extra_predicate(rows):
    got = delta.delta_scan(rows, D[2], "created", "updated", extra=F.col("id") > 2)
    assert ids(got) == [3, 4]


@pytest.mark.parametrize("dtype", ["timestamp_ntz", "timestamp"])
def test_delta_filter_reaches_the_parquet_scan(spark, rows, folder, dtype):
    typed = rows.withColumn("created", F.col("created").cast(dtype))
    typed.write.parquet(folder("rows"))
    plan = plan_of(delta.delta_scan(spark.read.parquet(folder("rows")), D[2], "created"))
    assert "PushedFilters: [IsNotNull(created), GreaterThan(created," in plan


def test_stats_are_one_aggregation(rows):
    stats = delta.delta_stats(rows, ["created", "updated"])
    assert plan_of(stats).count("partial_count") == 1
    assert tuple(stats.first()) == (6, D[4], D[4])


def next_mark(spark, created, updated, rule, old=D[0]):
    stats = spark.createDataFrame(
        [(1, created, updated)],
        "row_count long, max_created timestamp_ntz, max_updated timestamp_ntz",
    )
    return delta.next_watermark(stats, old, "created", "updated", rule).first()["next_watermark"]


def test_next_watermark_rules(spark):
    assert next_mark(spark, D[2], D[4], "greatest") == D[4]
    assert next_mark(spark, D[4], D[2], "greatest") == D[4]
    assert next_mark(spark, D[2], D[4], "created_only") == D[2]


def test_day_gap_needs_a_whole_day(spark):
    nearly = D[2] + timedelta(hours=23, minutes=59, seconds=59)
    assert next_mark(spark, D[2], nearly, "day_gap") == D[2]
    assert next_mark(spark, D[2], D[3], "day_gap") == D[3]
    assert next_mark(spark, D[4], D[2], "day_gap") == D[4]


def test_next_watermark_never_goes_back_or_to_null(spark):
    for rule in delta.NEXT_RULES:
        assert next_mark(spark, None, None, rule, old=D[7]) == D[7]
        assert next_mark(spark, D[2], D[3], rule, old=D[7]) == D[7]
    assert next_mark(spark, None, D[8], "greatest", old=D[7]) == D[8]


def test_unknown_rule_is_refused(spark):
    with pytest.raises(ValueError, match="rule"):
        next_mark(spark, D[1], D[1], "newest")


def test_no_loss_over_successive_runs(spark):
    """The union of the deltas is every row above the first mark, once."""
    days = spark.createDataFrame([(i, D[i % 10]) for i in range(50)], "id int, created timestamp_ntz")
    mark, seen = D[1], []
    for until in (D[3], D[6], D[9]):
        visible = days.where(F.col("created") <= F.lit(str(until)).cast("timestamp_ntz"))
        part = delta.delta_scan(visible, mark, "created")
        seen += ids(part)
        stats = delta.delta_stats(part, ["created"])
        mark = delta.next_watermark(stats, mark, "created").first()["next_watermark"]
    assert sorted(seen) == [i for i in range(50) if D[i % 10] > D[1]]
