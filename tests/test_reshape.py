from __future__ import annotations

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import plan_of, rows_of
from syncflow.functions.columns import is_true
from syncflow.operators import reshape
from syncflow.operators.reshape import ColumnMap
from syncflow.plans.standard_mappings import ACCOUNT_MAPPING, USER_MAPPING, parse_mapping


def test_mapping_renames_prunes_reorders_and_casts(spark):
    rows = spark.createDataFrame([("k", "1.005", "x")], "a string, 2_b string, c string")
    maps = [ColumnMap("2_b", "score", "decimal(12,2)"), ColumnMap("A", "key", "varchar(100)")]
    got = reshape.apply_mapping(rows, maps)
    assert got.dtypes == [("score", "decimal(12,2)"), ("key", "string")]
    assert got.first() == (Decimal("1.01"), "k")


def test_mapping_may_swap_names(spark):
    rows = spark.createDataFrame([(1, 2)], "a int, b int")
    got = reshape.apply_mapping(rows, [ColumnMap("a", "b"), ColumnMap("b", "a")])
    assert (got.columns, tuple(got.first())) == (["b", "a"], (1, 2))


def test_mapping_problems_are_named_before_anything_runs(spark):
    rows = spark.createDataFrame([(1, 2)], "a int, b int")
    with pytest.raises(ValueError, match="absent.*nope"):
        reshape.apply_mapping(rows, [ColumnMap("nope", "x")])
    with pytest.raises(ValueError, match="more than once.*x"):
        reshape.apply_mapping(rows, [ColumnMap("a", "x"), ColumnMap("b", "X")])
    with pytest.raises(ValueError, match="cast"):
        reshape.apply_mapping(rows, [ColumnMap("a", "x")], cast="maybe")


def test_try_and_strict_casts(spark):
    rows = spark.createDataFrame([("None",), ("99999999999.00",)], "a string")
    maps = [ColumnMap("a", "a", "decimal(12,2)")]
    assert [r[0] for r in reshape.apply_mapping(rows, maps).collect()] == [None, None]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|NUMERIC_VALUE_OUT_OF_RANGE"):
        reshape.apply_mapping(rows, maps, cast="strict").collect()
    assert reshape.apply_mapping(rows, maps, cast=None).dtypes == [("a", "string")]


TEXTS = [" 7 ", "+7", "-7", "007", "7.0", "7.9", ".", "", "7\t", "\x007", "x7", "7e1", "None",
         "99999999999", "-", "7-8", "٧", None]
NUMBERS = [0.0, -0.004, 99.99, 99.994, 99.995, 99.999, 100.0, -100.0, 1e300, float("nan"), float("inf"), None]


@pytest.mark.parametrize("source, dtype, values", [
    ("string", "int", TEXTS), ("string", "bigint", TEXTS), ("string", "decimal(4,2)", TEXTS),
    ("double", "decimal(4,2)", NUMBERS), ("double", "int", NUMBERS),
    ("int", "decimal(4,2)", [99, 100, -99, -100, None]),
])
def test_quick_casts_equal_plain_try_casts(spark, source, dtype, values):
    rows = spark.createDataFrame([(v,) for v in values], f"a {source}")
    quick = reshape.apply_mapping(rows, [ColumnMap("a", "b", dtype)])
    plain = rows.select(F.col("a").try_cast(dtype))
    assert [r[0] for r in quick.collect()] == [r[0] for r in plain.collect()]


def test_flags(spark):
    rows = spark.createDataFrame([("True",), (" yes ",), ("1",), ("None",), ("false",), (None,)], "a string")
    assert [r[0] for r in rows.select(is_true(F.col("a"))).collect()] == [True] * 3 + [False] * 3
    assert spark.range(1).select(is_true(F.lit(True))).first()[0]


def test_lengths_are_cut_only_on_request(spark):
    rows = spark.createDataFrame([(1, "é" * 30), (2, "short"), (3, None)], "id int, phone string")
    maps = [ColumnMap("id", "id"), ColumnMap("phone", "mobile", "varchar(25)")]
    lengths = lambda df: [r[0] for r in df.orderBy("id").select(F.length("mobile")).collect()]
    assert lengths(reshape.apply_mapping(rows, maps)) == [30, 5, None]
    assert lengths(reshape.apply_mapping(rows, maps, truncate=True)) == [25, 5, None]
    assert [r["id"] for r in reshape.overlong_rows(rows, maps).collect()] == [1]


@pytest.mark.parametrize(
    "dtype, spark_type, length",
    [
        ("varchar(100)", "string", 100),
        ("NVARCHAR( 25 )", "string", 25),
        ("char(1)", "string", 1),
        ("varchar(max)", "string", None),
        ("decimal(12,2)", "decimal(12,2)", None),
        (None, None, None),
    ],
)
def test_column_types(dtype, spark_type, length):
    m = ColumnMap("a", "b", dtype)
    assert (m.spark_type, m.max_length) == (spark_type, length)


def test_standard_mappings():
    account, user = parse_mapping(ACCOUNT_MAPPING), parse_mapping(USER_MAPPING)
    assert (len(account), len(user)) == (21, 14)
    assert account[10].dtype == "decimal(12,2)" and account[0].dtype is None
    assert [m.source for m in user if m.dtype == "bigint"] == [
        "LastLoginDate", "LastModifiedDate", "CreatedDate",
    ]


def test_mask_keeps_open_rows_and_the_column_position(spark):
    rows = spark.createDataFrame(
        [(1, "P", None), (2, "Q", datetime(2022, 1, 1)), (3, None, None)],
        "id int, Program string, end_date timestamp",
    )
    got = reshape.mask_closed(rows, "program", "END_DATE")
    assert got.columns == ["id", "Program", "end_date"]
    assert [r["Program"] for r in got.orderBy("id").collect()] == ["P", "NA", None]
    assert reshape.mask_closed(rows, "program", "end_date", move_last=True).columns == [
        "id", "end_date", "Program",
    ]


def test_epoch_text_is_cut_towards_zero(spark):
    rows = spark.createDataFrame(
        [(1, 1650000000123), (2, -1500), (3, None)], "id int, at long"
    )
    text = reshape.epoch_millis_to_datetime(rows, ["AT"], as_string=True).orderBy("id")
    assert [r["at"] for r in text.collect()] == ["2022-04-15 05:20:00", "1969-12-31 23:59:59", None]
    east = reshape.epoch_millis_to_datetime(rows, ["at"], as_string=True, zone="America/New_York")
    assert east.orderBy("id").first()["at"] == "2022-04-15 01:20:00"


def test_epoch_timestamp_keeps_milliseconds_and_can_move_last(spark):
    rows = spark.createDataFrame([(1650000000123, "x")], "at long, other string")
    got = reshape.epoch_millis_to_datetime(rows, ["at"], move_last=True)
    assert got.columns == ["other", "at"]
    assert got.select(F.col("at").cast("timestamp_ntz")).first()[0] == datetime(
        2022, 4, 15, 5, 20, 0, 123000
    )


def test_text_dates(spark):
    rows = spark.createDataFrame([("2022-04-15 05:20:00",), ("15.04.2022",), ("None",), (None,)], "at string")
    got = reshape.text_to_datetime(rows, ["AT"]).select(F.col("at").cast("timestamp_ntz"))
    assert [r[0] for r in got.collect()] == [datetime(2022, 4, 15, 5, 20), None, None, None]


def test_tokens_become_null(spark):
    rows = spark.createDataFrame([("None",), ("nan",), ("",), ("x",), (None,)], "a string")
    assert [r[0] for r in reshape.nullify_tokens(rows, ["a"]).collect()] == [
        None, None, None, "x", None,
    ]


def test_tokens_in_columns_of_other_types(spark):
    rows = spark.createDataFrame([(1,), (None,)], "a int")
    assert [r[0] for r in reshape.nullify_tokens(rows, ["a"]).collect()] == [1, None]


def test_required_and_missing_columns_split_the_rows(spark):
    rows = spark.createDataFrame([("k", 1), ("", 2), (None, 3), ("j", None)], "a string, b int")
    assert rows_of(reshape.require_columns(rows, ["a", "b"])) == [("k", 1)]
    assert reshape.missing_columns(rows, ["a", "b"]).count() == 3


def test_only_mapped_columns_are_read(spark, folder):
    spark.createDataFrame([(1, 2, 3)], "a int, b int, c int").write.parquet(folder("rows"))
    got = reshape.apply_mapping(spark.read.parquet(folder("rows")), [ColumnMap("b", "x")])
    assert "ReadSchema: struct<b:int>" in plan_of(got)
