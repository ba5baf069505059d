from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from conftest import rows_of
from syncflow.operators import audit
from syncflow.operators.audit import AuditColumns, BatchColumns

START, END, MARK = datetime(2022, 1, 1, 1), datetime(2022, 1, 1, 2), datetime(2021, 12, 31, 23, 59, 59, 123456)


def as_utc(df):
    return df.select(*[
        F.col(c).cast("timestamp_ntz").alias(c) if t == "timestamp" else F.col(c)
        for c, t in df.dtypes
    ])


def test_audit_row_is_typed_and_exact(spark):
    row = audit.audit_row(spark, START, END, "success", 5, MARK, "User", failed_count=2)
    assert row.schema.simpleString() == AuditColumns().schema().simpleString()
    assert as_utc(row).first() == (START, END, 1, 5, MARK, "User", 2)


def test_status_codes():
    assert audit.STATUS == {"failure": 0, "success": 1, "no_data": 2}


def test_audit_columns_can_be_renamed_or_left_out(spark):
    names = AuditColumns(count="Processed_Count", mark="created_on_date", object_name=None, failed_count=None)
    row = audit.audit_row(spark, START, END, "no_data", 0, MARK, columns=names)
    assert row.columns == [
        "execution_start_time", "execution_end_time", "is_success", "Processed_Count", "created_on_date",
    ]


def test_end_time_defaults_to_now(spark):
    row = as_utc(audit.audit_row(spark, START, None, "failure", 0, MARK)).first()
    now = datetime.now(timezone.utc).replace(tzinfo=None)
    assert abs(row["execution_end_time"] - now) < timedelta(minutes=5)


REGISTRY = "object_name string, created_on_date timestamp, is_merged int, batch_id long"


def test_batch_ids_follow_the_greatest_of_all_objects(spark):
    registry = spark.createDataFrame([("User", None, 1, 4), ("Account", None, 0, 9)], REGISTRY)
    row = as_utc(audit.register_batch(registry, "User", START)).first()
    assert row == ("User", START, 0, 10)
    assert audit.latest_batch(registry, "User").first()[0] == 4
    assert audit.latest_batch(registry, "Lead").first()[0] is None


def test_first_batch(spark):
    registry = spark.createDataFrame([], REGISTRY)
    assert audit.register_batch(registry, "User", START).first()["batch_id"] == 1


def test_registry_columns_can_be_renamed(spark):
    names = BatchColumns("ObjectName", "Created_On_Date", "Is_Merged", "batch")
    registry = spark.createDataFrame([], names.schema())
    row = audit.register_batch(registry, "User", START, 7, names)
    assert (row.columns, row.first()["batch"]) == (["ObjectName", "Created_On_Date", "Is_Merged", "batch"], 7)


def test_snapshot_tags(spark):
    rows = spark.createDataFrame([(1,)], "id int")
    tagged = audit.tag_snapshot(rows, 3, START)
    assert rows_of(as_utc(tagged)) == [(1, START, 3)]
    assert audit.tag_snapshot(rows, 3, load_col=None).columns == ["id", "batch_id"]


def test_claimed_ids_are_never_shared(spark, folder):
    registry = spark.createDataFrame([("User", 7)], "object_name string, batch_id long")
    claims = folder("claims")
    # Nothing is registered in between, as if all had asked at the same time.
    got = [audit.claim_batch_id(registry, claims, f"run {i}") for i in range(4)]
    assert got == [8, 9, 10, 11]
    later = registry.union(spark.createDataFrame([("User", 20)], registry.schema))
    assert audit.claim_batch_id(later, claims, "run 5") == 21


def test_claims_of_many_threads(spark, folder):
    registry = spark.createDataFrame([], "object_name string, batch_id long")
    with ThreadPoolExecutor(8) as pool:
        got = list(pool.map(lambda i: audit.claim_batch_id(registry, folder("ids"), str(i)), range(8)))
    assert max(got) >= len(set(got)) and min(got) == 1
