from __future__ import annotations

import json
import os
from dataclasses import replace
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import forget_last_commit, rows_of
from syncflow.functions.columns import EPOCH
from syncflow.operators.reshape import ColumnMap, apply_mapping
from syncflow.plans.config import OutboundConfig
from syncflow.plans.jobs import NO_KEY, run_inbound, run_outbound
from syncflow.plans.presets import ACCOUNT_AUDIT, USER_AUDIT, account_sync, user_sync
from syncflow.plans.standard_mappings import ACCOUNT_MAPPING, USER_MAPPING, parse_mapping
from syncflow.sinks.export import CSV_OPTIONS
from syncflow.sinks.keyed_table import KeyedTable
from syncflow.sources.tables import TableRef, read_table
from syncflow.streaming.incremental import stream_inbound

MAPPING = parse_mapping(ACCOUNT_MAPPING)
D = [datetime(2022, 3, day) for day in range(1, 20)]
TYPES = {
    "Latest_eGFR": "decimal(12,2)", "HCC_Score": "decimal(12,4)",
    "2_year_dialysis_crash_score": "decimal(12,4)", "DOB": "date",
    "No_of_hospitalizations_in_last_6_months": "int",
}
SOURCE = ", ".join(f"`{m.source}` {TYPES.get(m.source, 'string')}" for m in MAPPING) + (
    ", ENROLLMENT_end_date timestamp, created_on_date timestamp_ntz, updated_on_date timestamp_ntz"
)


def patient(key, created, updated=None, **values):
    row = {m.source: None for m in MAPPING}
    row.update(ENROLLMENT_end_date=None, created_on_date=created, updated_on_date=updated)
    return {**row, "patient_bk": key, "VBC_Program_Name": "Program", **values}


def add(spark, ref, *patients):
    schema = T.StructType.fromDDL(SOURCE)
    rows = [tuple(p[f.name] for f in schema.fields) for p in patients]
    spark.createDataFrame(rows, schema).write.mode("append").parquet(ref.path)


@pytest.fixture
def outbound(spark, folder):
    empty = spark.createDataFrame([], SOURCE)
    target = KeyedTable(
        spark, folder("target"), apply_mapping(empty, MAPPING).schema, ["Patient_BK__c"], buckets=4
    )
    return account_sync(
        TableRef(path=folder("source")),
        TableRef(path=folder("audit")),
        TableRef(path=folder("failures")),
        target=target,
        audit_columns=replace(ACCOUNT_AUDIT, failed_count="failed"),
    )


def audits(spark, cfg):
    names = cfg.audit_columns
    got = read_table(spark, cfg.audit).select(
        names.start, names.status, names.count,
        F.col(names.mark).cast("timestamp_ntz"), names.failed_count,
    )
    return [tuple(r)[1:] for r in sorted(got.collect())]


def programs(cfg):
    got = cfg.target.read().select("Patient_BK__c", "VBC_Program__c")
    return {r[0]: r[1] for r in got.collect()}


def test_outbound_runs_rows_then_nothing_then_an_update(spark, outbound):
    add(
        spark, outbound.source,
        patient("a", D[1]),
        patient("b", D[2], ENROLLMENT_end_date=D[3]),
        patient(None, D[0]),
        patient("a", D[0], VBC_Program_Name="older"),
    )
    first = run_outbound(spark, outbound)
    assert (first.status, first.count, first.watermark, first.failed_count) == ("success", 4, D[2], 1)
    assert programs(outbound) == {"a": "Program", "b": "NA"}
    failed = read_table(spark, outbound.failure_log)
    assert rows_of(failed) == [(None, NO_KEY, D[0])]

    second = run_outbound(spark, outbound)
    assert (second.status, second.count, second.watermark) == ("no_data", 0, D[2])

    add(spark, outbound.source, patient("a", D[0], D[9], VBC_Program_Name="updated"))
    assert run_outbound(spark, outbound).watermark == D[9]
    assert programs(outbound) == {"a": "updated", "b": "NA"}
    assert audits(spark, outbound) == [(1, 4, D[2], 1), (2, 0, D[2], 0), (1, 1, D[9], 0)]


def test_a_failed_run_holds_the_watermark_and_is_retried(spark, outbound, monkeypatch):
    add(spark, outbound.source, patient("a", D[1]))
    run_outbound(spark, outbound)
    add(spark, outbound.source, patient("b", D[4]))

    def refuse(*_args, **_options):
        raise ConnectionError("remote side is down")

    with monkeypatch.context() as patched:
        patched.setattr(outbound.target, "upsert", refuse)
        with pytest.raises(ConnectionError):
            run_outbound(spark, outbound)
    assert audits(spark, outbound)[-1] == (0, 0, D[1], 0)
    assert run_outbound(spark, outbound).count == 1
    assert set(programs(outbound)) == {"a", "b"}


def test_on_failure_advance_skips_the_rows_of_the_failed_run(spark, outbound, monkeypatch):
    outbound.on_failure = "advance"
    add(spark, outbound.source, patient("a", D[1]))

    def refuse(*_args, **_options):
        raise ConnectionError

    with monkeypatch.context() as patched:
        patched.setattr(outbound.target, "upsert", refuse)
        with pytest.raises(ConnectionError):
            run_outbound(spark, outbound)
    assert audits(spark, outbound) == [(0, 0, D[1], 0)]
    assert run_outbound(spark, outbound).status == "no_data"


def test_a_mapping_error_is_audited(spark, outbound):
    add(spark, outbound.source, patient("a", D[1]))
    outbound.mask = {"VBC_Program_Name": "no_such_column"}
    with pytest.raises(Exception, match="no_such_column"):
        run_outbound(spark, outbound)
    assert audits(spark, outbound) == [(0, 0, EPOCH, 0)]


@pytest.mark.parametrize("limit", [10**6, 0])
def test_delivery_results_are_matched_to_their_rows(spark, outbound, folder, monkeypatch, limit):
    monkeypatch.setattr("syncflow.staging.SMALL_ON_DISK", limit)
    outbound.export_path = folder("batches")
    add(spark, outbound.source, patient("a", D[1]), patient("b", D[2]), patient("c", D[3]))

    def deliver(path):
        sent = spark.read.option("header", True).csv(path)
        key = F.col("Patient_BK__c")
        return sent.select(
            key,
            F.when(key == "a", "true").when(key == "b", "false").alias("success"),
            F.when(key == "b", "bad value").alias("error"),
        )

    outbound.deliver = deliver
    result = run_outbound(spark, outbound)
    assert (result.count, result.failed_count) == (3, 2)
    assert rows_of(read_table(spark, outbound.failure_log)) == [
        ("b", "bad value", D[2]), ("c", None, D[3]),
    ]
    assert set(programs(outbound)) == {"a"}


def test_created_only_rule_and_override(spark, outbound):
    outbound.rule = "created_only"
    outbound.override = D[0]
    add(spark, outbound.source, patient("a", D[0]), patient("b", D[1], D[8]))
    result = run_outbound(spark, outbound)
    assert (result.count, result.watermark) == (1, D[1])


def test_inclusive_runs_lose_no_row_that_arrives_at_the_mark(spark, outbound):
    outbound.strict = False
    add(spark, outbound.source, patient("a", D[1]))
    run_outbound(spark, outbound)
    add(spark, outbound.source, patient("late", D[1]))
    assert run_outbound(spark, outbound).count == 2
    assert programs(outbound) == {"a": "Program", "late": "Program"}


def test_presets(folder):
    ref = TableRef(path=folder("t"))
    legacy = account_sync(ref, ref, ref, legacy=True, export_path=folder("out"))
    legacy.validate()
    assert (legacy.rule, legacy.on_failure, legacy.target_key) == ("created_only", "advance", "Patient_BK__c")
    assert legacy.audit_columns.schema().names == [
        "execution_start_time", "execution_end_time", "is_success", "Patients_Processed_Count", "created_on_date",
    ]
    users = user_sync(folder("l"), ref, ref, ref, legacy=True, zone="America/New_York")
    users.validate()
    assert (users.rule, users.datetime_as_string, users.zone) == ("day_gap", True, "America/New_York")
    assert user_sync("", ref, ref, ref, rule="day_gap").datetime_as_string is False


def test_every_required_setting_is_checked(outbound):
    outbound.validate()
    for name in OutboundConfig.REQUIRED:
        broken = OutboundConfig(**{**outbound.__dict__, name: "" if name in ("key", "created") else None})
        with pytest.raises(ValueError):
            broken.validate()
    with pytest.raises(ValueError, match="target"):
        OutboundConfig(**{**outbound.__dict__, "target": None}).validate()
    with pytest.raises(ValueError, match="on_failure"):
        OutboundConfig(**{**outbound.__dict__, "on_failure": "skip"}).validate()


# -- inbound -------------------------------------------------------------------


def millis(at):
    return int((at - EPOCH) / timedelta(milliseconds=1))


def user(ident, created, modified=None, **values):
    record = {m.source: None for m in parse_mapping(USER_MAPPING)}
    record.update(
        Id=ident, IsActive=True, CreatedDate=millis(created),
        LastModifiedDate=millis(modified or created), Phone="0" * 30,
    )
    return {**record, **values}


def land(cfg, name, *records):
    os.makedirs(cfg.landing, exist_ok=True)
    with open(f"{cfg.landing}/{name}.json", "w") as out:
        json.dump(list(records), out)


@pytest.fixture
def inbound(folder):
    return user_sync(
        folder("landing"),
        TableRef(path=folder("snapshot")),
        TableRef(path=folder("registry")),
        TableRef(path=folder("audit")),
        audit_columns=replace(USER_AUDIT, failed_count="failed"),
    )


def snapshot(spark, cfg):
    return read_table(spark, cfg.snapshot).select("Id", "batch_id")


def test_inbound_runs(spark, inbound):
    land(inbound, "1", user("u1", D[1]), user("u2", D[2], IsActive=False), {})
    first = run_inbound(spark, inbound)
    assert (first.status, first.count, first.watermark, first.batch_id) == ("success", 1, D[1], 1)

    assert run_inbound(spark, inbound).status == "no_data"

    land(inbound, "2", user("u1", D[1], D[5]), user("u3", D[6]))
    third = run_inbound(spark, inbound)
    assert (third.count, third.watermark, third.batch_id) == (2, D[6], 2)
    assert rows_of(snapshot(spark, inbound)) == [("u1", 1), ("u1", 2), ("u3", 2)]
    assert [a[:3] for a in audits(spark, inbound)] == [(1, 1, D[1]), (2, 0, D[1]), (1, 2, D[6])]
    registry = read_table(spark, inbound.registry).select("ObjectName", "Is_Merged_To_DW", "batch_id")
    assert rows_of(registry) == [("User", 0, 1), ("User", 0, 2)]


def test_inbound_snapshot_columns_and_text_dates(spark, inbound):
    inbound.datetime_as_string, inbound.zone = True, "America/New_York"
    land(inbound, "1", user("u1", datetime(2022, 1, 1, 5, 0, 0, 999000)))
    run_inbound(spark, inbound)
    got = read_table(spark, inbound.snapshot)
    assert got.columns == [
        "Alias", "Id", "IsActive", "UserRole_Name", "Contact_Name", "Profile_Name", "FirstName",
        "LastName", "Username", "Mobile", "LastModifiedBy", "time_stamp", "LastModifiedDate",
        "CreatedDate", "LastLoginDate", "batch_id",
    ]
    row = got.first()
    assert (row["CreatedDate"], row["LastLoginDate"], row["Mobile"]) == ("2022-01-01 00:00:00", None, "0" * 30)


def test_inbound_text_flags(spark, inbound):
    inbound.read_types = {}
    land(inbound, "1", user("u1", D[1], IsActive="True"), user("u2", D[1], IsActive="None"))
    assert run_inbound(spark, inbound).count == 1


def test_inbound_day_gap(spark, inbound):
    inbound.rule = "day_gap"
    land(inbound, "1", user("u1", D[1], D[1] + timedelta(hours=23)))
    assert run_inbound(spark, inbound).watermark == D[1]
    assert run_inbound(spark, inbound).count == 1  # modified above the mark: read again


def test_inbound_empty_landing_is_no_data_and_failure_holds(spark, inbound, monkeypatch):
    os.makedirs(inbound.landing)
    assert run_inbound(spark, inbound).status == "no_data"
    land(inbound, "1", user("u1", D[1]))

    def refuse(*_):
        raise OSError("full")

    with monkeypatch.context() as patched:
        patched.setattr("syncflow.plans.jobs.append_snapshot", refuse)
        with pytest.raises(OSError):
            run_inbound(spark, inbound)
    assert [a[:3] for a in audits(spark, inbound)] == [(2, 0, EPOCH), (0, 0, EPOCH)]
    assert run_inbound(spark, inbound).batch_id == 1


def test_a_crash_before_registration_reuses_the_batch(spark, inbound, monkeypatch):
    land(inbound, "1", user("u1", D[1]))

    def crash(*_args):
        raise OSError("driver lost")

    with monkeypatch.context() as patched:
        patched.setattr("syncflow.plans.jobs.register_batch", crash)
        with pytest.raises(OSError):
            run_inbound(spark, inbound)
    run_inbound(spark, inbound)
    assert rows_of(snapshot(spark, inbound)) == [("u1", 1)]


def test_objects_have_their_own_watermarks(spark, inbound):
    land(inbound, "1", user("u1", D[5]))
    run_inbound(spark, inbound)
    inbound.object_name = "Contact"
    assert run_inbound(spark, inbound).batch_id == 2


def test_inbound_stream_takes_new_files_only_and_late_records_too(spark, inbound, folder):
    land(inbound, "1", user("u1", D[5]))
    stream_inbound(spark, inbound, folder("checkpoint")).awaitTermination()
    land(inbound, "2", user("u2", D[2]), user("off", D[2], IsActive=False))
    for _ in range(2):
        stream_inbound(spark, inbound, folder("checkpoint")).awaitTermination()
    assert rows_of(snapshot(spark, inbound)) == [("u1", 1), ("u2", 2)]
    assert [a[:3] for a in audits(spark, inbound)] == [(1, 1, D[5]), (1, 1, D[5])]


def test_inbound_stream_split_over_micro_batches_loses_nothing(spark, inbound, folder):
    for i in range(3):
        land(inbound, str(i), user(f"u{i}", D[9 - i]))
    stream_inbound(spark, inbound, folder("checkpoint"), max_files=1).awaitTermination()
    assert snapshot(spark, inbound).count() == 3
    assert snapshot(spark, inbound).select("batch_id").distinct().count() == 3


def test_a_repeated_inbound_micro_batch_replaces_its_batch(spark, inbound, folder):
    land(inbound, "1", user("u1", D[1]))
    stream_inbound(spark, inbound, folder("checkpoint")).awaitTermination()
    forget_last_commit(folder)
    stream_inbound(spark, inbound, folder("checkpoint")).awaitTermination()
    assert rows_of(snapshot(spark, inbound)) == [("u1", 1)]
    assert read_table(spark, inbound.registry).count() == 1
    land(inbound, "2", user("u2", D[2]))
    stream_inbound(spark, inbound, folder("checkpoint")).awaitTermination()
    assert rows_of(snapshot(spark, inbound)) == [("u1", 1), ("u2", 2)]


# -- latest row before the cast, batches, manifest, unmapped attributes ------------


def one_outbound(spark, folder, rows, **settings):
    schema = "k string, amount double, n int, changed timestamp_ntz"
    cfg = OutboundConfig(
        source=TableRef(path=folder("source")),
        audit=TableRef(path=folder("audit")),
        failure_log=TableRef(path=folder("failures")),
        mapping=[
            ColumnMap("k", "k", "varchar(10)"),
            ColumnMap("amount", "amount", "decimal(5,2)"),
            ColumnMap("n", "n", "int"),
        ],
        key="k",
        created="changed",
        target=KeyedTable(
            spark, folder("target"), T.StructType.fromDDL("k string, amount decimal(5,2), n int"), ["k"]
        ),
        **settings,
    )
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(cfg.source.path)
    return cfg


def test_the_latest_row_is_chosen_before_values_are_cast(spark, folder):
    rows = [("a", 1.0, 1, D[1]), ("a", 12345.0, 2, D[1]), ("b", 5.0, 3, D[2]), ("b", None, 4, D[2])]
    cfg = one_outbound(spark, folder, rows)
    result = run_outbound(spark, cfg)
    # The larger amount wins the tie, does not fit, and is reported instead of lost.
    assert (result.count, result.failed_count, result.watermark) == (4, 1, D[2])
    assert rows_of(read_table(spark, cfg.failure_log)) == [("a", "values do not fit: amount", D[1])]
    assert [r["k"] for r in cfg.target.read().collect()] == ["b"]


def test_results_are_matched_by_batch_and_place(spark, folder):
    def deliver(path):
        sent = spark.read.options(**CSV_OPTIONS).csv(path)
        assert {c for c in ("batch", "seq")} <= set(sent.columns)
        sizes = {r["batch"]: r["count"] for r in sent.groupBy("batch").count().collect()}
        assert all(n <= 2 for n in sizes.values())
        answered = sent.where("k <> 'k7'").select("batch", F.col("seq").cast("int").alias("seq"), "k")
        stray = spark.createDataFrame([("nobody", 1, "x")], "batch string, seq int, k string")
        return answered.union(stray).select(
            "batch",
            "seq",
            F.when(F.col("k") == "k3", "false").otherwise("true").alias("success"),
            F.when(F.col("k").isin("k3", "x"), F.concat(F.lit("no "), "k")).alias("error"),
        )

    rows = [(f"k{i}", float(i), i, D[1]) for i in range(11)]
    cfg = one_outbound(
        spark, folder, rows, export_path=folder("out"), deliver=deliver, match="batch",
        sequence="seq", batch_size=2,
    )
    assert run_outbound(spark, cfg).failed_count == 3
    log = read_table(spark, cfg.failure_log).select("k", "error_message")
    assert rows_of(log) == [
        ("k3", "no k3"), ("k7", "no result"), ("nobody:1", "result without a sent row: no x"),
    ]
    assert {r["k"] for r in cfg.target.read().collect()} == {f"k{i}" for i in range(11)} - {"k3", "k7"}
    with pytest.raises(ValueError, match="sequence"):
        replace(cfg, sequence=None).validate()


def test_a_manifest_run_opens_new_files_only(spark, inbound):
    inbound.manifest = inbound.landing + "-manifest"
    assert run_inbound(spark, inbound).status == "no_data"
    land(inbound, "1", user("u1", D[5]), user("off", D[5], IsActive=False))
    assert run_inbound(spark, inbound).count == 1
    # Were the first file opened again, its broken records would fail the run.
    path = f"{inbound.landing}/1.json"
    seen = os.stat(path)
    with open(path, "r+") as old:
        old.write("x" * seen.st_size)
    os.utime(path, ns=(seen.st_atime_ns, seen.st_mtime_ns))
    land(inbound, "2", user("late", D[2]))
    third = run_inbound(spark, inbound)
    assert (third.count, third.watermark, third.batch_id) == (1, D[5], 2)
    assert run_inbound(spark, inbound).status == "no_data"
    assert rows_of(snapshot(spark, inbound)) == [("late", 2), ("u1", 1)]


def test_a_manifest_run_that_dies_is_repeated_as_planned(spark, inbound, monkeypatch):
    inbound.manifest = inbound.landing + "-manifest"
    land(inbound, "1", user("u1", D[1]))

    def crash(*_args):
        raise OSError("driver lost")

    with monkeypatch.context() as patched:
        patched.setattr("syncflow.sources.manifest.LandingManifest.commit", crash)
        with pytest.raises(OSError):
            run_inbound(spark, inbound)
    land(inbound, "2", user("u2", D[2]))
    assert run_inbound(spark, inbound).batch_id == 1
    assert rows_of(snapshot(spark, inbound)) == [("u1", 1)]
    assert read_table(spark, inbound.registry).count() == 1
    assert run_inbound(spark, inbound).batch_id == 2
    assert rows_of(snapshot(spark, inbound)) == [("u1", 1), ("u2", 2)]


@pytest.mark.parametrize("manifest", [False, True])
def test_unmapped_attributes_are_kept(spark, inbound, manifest):
    inbound.unmapped = "others"
    inbound.manifest = inbound.landing + "-manifest" if manifest else None
    land(inbound, "1", user("u1", D[1]), user("u2", D[2], New={"a": [1, "x"]}, Flag=True))
    assert run_inbound(spark, inbound).count == 2
    got = read_table(spark, inbound.snapshot).select("Id", "others")
    assert rows_of(got) == [("u1", None), ("u2", '{"Flag":true,"New":{"a":[1,"x"]}}')]


def test_claimed_batch_ids(spark, inbound, folder):
    inbound.claims = folder("claims")
    land(inbound, "1", user("u1", D[1]))
    os.makedirs(folder("claims"))
    with open(os.path.join(folder("claims"), f"{1:020d}"), "w"):
        pass  # another run has claimed the first id and not registered it yet
    assert run_inbound(spark, inbound).batch_id == 2


def test_every_failed_result_is_logged(spark, folder):
    def deliver(path):
        sent = spark.read.options(**CSV_OPTIONS).csv(path)
        first = sent.select("k", F.lit("false").alias("success"), F.lit("first").alias("error"))
        return first.union(sent.select("k", F.lit("false"), F.lit("second"))).where("k = 'a'").union(
            sent.where("k <> 'a'").select("k", F.lit("true"), F.lit(None).cast("string"))
        )

    rows = [("a", 1.0, 1, D[1]), ("b", 1.0, 2, D[2])]
    cfg = one_outbound(spark, folder, rows, export_path=folder("out"), deliver=deliver)
    assert run_outbound(spark, cfg).failed_count == 2
    log = read_table(spark, cfg.failure_log).select("k", "error_message")
    assert rows_of(log) == [("a", "first"), ("a", "second")]
