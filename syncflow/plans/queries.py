"""One query per operator, on whole tables.

Roles: ``orders`` are source rows (created ``o_orderdate``, updated at the
latest ship date of the order), ``customer`` is the upsert target, ``events``
are remote records. Values that stand for failures, missing texts or closed
enrolments are derived from the rows' own columns.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from syncflow.functions.columns import instant
from syncflow.operators import (
    audit,
    delta,
    digest,
    key_filter,
    merge,
    numbering,
    reconcile,
    reshape,
)
from syncflow.operators.reshape import ColumnMap
from syncflow.plans.config import InboundConfig, OutboundConfig
from syncflow.plans.jobs import run_inbound, run_outbound
from syncflow.session import configure, footer_session
from syncflow.sinks import export
from syncflow.sinks.bucketed_table import BucketedTable
from syncflow.sinks.export import CSV_OPTIONS
from syncflow.sinks.keyed_table import KeyedTable
from syncflow.sources.mapping import load_mapping
from syncflow.sources.records import (
    RESULT_SCHEMA,
    read_json_object,
    read_json_variant,
    read_results,
    results_frame,
)
from syncflow.sources.tables import TableRef, read_table
from syncflow.staging import Staging
from syncflow.streaming import incremental
from syncflow.streaming.incremental import read_landing

Query = Callable[[SparkSession, str], DataFrame]

MARK = "2001-06-01"
MICROS = "ts_us"

QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    """Register a query under its function name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(configure(spark), sf_dir)

    QUERIES[function.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, TableRef(path=f"{sf_dir}/{name}.parquet"))


# -- inputs -------------------------------------------------------------------


def source_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with ``updated``: null for orders without a line."""
    shipped = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.max("l_shipdate").alias("updated"))
    )
    return table(spark, sf_dir, "orders").join(shipped, "o_orderkey", "left")


def order_delta(spark: SparkSession, sf_dir: str, mark: str = MARK, **options) -> DataFrame:
    rows = source_orders(spark, sf_dir)
    return delta.delta_scan(rows, mark, "o_orderdate", "updated", **options)


def delivery_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A result per order: low priority fails, unspecified priority has no verdict."""
    priority = F.col("o_orderpriority")
    return results_frame(
        table(spark, sf_dir, "orders"),
        "o_custkey",
        F.when(priority == "5-LOW", "false").when(priority != "4-NOT SPECIFIED", "true"),
        F.when(priority == "5-LOW", F.concat(F.lit("REJECTED:"), F.col("o_orderstatus"))),
        o_orderkey=F.col("o_orderkey"),
    )


def incoming_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row of every ordering customer from the delta, and a prospect row of each.

    Prospects have negative keys, which the target does not hold.
    """
    key, priority = F.col("o_custkey"), F.col("o_orderpriority")
    latest = merge.dedup_latest(
        order_delta(spark, sf_dir).select(
            "o_custkey", "o_orderdate", "o_orderkey", "o_orderpriority"
        ),
        ["o_custkey"],
        ["o_orderdate", "o_orderkey"],
    )
    return latest.select(
        F.explode(F.array(key, -1 - key)).alias("c_custkey"),
        F.when(priority != "5-LOW", priority).alias("c_mktsegment"),
    )


# -- watermark and delta --------------------------------------------------------


@query
def watermark_max(spark, d):
    """Newest mark of one object."""
    return delta.watermark_row(
        table(spark, d, "orders"), "o_orderdate", object_name="F", object_col="o_orderstatus"
    )


@query
def watermark_default(spark, d):
    """An object without a log row starts at the epoch."""
    return delta.watermark_row(
        table(spark, d, "orders"), "o_orderdate", object_name="none", object_col="o_orderstatus"
    )


@query
def watermark_ms(spark, d):
    """Newest mark cut to milliseconds."""
    return delta.watermark_row(table(spark, d, "events"), "ts", precision="ms")


@query
def watermark_by_object(spark, d):
    return delta.watermark_by_object(table(spark, d, "events"), "ts", "event_type")


@query
def delta_scan(spark, d):
    return order_delta(spark, d)


@query
def delta_scan_inclusive(spark, d):
    """Rows at the mark are taken again."""
    return order_delta(spark, d, strict=False)


@query
def delta_after_log(spark, d):
    """The mark comes from the log: orders above the newest mark of status F."""
    rows = table(spark, d, "orders")
    mark = delta.watermark(
        rows, "o_orderdate", object_name="F", object_col="o_orderstatus", precision="ms"
    )
    return delta.delta_scan(source_orders(spark, d), mark, "o_orderdate", "updated")


@query
def backfill_delta(spark, d):
    """An override beats the mark in the log."""
    rows = table(spark, d, "orders")
    mark = delta.watermark(rows, "o_orderdate", override="2000-01-01 00:00:00.000")
    return delta.delta_scan(rows, mark, "o_orderdate")


@query
def delta_stats(spark, d):
    return delta.delta_stats(order_delta(spark, d), ["o_orderdate", "updated"])


@query
def active_delta(spark, d):
    rows = table(spark, d, "events")
    active = F.col("event_type") != "error"
    return delta.delta_scan(rows, "2024-01-10", "ts", extra=active)


def _next(spark, d, rule):
    stats = delta.delta_stats(order_delta(spark, d), ["o_orderdate", "updated"])
    return delta.next_watermark(stats, MARK, "o_orderdate", "updated", rule).select(
        "next_watermark"
    )


@query
def next_watermark_greatest(spark, d):
    return _next(spark, d, "greatest")


@query
def next_watermark_created_only(spark, d):
    return _next(spark, d, "created_only")


@query
def next_watermark_day_gap(spark, d):
    return _next(spark, d, "day_gap")


# -- reshaping ------------------------------------------------------------------

CUSTOMER_MAPPING = [
    ColumnMap("c_mktsegment", "program", "varchar(100)"),
    ColumnMap("c_custkey", "external_key", "varchar(100)"),
    ColumnMap("c_acctbal", "score", "decimal(12,2)"),
    ColumnMap("C_NAME", "full_name"),
]


@query
def mask_closed(spark, d):
    """Segment of customers whose account is in debt is hidden."""
    end = F.when(F.col("c_acctbal") < 0, instant("2001-01-01", T.TimestampNTZType()))
    rows = table(spark, d, "customer").withColumn("end_date", end)
    return reshape.mask_closed(rows, "c_mktsegment", "end_date").drop("end_date")


@query
def map_project(spark, d):
    return reshape.apply_mapping(table(spark, d, "customer"), CUSTOMER_MAPPING)


@query
def map_from_file(spark, d):
    """The mapping is read from a file, which lists its lines by the text in them."""
    lines = [
        "source,target,dtype",
        "c_mktsegment,program,varchar(100)",
        'c_custkey,external_key,"varchar(100)"',
        'c_acctbal,score,"decimal(12,2)"',
        "c_name,full_name,NA",
    ]
    path = Staging(spark, "mapping").folder("file")
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(path)
    return reshape.apply_mapping(table(spark, d, "customer"), load_mapping(spark, path))


@query
def map_cast_try(spark, d):
    """Overflowing and malformed values become null."""
    maps = [
        ColumnMap("o_orderkey", "external_key", "varchar(100)"),
        ColumnMap("o_totalprice", "price", "decimal(7,2)"),
        ColumnMap("o_orderpriority", "priority_number", "int"),
        ColumnMap("o_orderdate", "order_day", "date"),
    ]
    return reshape.apply_mapping(table(spark, d, "orders"), maps)


_SHORT_MAPPING = [
    ColumnMap("o_orderkey", "order_key", "bigint"),
    ColumnMap("o_orderpriority", "priority", "varchar(8)"),
    ColumnMap("o_orderstatus", "status", "char(1)"),
]


@query
def map_truncate(spark, d):
    """Texts cut to the length of their mapped type."""
    return reshape.apply_mapping(table(spark, d, "orders"), _SHORT_MAPPING, truncate=True)


@query
def overlong_rows(spark, d):
    """Rows to reject where cutting is not wanted."""
    return reshape.overlong_rows(table(spark, d, "orders"), _SHORT_MAPPING)


def _landed_as_text(spark, d) -> DataFrame:
    """Events as text throughout, with 'None' for absent values."""
    failed = F.col("event_type") == "error"
    return table(spark, d, "events").select(
        F.col("event_id").cast("string").alias("event_id"),
        F.when(failed, "None").otherwise(F.col("user_id").cast("string")).alias("user_id"),
        F.when(failed, "None").otherwise(F.col("props")).alias("props"),
    )


@query
def nullify_and_cast(spark, d):
    rows = reshape.nullify_tokens(_landed_as_text(spark, d), ["user_id", "props"])
    maps = [
        ColumnMap("event_id", "event_id", "bigint"),
        ColumnMap("user_id", "user_id", "bigint"),
        ColumnMap("props", "props", "varchar(100)"),
    ]
    return reshape.apply_mapping(rows, maps)


def _with_millis(spark, d) -> DataFrame:
    millis = F.unix_millis(F.col("ts").cast("timestamp"))
    return table(spark, d, "events").select("event_id", millis.alias("modified"), "event_type")


@query
def epoch_to_datetime(spark, d):
    """Epoch milliseconds to second-precision text; the column moves to the end."""
    return reshape.epoch_millis_to_datetime(
        _with_millis(spark, d), ["modified"], as_string=True, move_last=True
    )


@query
def epoch_to_datetime_zone(spark, d):
    """The same in a named zone."""
    return reshape.epoch_millis_to_datetime(
        _with_millis(spark, d), ["modified"], as_string=True, zone="America/New_York"
    )


@query
def epoch_to_timestamp(spark, d):
    """Epoch milliseconds to timestamps that keep the milliseconds."""
    rows = reshape.epoch_millis_to_datetime(_with_millis(spark, d), ["modified"])
    return rows.withColumn("modified", F.col("modified").cast("timestamp_ntz"))


@query
def text_watermark(spark, d):
    """Dates that travelled as text, parsed back before the next mark is taken."""
    rows = reshape.epoch_millis_to_datetime(_with_millis(spark, d), ["modified"], as_string=True)
    created = reshape.text_to_datetime(rows, ["modified"]).withColumnRenamed("modified", "made")
    stats = delta.delta_stats(created, ["made"])
    return delta.next_watermark(stats, "2024-01-01", "made").select(
        "row_count", F.col("next_watermark").cast("timestamp_ntz").alias("next_watermark")
    )


@query
def require_columns(spark, d):
    rows = reshape.nullify_tokens(_landed_as_text(spark, d), ["user_id"])
    return reshape.require_columns(rows, ["event_id", "user_id"])


@query
def missing_columns(spark, d):
    rows = reshape.nullify_tokens(_landed_as_text(spark, d), ["user_id"])
    return reshape.missing_columns(rows, ["event_id", "user_id"])


# -- merging --------------------------------------------------------------------


@query
def dedup_latest(spark, d):
    rows = table(spark, d, "lineitem")
    return merge.dedup_latest(rows, ["l_orderkey", "l_linenumber"], ["l_shipdate"])


@query
def unkeyed_rows(spark, d):
    """Orders without a line have no update date: as a key it would be null."""
    return merge.unkeyed_rows(source_orders(spark, d), ["o_orderkey", "updated"]).drop("updated")


@query
def classify_changes(spark, d):
    return merge.classify_changes(
        table(spark, d, "customer"),
        incoming_customers(spark, d),
        ["c_custkey"],
        staging=Staging(spark, "changes"),
    )


def _upsert(spark, d, null_policy) -> DataFrame:
    return merge.upsert(
        table(spark, d, "customer"),
        incoming_customers(spark, d),
        ["c_custkey"],
        null_policy,
        staging=Staging(spark, "upsert"),
    )


@query
def upsert(spark, d):
    return _upsert(spark, d, "overwrite")


@query
def upsert_keep(spark, d):
    """A null in the source leaves the target value alone."""
    return _upsert(spark, d, "keep")


@query
def keyed_table_upsert(spark, d):
    """The same upsert into a bucketed table on storage."""
    customers = table(spark, d, "customer")
    path = Staging(spark, "target").folder("table")
    target = KeyedTable(spark, path, customers.schema, ["c_custkey"], buckets=8)
    target.upsert(customers)
    target.upsert(incoming_customers(spark, d))
    return target.read()


@query
def bucketed_table_upsert(spark, d):
    """The same upsert where many keys change: merged into Spark's own buckets."""
    customers = table(spark, d, "customer")
    path = Staging(spark, "target").folder("table")
    target = BucketedTable(spark, path, customers.schema, ["c_custkey"], buckets=8)
    target.upsert(customers, compact=True)
    target.upsert(incoming_customers(spark, d), compact=True)
    return target.read()


@query
def key_filter_rows(spark, d):
    """Lines of the orders that a delta holds: filtered by its keys first, then joined."""
    staging = Staging(spark, "key-filter")
    orders = table(spark, d, "orders").where(F.col("o_orderdate") > instant(MARK, T.TimestampNTZType()))
    keys = staging.write(orders.select(F.col("o_orderkey").alias("l_orderkey")), "keys")
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    some = key_filter.may_match(lines, ["l_orderkey"], key_filter.key_filter(keys, ["l_orderkey"], staging))
    return some.join(keys, "l_orderkey", "left_semi")


# -- numbering and batches --------------------------------------------------------


@query
def number_rows(spark, d):
    return numbering.number_rows(
        table(spark, d, "orders").select("o_orderkey", "o_orderdate"),
        ["o_orderdate", "o_orderkey"],
        unique=True,
    )


@query
def number_rows_tied(spark, d):
    """An order with ties: the numbers of a date are a gap-free range."""
    rows = table(spark, d, "lineitem").select("l_shipdate")
    numbered = numbering.number_rows(rows, ["l_shipdate"])
    return numbered.groupBy("l_shipdate").agg(
        F.min("row_num").alias("first_num"),
        F.max("row_num").alias("last_num"),
        F.count(F.lit(1)).alias("row_count"),
    )


@query
def assign_batches(spark, d):
    batches = numbering.assign_batches(
        table(spark, d, "orders").select("o_orderkey", "o_orderdate"),
        ["o_orderdate", "o_orderkey"],
        1000,
        unique=True,
    )
    return batches.groupBy("batch_num").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min("o_orderdate").alias("first_date"),
        F.max("o_orderdate").alias("last_date"),
    )


@query
def preview(spark, d):
    return numbering.preview(table(spark, d, "orders"), ["o_orderdate", "o_orderkey"])


@query
def export_batches(spark, d):
    """Documents out as CSV batches and back: every text arrives whole."""
    documents = table(spark, d, "documents").select("doc_id", "lang", "text")
    path = Staging(spark, "export").folder("csv")
    export.export_batches(documents, path, 100)
    back = spark.read.schema(documents.schema).options(
        **CSV_OPTIONS, multiLine="true", enforceSchema="false"
    )
    return back.csv(path)


# -- reconciliation ---------------------------------------------------------------


@query
def failures(spark, d):
    return reconcile.failures(delivery_results(spark, d)).select("o_orderkey", "success", "error")


@query
def failures_plain(spark, d):
    """Plain inequality: results without a verdict drop out."""
    results = reconcile.failures(delivery_results(spark, d), null_is_failure=False)
    return results.select("o_orderkey", "success", "error")


@query
def align_by_key(spark, d):
    return reconcile.align_by_key(
        reconcile.failures(delivery_results(spark, d)).select("o_orderkey", "error"),
        table(spark, d, "orders"),
        "o_orderkey",
        ["o_orderdate"],
    )


@query
def align_by_position(spark, d):
    """Results carry no key, only the sequence in which the orders were sent."""
    orders = table(spark, d, "orders")
    order = ["o_orderdate", "o_orderkey"]
    sent = orders.select("o_orderdate", "o_orderkey", "o_custkey")
    results = delivery_results(spark, d).join(
        orders.select("o_orderkey", "o_orderdate"), "o_orderkey"
    )
    aligned = reconcile.align_by_position(
        results.select("o_orderdate", "o_orderkey", "success", "error"),
        sent.withColumnsRenamed({"o_orderdate": "sent_date", "o_orderkey": "sent_key"}),
        ["sent_date", "sent_key"],
        order,
        ["sent_key", "o_custkey"],
    )
    return reconcile.failures(aligned).select("row_num", "sent_key", "o_custkey", "error")


@query
def failure_log(spark, d):
    return reconcile.failure_log(
        delivery_results(spark, d), table(spark, d, "orders"), "o_orderkey", "o_orderdate"
    )


@query
def failure_log_repeated_key(spark, d):
    """The key is the customer: sent and failed more than once."""
    return reconcile.failure_log(
        delivery_results(spark, d).withColumn("o_custkey", F.col("id").cast("bigint")),
        table(spark, d, "orders"),
        "o_custkey",
        "o_orderdate",
    )


@query
def failure_summary(spark, d):
    log = reconcile.failure_log(
        delivery_results(spark, d), table(spark, d, "orders"), "o_orderkey", "o_orderdate"
    )
    return reconcile.failure_summary(log)


@query
def results_ingest(spark, d):
    """Delivery results land as CSV and are read back with the fixed schema."""
    path = Staging(spark, "results").folder("csv")
    results = delivery_results(spark, d)
    results.select(*RESULT_SCHEMA.names, F.col("o_orderkey").cast("string")).write.options(
        **CSV_OPTIONS
    ).csv(path)
    return reconcile.failures(read_results(spark, path, extra=["o_orderkey"]))


# -- audit, batches, snapshots ----------------------------------------------------


@query
def audit_history(spark, d):
    """Three runs over the growing order table, each audited with its own delta."""
    rows = table(spark, d, "orders")
    history = None
    runs = [("1970-01-01", "2000-01-01"), ("2000-01-01", "2001-07-01"), ("2001-07-01", "2100-01-01")]
    for mark, until in runs:
        seen = rows.where(F.col("o_orderdate") <= instant(until, T.TimestampNTZType()))
        fresh = delta.delta_scan(seen, mark, "o_orderdate")
        stats = delta.next_watermark(
            delta.delta_stats(fresh, ["o_orderdate"]), mark, "o_orderdate", rule="created_only"
        ).first()
        row = audit.audit_row(
            spark,
            until,
            until,
            "success" if stats["row_count"] else "no_data",
            stats["row_count"],
            stats["next_watermark"],
            "orders",
        )
        history = row if history is None else history.unionByName(row)
    return history.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name)
            if isinstance(f.dataType, T.TimestampType)
            else F.col(f.name)
            for f in history.schema.fields
        ]
    )


def _registry(spark, d) -> DataFrame:
    """Every event is a registered batch of its type."""
    return table(spark, d, "events").select(
        F.col("event_type").alias("object_name"),
        F.col("ts").alias("created_on_date"),
        F.lit(1).alias("is_merged"),
        F.col("event_id").alias("batch_id"),
    )


@query
def register_batch(spark, d):
    row = audit.register_batch(_registry(spark, d), "click", "2024-03-01 12:00:00")
    return row.withColumn("created_on_date", F.col("created_on_date").cast("timestamp_ntz"))


@query
def register_batch_race(spark, d):
    """Two runs register at the same time: both read the registry before either has written."""
    registry = _registry(spark, d)
    claims = Staging(spark, "claims").folder("ids")
    rows = [
        audit.register_batch(
            registry, name, "2024-03-01 12:00:00", audit.claim_batch_id(registry, claims, name)
        )
        for name in ("click", "view")
    ]
    both = rows[0].unionByName(rows[1])
    return both.withColumn("created_on_date", F.col("created_on_date").cast("timestamp_ntz"))


@query
def load_times(spark, d):
    """Load time of a snapshot and times of an audit row: inside the run, and in order."""
    before = F.lit(datetime.now(timezone.utc).isoformat()).cast("timestamp")
    rows = audit.tag_snapshot(table(spark, d, "events").select("event_id"), 7)
    ref = _snapshot_ref(spark, "load-times")
    export.append_snapshot(rows, ref)
    row = audit.audit_row(spark, datetime.now(timezone.utc), None, "success", 1, MARK, "events")
    log = Staging(spark, "load-times").write(row, "audit")
    loaded = read_table(spark, ref).groupBy("batch_id").agg(
        F.count("time_stamp").alias("row_count"),
        F.count_distinct("time_stamp").alias("load_times"),
        F.min("time_stamp").alias("first"),
        F.max("time_stamp").alias("last"),
    )
    now = F.current_timestamp()
    ended = log.select(
        F.lit(7).cast("int").alias("batch_id"),
        (F.col("execution_end_time") >= F.col("execution_start_time")).alias("audit_in_order"),
        F.col("execution_end_time").alias("end"),
    )
    return loaded.join(F.broadcast(ended), "batch_id").select(
        F.col("batch_id").cast("bigint").alias("batch_id"),
        "row_count",
        "load_times",
        ((F.col("first") >= before) & (F.col("last") <= now)).alias("loaded_in_run"),
        "audit_in_order",
        ((F.col("end") >= F.col("last")) & (F.col("end") <= now)).alias("audited_after_load"),
    )


# -- what a watermark does not tell --------------------------------------------------


def _moved_customers(spark, d) -> DataFrame:
    """The source later: debtors are gone, building customers moved, each machinist has a twin."""
    key, segment = F.col("c_custkey"), F.col("c_mktsegment")
    rows = table(spark, d, "customer").where(F.col("c_acctbal") >= 0)
    twins = rows.where(segment == "MACHINERY").withColumn("c_custkey", -key)
    moved = F.when(segment == "BUILDING", F.lit("BUILT")).otherwise(segment)
    return rows.withColumn("c_mktsegment", moved).unionByName(twins)


_COMPARED = ["c_name", "c_nationkey", "c_mktsegment"]


@query
def vanished_keys(spark, d):
    """Keys that the target holds and the source does not, or differently, or the reverse."""
    return digest.table_differences(
        table(spark, d, "customer"), _moved_customers(spark, d), ["c_custkey"], _COMPARED
    )


@query
def reconcile_ranges(spark, d):
    """Ranges of orders that differ after a few were lost, and the rows of both sides in them."""
    orders = table(spark, d, "orders")
    staging = Staging(spark, "ranges")
    ranges, _ = digest.differing_ranges(
        orders,
        orders.where(F.col("o_orderkey") % 1009 != 7),
        ["o_orderkey"],
        ["o_custkey", "o_orderstatus"],
        staging,
        levels=(1, 2, 3),
    )
    return ranges


@query
def watermark_footer(spark, d):
    """Greatest id and number of events, by the footers of their files."""
    events = table(footer_session(spark), d, "events")
    return events.agg(
        F.max("event_id").alias("watermark"), F.count(F.lit(1)).alias("row_count")
    )


@query
def latest_batch(spark, d):
    return audit.latest_batch(_registry(spark, d), "click")


def _snapshot_ref(spark, label) -> TableRef:
    return TableRef(path=Staging(spark, label).folder("snapshot"))


@query
def append_snapshot(spark, d):
    """Two batches, the second delivered twice."""
    ref = _snapshot_ref(spark, "snapshot")
    rows = table(spark, d, "events").select("event_id", "user_id")
    export.append_snapshot(audit.tag_snapshot(rows, 1, "2024-03-01"), ref)
    second = audit.tag_snapshot(rows.where("user_id > 50"), 2, "2024-03-02")
    export.append_snapshot(second, ref)
    export.append_snapshot(second, ref)
    back = read_table(spark, ref)
    return back.select(
        "event_id",
        "user_id",
        F.col("time_stamp").cast("timestamp_ntz").alias("time_stamp"),
        F.col("batch_id").cast("bigint").alias("batch_id"),
    )


# -- sources and streams ----------------------------------------------------------


def _land(rows: DataFrame, path: str) -> None:
    """Write records as JSON lines; microseconds keep the time exact."""
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    rows.withColumn(MICROS, micros).drop("ts").write.mode("append").json(path)


_LANDED = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
        T.StructField(MICROS, T.LongType()),
    ]
)


def _unpack(rows: DataFrame) -> DataFrame:
    """Landed records with their time as a timestamp again."""
    ts = F.timestamp_micros(F.col(MICROS)).cast("timestamp_ntz")
    return rows.withColumn("ts", ts).drop(MICROS)


@query
def json_ingest(spark, d):
    path = Staging(spark, "landing").folder("json")
    _land(table(spark, d, "events"), path)
    return _unpack(read_json_object(spark, path, _LANDED))


def _in_two_parts(spark, d, path, run: Callable[[], None]) -> None:
    """Land the older events, run, land the newer ones, run twice."""
    rows = table(spark, d, "events")
    split = instant("2024-01-10", T.TimestampNTZType())
    _land(rows.where(F.col("ts") <= split), path)
    run()
    _land(rows.where(F.col("ts") > split), path)
    run()
    run()


@query
def stream_incremental(spark, d):
    """Latest event of every user, kept by a stream over the landing folder."""
    staging = Staging(spark, "stream")
    landing, checkpoint = staging.folder("landing"), staging.folder("checkpoint")
    schema = T.StructType.fromDDL(
        "event_id bigint, user_id bigint, event_type string, value double, props string,"
        " ts timestamp_ntz"
    )
    target = KeyedTable(spark, staging.folder("target"), schema, ["user_id"], buckets=8)

    def run():
        stream = read_landing(spark, landing, _LANDED)
        incremental.stream_incremental(
            stream, target, checkpoint, ["ts", "event_id"], transform=_unpack
        ).awaitTermination()

    _in_two_parts(spark, d, landing, run)
    return target.read()


@query
def json_ingest_variant(spark, d):
    """Three attributes are mapped; the others, props too, stay with their types."""
    path = Staging(spark, "landing").folder("json")
    _land(table(spark, d, "events"), path)
    schema = T.StructType([f for f in _LANDED.fields if f.name in ("event_id", "user_id", MICROS)])
    rows = read_json_variant(spark, path, schema)
    props = F.variant_get("unmapped", "$.props", "string")
    return _unpack(rows).select(
        "event_id",
        "user_id",
        "ts",
        F.variant_get("unmapped", "$.event_type", "string").alias("event_type"),
        F.variant_get("unmapped", "$.value", "double").alias("value"),
        props.alias("props"),
        F.variant_get(F.parse_json(props), "$.k", "bigint").alias("k"),
        F.concat_ws(
            ",", F.array_sort(F.map_keys(F.col("unmapped").cast("map<string,variant>")))
        ).alias("unmapped"),
        F.col("_corrupt_record").isNull().alias("parsed"),
    )


@query
def stream_deduplicated(spark, d):
    """Every record lands twice, the second time in a later file; the target sees it once."""
    staging = Staging(spark, "stream")
    landing, checkpoint = staging.folder("landing"), staging.folder("checkpoint")
    snapshot = TableRef(path=staging.folder("snapshot"))
    events = table(spark, d, "events")

    def run():
        stream = _unpack(read_landing(spark, landing, _LANDED)).withColumn(
            "at", F.col("ts").cast("timestamp")
        )
        once = incremental.drop_repeats(stream, ["event_id"], "at", "365 days")
        incremental.stream_snapshots(once.drop("at"), snapshot, checkpoint).awaitTermination()

    split = instant("2024-01-10", T.TimestampNTZType())
    for rows in (events.where(F.col("ts") <= split), events, events):
        _land(rows, landing)
        run()
    # Spark numbers a batch without rows too, when only the watermark has moved.
    return read_table(spark, snapshot).drop("time_stamp", "stream_id", "batch_id")


@query
def stream_snapshots(spark, d):
    """Every landed event once, tagged with its micro-batch."""
    staging = Staging(spark, "stream")
    landing, checkpoint = staging.folder("landing"), staging.folder("checkpoint")
    ref = TableRef(path=staging.folder("snapshot"))

    def run():
        stream = read_landing(spark, landing, _LANDED)
        incremental.stream_snapshots(
            stream, ref, checkpoint, transform=_unpack
        ).awaitTermination()

    _in_two_parts(spark, d, landing, run)
    rows = read_table(spark, ref).drop("time_stamp", "stream_id")
    return rows.withColumn("batch_id", F.col("batch_id").cast("bigint"))


# -- whole jobs -------------------------------------------------------------------


@query
def outbound_delta(spark, d):
    """Flagship: changed orders with their customer, masked and mapped for delivery."""
    rows = order_delta(spark, d).join(
        table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    end = F.when(F.col("c_acctbal") < 0, F.col("o_orderdate"))
    masked = reshape.mask_closed(rows.withColumn("end_date", end), "c_mktsegment", "end_date")
    maps = [
        ColumnMap("o_orderkey", "order_key", "varchar(100)"),
        ColumnMap("c_name", "full_name", "varchar(100)"),
        ColumnMap("c_mktsegment", "program", "varchar(100)"),
        ColumnMap("c_acctbal", "score", "decimal(12,2)"),
        ColumnMap("o_orderpriority", "priority"),
    ]
    return reshape.apply_mapping(masked, maps)


_SPLIT = "2000-01-01"
_PRICE_LIMIT = 400_000
_TARGET = T.StructType(
    [
        T.StructField("customer_key", T.StringType()),
        T.StructField("program", T.StringType()),
        T.StructField("price", T.DecimalType(12, 2)),
        T.StructField("last_order", T.LongType()),
    ]
)


def _outbound_runs(spark, d) -> OutboundConfig:
    """Three runs: older orders, newer orders, nothing new.

    The key is the customer, absent on urgent orders. Orders of status F are
    closed. The delivery refuses prices above a limit.
    """
    staging = Staging(spark, "outbound-job")
    orders = table(spark, d, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_custkey")).alias("o_custkey"),
        "o_orderpriority",
        "o_totalprice",
        F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate")).alias("end_date"),
        "o_orderdate",
    )

    def deliver(folder: str) -> DataFrame:
        sent = spark.read.schema(_TARGET).options(**CSV_OPTIONS, enforceSchema="false").csv(folder)
        fine = F.col("price") <= _PRICE_LIMIT
        return results_frame(
            sent,
            "last_order",
            F.when(fine, "true").otherwise("false"),
            F.when(~fine, "PRICE_LIMIT"),
            customer_key=F.col("customer_key"),
        )

    cfg = OutboundConfig(
        source=TableRef(path=staging.folder("source")),
        audit=TableRef(path=staging.folder("audit")),
        failure_log=TableRef(path=staging.folder("failure_log")),
        mapping=[
            ColumnMap("o_custkey", "customer_key", "varchar(100)"),
            ColumnMap("o_orderpriority", "program", "varchar(100)"),
            ColumnMap("o_totalprice", "price", "decimal(12,2)"),
            ColumnMap("o_orderkey", "last_order", "bigint"),
        ],
        key="o_custkey",
        created="o_orderdate",
        target=KeyedTable(spark, staging.folder("target"), _TARGET, ["customer_key"], buckets=8),
        export_path=staging.folder("batches"),
        deliver=deliver,
        mask={"o_orderpriority": "end_date"},
        batch_size=1000,
        object_name="orders",
    )
    newer = F.col("o_orderdate") > instant(_SPLIT, T.TimestampNTZType())
    orders.where(~newer).write.parquet(cfg.source.path)
    run_outbound(spark, cfg)
    orders.where(newer).write.mode("append").parquet(cfg.source.path)
    run_outbound(spark, cfg)
    run_outbound(spark, cfg)
    return cfg


def _one_outbound_run(
    spark, d, answer: Callable[[DataFrame], DataFrame], fails: bool = False, **settings
) -> OutboundConfig:
    """One run over all orders; ``answer`` makes the results from the rows as sent.

    The key is the customer, absent on urgent orders; the target holds the
    customers' prices.
    """
    staging = Staging(spark, "outbound-once")
    orders = table(spark, d, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_custkey")).alias("o_custkey"),
        "o_totalprice",
        "o_orderdate",
    )
    price = settings.pop("price", "decimal(12,2)")
    target = T.StructType.fromDDL(f"customer_key string, price {price}, last_order bigint")

    def deliver(folder: str) -> DataFrame:
        return answer(spark.read.options(**CSV_OPTIONS).csv(folder))

    cfg = OutboundConfig(
        source=TableRef(path=staging.folder("source")),
        audit=TableRef(path=staging.folder("audit")),
        failure_log=TableRef(
            path=staging.folder("failure_log"),
            schema=T.StructType.fromDDL(
                "o_custkey string, error_message string, created_on_date timestamp_ntz"
            ),
        ),
        mapping=[
            ColumnMap("o_custkey", "customer_key", "varchar(100)"),
            ColumnMap("o_totalprice", "price", price),
            ColumnMap("o_orderkey", "last_order", "bigint"),
        ],
        key="o_custkey",
        created="o_orderdate",
        target=KeyedTable(spark, staging.folder("target"), target, ["customer_key"], buckets=8),
        export_path=staging.folder("batches"),
        deliver=deliver,
        object_name="orders",
        **settings,
    )
    orders.write.parquet(cfg.source.path)
    try:
        run_outbound(spark, cfg)
    except ConnectionError:
        if not fails:
            raise
    return cfg


def _outcome(spark, cfg: OutboundConfig) -> DataFrame:
    """Rows of the target and of the failure log, and the audited counts, in one table."""
    target = cfg.target.read().select(
        F.lit("target").alias("part"),
        F.col("customer_key").alias("id"),
        F.lit(None).cast("string").alias("error_message"),
        F.lit(None).cast("timestamp_ntz").alias("dated"),
        F.col("last_order").alias("n"),
    )
    log = read_table(spark, cfg.failure_log).select(
        F.lit("log"), "o_custkey", "error_message", "created_on_date", F.lit(None).cast("bigint")
    )
    audit = _audit_rows(spark, cfg.audit).select(
        F.lit("audit"),
        F.col("record_count").cast("string"),
        F.lit(None).cast("string"),
        "watermark",
        F.col("failed_count").cast("bigint"),
    )
    return target.union(log).union(audit)


def _all_fine(sent: DataFrame, **columns) -> DataFrame:
    return results_frame(sent, "last_order", F.lit("true"), F.lit(None), **columns)


@query
def run_outbound_unanswered(spark, d):
    """The remote side reports only prices up to a limit."""

    def answer(sent: DataFrame) -> DataFrame:
        fine = F.col("price").cast("double") <= _PRICE_LIMIT
        return _all_fine(sent.where(fine), customer_key=F.col("customer_key"))

    return _outcome(spark, _one_outbound_run(spark, d, answer))


@query
def run_outbound_unmatched(spark, d):
    """Some results name a key that was not sent, or none."""

    def answer(sent: DataFrame) -> DataFrame:
        number = F.col("customer_key").cast("bigint")
        key = (
            F.when(number % 10 == 0, F.concat(F.lit("x"), F.col("customer_key")))
            .when(number % 10 != 1, F.col("customer_key"))
        )
        return _all_fine(sent, customer_key=key)

    return _outcome(spark, _one_outbound_run(spark, d, answer))


@query
def run_outbound_bad_values(spark, d):
    """Prices of 100,000 and more do not fit the mapped type."""

    def answer(sent: DataFrame) -> DataFrame:
        return _all_fine(sent, customer_key=F.col("customer_key"))

    return _outcome(spark, _one_outbound_run(spark, d, answer, price="decimal(7,2)"))


@query
def run_outbound_positional(spark, d):
    """Results without a key, in the order of the rows sent."""

    def answer(sent: DataFrame) -> DataFrame:
        fine = F.col("price").cast("double") <= _PRICE_LIMIT
        return results_frame(
            sent,
            "last_order",
            F.when(fine, "true").otherwise("false"),
            F.when(~fine, "PRICE_LIMIT"),
            place=F.col("seq").cast("bigint"),
        )

    return _outcome(
        spark,
        _one_outbound_run(
            spark, d, answer, match="position", result_order=["place"], sequence="seq"
        ),
    )


@query
def run_outbound_batch_positions(spark, d):
    """Results without a key: batch, and place in the batch."""

    def answer(sent: DataFrame) -> DataFrame:
        fine = F.col("price").cast("double") <= _PRICE_LIMIT
        return results_frame(
            sent,
            "last_order",
            F.when(fine, "true").otherwise("false"),
            F.when(~fine, "PRICE_LIMIT"),
            batch=F.col("batch"),
            seq=F.col("seq").cast("bigint"),
        )

    return _outcome(
        spark, _one_outbound_run(spark, d, answer, match="batch", sequence="seq", batch_size=1000)
    )


@query
def run_outbound_failed(spark, d):
    """The remote side breaks down once: the run is audited, holds its mark and is repeated."""
    calls: list[int] = []

    def answer(sent: DataFrame) -> DataFrame:
        calls.append(1)
        if len(calls) == 1:
            raise ConnectionError("remote side is down")
        return _all_fine(sent, customer_key=F.col("customer_key"))

    cfg = _one_outbound_run(spark, d, answer, fails=True)
    run_outbound(spark, cfg)
    return _audit_rows(spark, cfg.audit)


@query
def run_outbound_uncast(spark, d):
    """What is sent if values keep the types of the source."""
    sent: list[DataFrame] = []

    def answer(rows: DataFrame) -> DataFrame:
        sent.append(rows)
        return _all_fine(rows, customer_key=F.col("customer_key"))

    _one_outbound_run(spark, d, answer, cast=None)
    return sent[0].select("customer_key", F.col("price").cast("double"), F.col("last_order").cast("bigint"))


def _audit_rows(spark, ref: TableRef) -> DataFrame:
    """Audit rows without the times of the runs."""
    return read_table(spark, ref).select(
        "is_success",
        "record_count",
        F.col("watermark").cast("timestamp_ntz").alias("watermark"),
        "object_name",
        "failed_count",
    )


@query
def run_outbound_target(spark, d):
    return _outbound_runs(spark, d).target.read()


@query
def run_outbound_failures(spark, d):
    return read_table(spark, _outbound_runs(spark, d).failure_log)


@query
def run_outbound_audit(spark, d):
    return _audit_rows(spark, _outbound_runs(spark, d).audit)


def _inbound(spark, d, staging) -> tuple[InboundConfig, DataFrame, DataFrame]:
    """Settings, older records and newer records.

    A record was modified ``user_id`` hours after its creation; errors are
    inactive; clicks never logged in.
    """
    created = F.unix_millis(F.col("ts").cast("timestamp"))
    modified = created + F.col("user_id") * 3_600_000
    records = table(spark, d, "events").select(
        F.col("event_id").cast("string").alias("Id"),
        F.col("event_type").alias("Kind__c"),
        (F.col("event_type") != "error").alias("IsActive"),
        created.alias("CreatedDate"),
        modified.alias("LastModifiedDate"),
        F.when(F.col("event_type") != "click", created).alias("LastLoginDate"),
        "ts",
    )
    cfg = InboundConfig(
        landing=staging.folder("landing"),
        snapshot=TableRef(path=staging.folder("snapshot")),
        registry=TableRef(path=staging.folder("registry")),
        audit=TableRef(path=staging.folder("audit")),
        mapping=[
            ColumnMap("Id", "Id", "varchar(100)"),
            ColumnMap("Kind__c", "Kind", "varchar(100)"),
            ColumnMap("IsActive", "IsActive", "varchar(100)"),
            ColumnMap("LastLoginDate", "LastLoginDate", "bigint"),
            ColumnMap("LastModifiedDate", "LastModifiedDate", "bigint"),
            ColumnMap("CreatedDate", "CreatedDate", "bigint"),
        ],
        object_name="User",
        created="CreatedDate",
        updated="LastModifiedDate",
        epoch_columns=["LastModifiedDate", "CreatedDate", "LastLoginDate"],
        active="IsActive",
        read_types={"IsActive": "boolean"},
    )
    newer = F.col("ts") > instant("2024-01-10", T.TimestampNTZType())
    return cfg, records.where(~newer).drop("ts"), records.where(newer).drop("ts")


def _inbound_runs(spark, d) -> InboundConfig:
    """Three runs: older records, newer records, nothing new."""
    cfg, older, newer = _inbound(spark, d, Staging(spark, "inbound-job"))
    older.write.json(cfg.landing)
    run_inbound(spark, cfg)
    newer.write.mode("append").json(cfg.landing)
    run_inbound(spark, cfg)
    run_inbound(spark, cfg)
    return cfg


def _snapshot_rows(spark, cfg: InboundConfig) -> DataFrame:
    dates = {c: F.col(c).cast("timestamp_ntz") for c in cfg.epoch_columns}
    rows = read_table(spark, cfg.snapshot).drop("time_stamp").withColumns(dates)
    return rows.withColumn("batch_id", F.col("batch_id").cast("bigint"))


@query
def run_inbound_snapshot(spark, d):
    return _snapshot_rows(spark, _inbound_runs(spark, d))


@query
def stream_inbound(spark, d):
    """The inbound job as a stream over new landing files."""
    staging = Staging(spark, "inbound-stream")
    cfg, older, newer = _inbound(spark, d, staging)
    checkpoint = staging.folder("checkpoint")
    for rows in (older, newer):
        rows.write.mode("append").json(cfg.landing)
        incremental.stream_inbound(spark, cfg, checkpoint).awaitTermination()
    return _snapshot_rows(spark, cfg)


@query
def run_inbound_manifest(spark, d):
    """Polled runs that open new files only, and so take late records too."""
    cfg, older, newer = _inbound(spark, d, Staging(spark, "inbound-manifest"))
    cfg.manifest = cfg.landing + "-manifest"
    for rows in (older, newer):
        rows.write.mode("append").json(cfg.landing)
        run_inbound(spark, cfg)
    run_inbound(spark, cfg)
    return _snapshot_rows(spark, cfg)


@query
def run_inbound_unmapped(spark, d):
    """Attributes that the mapping does not name are kept beside the mapped ones."""
    cfg, older, newer = _inbound(spark, d, Staging(spark, "inbound-unmapped"))
    cfg.manifest, cfg.unmapped = cfg.landing + "-manifest", "others"
    cfg.mapping = [m for m in cfg.mapping if m.target != "Kind"]
    for rows in (older, newer):
        rows.write.mode("append").json(cfg.landing)
        run_inbound(spark, cfg)
    return _snapshot_rows(spark, cfg)


@query
def run_inbound_late(spark, d):
    """Polled runs that also take late records: those dated before the mark, but not yet held."""
    cfg, older, newer = _inbound(spark, d, Staging(spark, "inbound-late"))
    cfg.late_key = ["Id", "LastModifiedDate"]
    for rows in (older, newer):
        rows.write.mode("append").json(cfg.landing)
        run_inbound(spark, cfg)
    run_inbound(spark, cfg)
    return _snapshot_rows(spark, cfg)


@query
def run_inbound_legacy(spark, d):
    """The older rules: whole seconds, and a day's gap before modifications move the mark."""
    cfg, older, newer = _inbound(spark, d, Staging(spark, "inbound-legacy"))
    cfg.whole_seconds, cfg.rule = True, "day_gap"
    for rows in (older, newer):
        rows.write.mode("append").json(cfg.landing)
        run_inbound(spark, cfg)
    return _audit_rows(spark, cfg.audit)


@query
def run_inbound_rejects(spark, d):
    """Errors land as lines that are cut off, clicks with a text as date; each is rejected once."""
    cfg, older, newer = _inbound(spark, d, Staging(spark, "inbound-rejects"))
    cfg.rejects = TableRef(path=cfg.landing + "-rejects")
    for rows in (older, newer):
        line = F.to_json(F.struct(*[F.col(c) for c in rows.columns]))
        ident = F.col("Id")
        landed = (
            F.when(F.col("Kind__c") == "error", F.concat(F.lit('{"Id":"'), ident, F.lit('","Kin')))
            .when(
                F.col("Kind__c") == "click",
                F.concat(F.lit('{"Id":"'), ident, F.lit('","CreatedDate":"soon"}')),
            )
            .otherwise(line)
        )
        rows.select(landed.alias("value")).write.mode("append").text(cfg.landing)
        run_inbound(spark, cfg)
    run_inbound(spark, cfg)
    rejected = read_table(spark, cfg.rejects).select(F.lit("reject").alias("part"), "record")
    audit = read_table(spark, cfg.audit).select(
        F.lit("audit"),
        F.concat_ws("/", F.col("record_count").cast("string"), F.col("failed_count").cast("string")),
    )
    return rejected.union(audit)


@query
def run_inbound_audit(spark, d):
    return _audit_rows(spark, _inbound_runs(spark, d).audit)
