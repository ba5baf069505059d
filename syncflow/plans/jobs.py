"""The two sync jobs, end to end.

Both follow one protocol: read the watermark, stage the rows above it, reshape
and deliver them, append an audit row with the next watermark. Rows move only
between executors and storage. The driver sees the watermark and counts.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from syncflow.functions.columns import column_name, datetime_text, is_true, quoted
from syncflow.operators.audit import (
    audit_row,
    claim_batch_id,
    next_batch_id,
    register_batch,
    tag_snapshot,
)
from syncflow.operators.delta import (
    delta_scan,
    newer_than,
    next_watermark,
    observed_stats,
    stats_row,
    watermark,
)
from syncflow.operators.merge import dedup_latest, keyed_rows, orderable, unkeyed_rows
from syncflow.operators.numbering import batch_rows, number_rows
from syncflow.operators.reconcile import delivery_verdicts, failed_results, positioned
from syncflow.operators.reshape import (
    apply_mapping,
    epoch_millis_to_datetime,
    mask_closed,
    unfit_values,
)
from syncflow.plans.config import InboundConfig, OutboundConfig
from syncflow.session import footer_session
from syncflow.sinks.export import append_snapshot, export_batches
from syncflow.sources import files
from syncflow.sources.manifest import LandingManifest
from syncflow.sources.records import object_schema, read_json_object, read_json_variant
from syncflow.sources.tables import TableRef, append_table, newest_value, read_table
from syncflow.staging import Staging, sized_shuffles

#: Failure text of rows that cannot be delivered because their key is null.
NO_KEY = "key is null"
#: Failure text of rows whose values a cast would clear; the columns follow.
UNFIT = "values do not fit: "
#: Failure texts of sent rows without a result, and of results without a sent row.
NO_RESULT = "no result"
NO_ROW = "result without a sent row"

_CHANGED, _CREATED, _KEY, _UNFIT, _ROW, _MAPPED_KEY = (
    "_changed", "_created", "_source_key", "_unfit", "_row_num", "_mapped_key",
)

#: Column for the text of records that do not parse, and of those not taken.
CORRUPT, REJECT = "_corrupt_record", "_reject"
REJECT_SCHEMA = T.StructType(
    [T.StructField("object_name", T.StringType()), T.StructField("record", T.StringType())]
)


@dataclass(frozen=True)
class RunResult:
    """What one run did; the same values as in its audit row."""

    status: str
    count: int
    watermark: datetime
    failed_count: int = 0
    batch_id: int | None = None


def _utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


class _Audit:
    """Reads the watermark of one object and appends its audit rows."""

    def __init__(self, spark: SparkSession, cfg: OutboundConfig | InboundConfig):
        self.spark, self.cfg, self.start = spark, cfg, _utc_now()
        self.columns = cfg.audit_columns
        self.mark = None

    def watermark(self) -> datetime:
        ref = self.cfg.audit
        if ref.path and ref.schema is None:
            ref = TableRef(ref.format, ref.path, ref.options, self.columns.schema())
        by_object = self.cfg.object_name is not None and self.columns.object_name is not None
        hold = self.cfg.on_failure == "hold"
        conditions = [(self.columns.object_name, "=", self.cfg.object_name)] if by_object else []
        conditions += [(self.columns.status, "<>", 0)] if hold else []
        # A database is asked for the one value; then there is nothing left to filter.
        asked = newest_value(ref, self.columns.mark, conditions)
        reduced = asked is not ref
        self.mark = watermark(
            read_table(self.spark, asked),
            self.columns.mark,
            override=self.cfg.override,
            object_name=self.cfg.object_name if by_object and not reduced else None,
            object_col=self.columns.object_name,
            success_only=hold and not reduced,
            status_col=self.columns.status,
        )
        return self.mark

    def append(self, result: RunResult) -> RunResult:
        append_table(
            audit_row(
                self.spark,
                self.start,
                None,
                result.status,
                result.count,
                result.watermark,
                self.cfg.object_name,
                result.failed_count,
                self.columns,
            ),
            self.cfg.audit,
        )
        return result

    def failed(self, reached: datetime | None) -> None:
        """Audit a failed run. It holds the old mark unless told to advance."""
        mark = reached if self.cfg.on_failure == "advance" and reached else self.mark
        if mark is not None:
            self.append(RunResult("failure", 0, mark))


def _stage_delta(
    staging: Staging, rows: DataFrame, cfg, mark: datetime, taken: Column | None = None
) -> tuple[DataFrame, int, datetime]:
    """The written delta, its count and next watermark, both taken while it is written.

    Rows for which ``taken`` is false are written, but neither counted nor dated.
    """
    dates = [cfg.created] + ([cfg.updated] if cfg.updated else [])
    delta, seen = staging.write_observed(rows, observed_stats(rows, dates, taken), "delta")
    stats = next_watermark(
        stats_row(delta, dates, seen), mark, cfg.created, cfg.updated, cfg.rule
    )
    following = F.col("next_watermark")
    if dict(stats.dtypes)["next_watermark"] == "timestamp":
        following = F.convert_timezone(None, F.lit("UTC"), following)
    return delta, seen["row_count"], stats.select(following.cast("timestamp_ntz")).first()[0]


def run_outbound(spark: SparkSession, cfg: OutboundConfig) -> RunResult:
    """Deliver the source rows created or updated since the last run."""
    cfg.validate()
    audit, reached = _Audit(spark, cfg), None
    try:
        mark = audit.watermark()
        with Staging(spark, "outbound") as staging:
            rows = delta_scan(
                read_table(spark, cfg.source), mark, cfg.created, cfg.updated, cfg.strict
            )
            # The source may move on: count, delivery and failure matching all
            # use this one copy, which holds only the columns they need.
            delta, count, reached = _stage_delta(
                staging, rows.select(*_needed_columns(rows, cfg)), cfg, mark
            )
            if count == 0:
                return audit.append(RunResult("no_data", 0, mark))
            with sized_shuffles(spark, staging.size()):
                failed = _deliver(spark, cfg, delta, staging)
        return audit.append(RunResult("success", count, reached, failed))
    except Exception:
        audit.failed(reached)
        raise


def _needed_columns(rows: DataFrame, cfg: OutboundConfig) -> list[Column]:
    wanted = {m.source.lower() for m in cfg.mapping} | {cfg.created.lower()}
    wanted |= {c.lower() for pair in cfg.mask.items() for c in pair}
    wanted |= {cfg.updated.lower()} if cfg.updated else set()
    return [quoted(c) for c in rows.columns if c.lower() in wanted]


def masked_rows(delta: DataFrame, cfg: OutboundConfig) -> DataFrame:
    """Masked rows, not cast yet, with the key they will have and when they changed."""
    for value, end in cfg.mask.items():
        delta = mask_closed(delta, value, end)
    changed = quoted(cfg.created)
    if cfg.updated:
        changed = F.greatest(changed, quoted(cfg.updated))
    key = next(m for m in cfg.mapping if m.source.lower() == cfg.key.lower())
    own = {c: quoted(c) for c in delta.columns}
    return apply_mapping(
        delta,
        [replace(key, target=_MAPPED_KEY)],
        cast=cfg.cast,
        keep={**own, _CHANGED: changed},
    )


def latest_rows(masked: DataFrame, cfg: OutboundConfig) -> DataFrame:
    """The newest row of each key; ties go by the mapped columns as the source has them.

    Rows are chosen before values are cast. A value that does not fit is null once it is
    cast, so its row would lose every tie and never be reported.
    """
    sources = [column_name(masked, m.source) for m in cfg.mapping]
    order = [c for c in sources if orderable(masked.schema[c].dataType)]
    order = list(dict.fromkeys([_CHANGED, column_name(masked, cfg.created), *order]))
    return dedup_latest(keyed_rows(masked, [_MAPPED_KEY]), [_MAPPED_KEY], order)


def outgoing_rows(rows: DataFrame, cfg: OutboundConfig) -> DataFrame:
    """Mapped rows, plus what is needed to order them and report failures."""
    typed = [m if cfg.cast == "try" else replace(m, dtype=None) for m in cfg.mapping]
    if cfg.reject_overlong:
        typed = [t if m.max_length is None else m for t, m in zip(typed, cfg.mapping)]
    return apply_mapping(
        rows,
        cfg.mapping,
        cast=cfg.cast,
        keep={
            _CREATED: quoted(cfg.created),
            _KEY: quoted(cfg.key).cast("string"),
            _UNFIT: unfit_values(rows, typed, cfg.reject_overlong),
        },
    )


def _place(cfg: OutboundConfig) -> Column:
    """A row's batch and its place in it, as one text."""
    return F.concat_ws(":", quoted(cfg.batch).cast("string"), quoted(cfg.sequence).cast("string"))


def _deliver(
    spark: SparkSession, cfg: OutboundConfig, delta: DataFrame, staging: Staging
) -> int:
    """Deliver the staged delta, log what was not confirmed, return how many rows that is.

    Rows without a key and rows with a value that does not fit its type are not
    sent. If the remote side reports results, only rows it confirms reach the
    target; failed and unanswered rows are logged, and so are results that
    belong to no sent row.
    """
    masked = masked_rows(delta, cfg)
    # A target sees each key once, with its latest row.
    latest, small = staging.write_checked(outgoing_rows(latest_rows(masked, cfg), cfg), "latest")

    def logged(rows: DataFrame, key: Column, error: Column) -> DataFrame:
        return rows.select(
            key.cast("string").alias(cfg.key),
            error.alias("error_message"),
            F.col(_CREATED).alias("created_on_date"),
        )

    no_key = unkeyed_rows(masked, [_MAPPED_KEY]).select(
        quoted(cfg.key).cast("string").alias(_KEY), quoted(cfg.created).alias(_CREATED)
    )
    unfit = latest.where(F.col(_UNFIT).isNotNull())
    log = logged(no_key, F.col(_KEY), F.lit(NO_KEY)).unionByName(
        logged(unfit, F.col(_KEY), F.concat(F.lit(UNFIT), F.col(_UNFIT)))
    )
    sendable = latest.where(F.col(_UNFIT).isNull()).drop(_UNFIT)
    outgoing = sendable.drop(_CREATED, _KEY)
    accepted = outgoing
    if cfg.export_path is not None:
        folder = f"{cfg.export_path.rstrip('/')}/{staging.path.rsplit('-', 1)[-1]}"
        by_key = cfg.match == "key"
        if cfg.match == "position":
            sendable = number_rows(sendable, [cfg.target_key], staging, unique=True, name=_ROW)
            exported = sendable.drop(_CREATED, _KEY)
            if cfg.sequence is None:
                exported = exported.drop(_ROW)
            else:
                exported = exported.withColumnRenamed(_ROW, cfg.sequence)
            export_batches(exported, folder, cfg.batch_size)
        elif cfg.match == "batch":
            sendable = batch_rows(sendable, cfg.batch_size, staging, cfg.batch, cfg.sequence)
            export_batches(sendable.drop(_CREATED, _KEY), folder, cfg.batch_size, cfg.batch)
            sendable = sendable.withColumn(_ROW, _place(cfg)).drop(cfg.batch, cfg.sequence)
        else:
            export_batches(outgoing, folder, cfg.batch_size)
        if cfg.deliver is not None:
            # The results are asked for once.
            results = staging.write(cfg.deliver(folder), "results")
            if cfg.match == "position":
                results = positioned(results, cfg.result_order, sendable.count(), staging, _ROW)
            elif cfg.match == "batch":
                results = results.withColumn(_ROW, _place(cfg))
            answer_key = cfg.target_key if by_key else _ROW
            verdicts, small = staging.write_checked(
                delivery_verdicts(results, sendable, answer_key), "verdicts"
            )
            said = F.col("verdict")
            error = (
                F.when(said == "unanswered", F.lit(NO_RESULT))
                .when(said == "unmatched", F.concat_ws(": ", F.lit(NO_ROW), F.col("error")))
                .otherwise(F.col("error"))
            )
            # Every failed result is logged, also several of one row.
            refused = verdicts.where(~said.isin("delivered", "failed")).unionByName(
                failed_results(results, verdicts, answer_key, staging=staging)
            )
            key = F.when(said == "unmatched", F.col("result_key")).otherwise(F.col(_KEY))
            log = log.unionByName(logged(refused, key, error))
            accepted = verdicts.where(said == "delivered").select(
                *[quoted(c) for c in outgoing.columns]
            )
    log, seen = staging.write_observed(log, {"rows": F.count(F.lit(1))}, "failures")
    failed_count = seen["rows"]
    if cfg.target is not None:
        cfg.target.upsert(accepted, null_policy=cfg.null_policy, unique=True, small=small)
    if failed_count:
        append_table(log, cfg.failure_log)
    return failed_count


def run_inbound(spark: SparkSession, cfg: InboundConfig) -> RunResult:
    """Append the landed records created or modified since the last run.

    With ``cfg.manifest`` only files that no run has taken are opened, and every active
    record in them is new, late ones too.
    """
    cfg.validate()
    if cfg.manifest is None:
        return sync_records(spark, cfg, read_landed(spark, cfg, cfg.landing))
    manifest = LandingManifest(spark, cfg.manifest, cfg.manifest_lag)
    run = manifest.plan(
        cfg.landing,
        lambda: next_batch_id(read_registry(spark, cfg), cfg.batch_columns).first()[0]
        if cfg.claims is None
        else claim_batch_id(
            read_registry(spark, cfg), cfg.claims, cfg.object_name, cfg.batch_columns
        ),
    )
    paths = manifest.paths(run)
    result = sync_records(
        spark, cfg, read_landed(spark, cfg, paths), late=True, batch_id=run.batch_id
    )
    manifest.commit(run)
    return result


def read_landed(spark: SparkSession, cfg: InboundConfig, paths: str | list[str]) -> DataFrame:
    """Landed records of a folder or of files, and the text of those that do not parse.

    Attributes that the mapping does not name are left out, or kept in ``cfg.unmapped``.
    """
    schema = landed_schema(cfg)
    if not paths:
        return spark.createDataFrame([], schema)
    if cfg.unmapped is None:
        return read_json_object(spark, paths, schema, cfg.multi_line)
    return read_json_variant(
        spark, paths, schema, multi_line=cfg.multi_line, rest=cfg.unmapped, corrupt=CORRUPT
    ).withColumn(cfg.unmapped, F.to_json(quoted(cfg.unmapped)))


def landed_schema(cfg: InboundConfig) -> T.StructType:
    return T.StructType(
        [
            *object_schema(cfg.mapping, cfg.read_types).fields,
            *([T.StructField(cfg.unmapped, T.StringType())] if cfg.unmapped else []),
            T.StructField(CORRUPT, T.StringType()),
        ]
    )


def sync_records(
    spark: SparkSession,
    cfg: InboundConfig,
    records: DataFrame,
    late: bool = False,
    batch_id: int | None = None,
) -> RunResult:
    """One inbound run over records at hand: a landing folder or a micro-batch.

    ``late`` also takes records dated before the watermark, for callers that
    know every record is new to them. ``batch_id`` repeats a run under the id
    it was given before. Records that do not parse, or have no date, go to
    ``cfg.rejects`` and are counted, each text once; without such a table they
    fail the run.
    """
    audit, reached = _Audit(spark, cfg), None
    try:
        mark = audit.watermark()
        with Staging(spark, "inbound") as staging:
            polled_late = bool(cfg.late_key) and not late
            taken = inbound_delta(records, cfg, None if late or polled_late else mark)
            if polled_late:
                taken = _not_taken_before(spark, cfg, taken, mark)
            fine = F.col(REJECT).isNull()
            staged, count, reached = _stage_delta(staging, taken, cfg, mark, fine)
            delta = staged.where(fine).drop(REJECT)
            rejected = _reject(spark, cfg, staged.where(~fine), staging)
            if count == 0:
                return audit.append(RunResult("no_data", 0, mark, rejected))
            batch_id = _append_batch(spark, cfg, delta, batch_id)
        return audit.append(RunResult("success", count, reached, rejected, batch_id))
    except Exception:
        audit.failed(reached)
        raise


def inbound_delta(records: DataFrame, cfg: InboundConfig, mark: datetime | None) -> DataFrame:
    """Typed, renamed, active records above the mark; dates are timestamps, moved to the end.

    Records that cannot be taken have their text in the column ``REJECT``.
    """
    text = F.lit(None).cast("string")
    if CORRUPT in records.columns:
        text = F.col(CORRUPT)
    keep = {REJECT: text}
    if cfg.unmapped is not None:
        keep[cfg.unmapped] = quoted(cfg.unmapped)
    shaped = epoch_millis_to_datetime(
        apply_mapping(records, cfg.mapping, cast=cfg.cast, keep=keep),
        cfg.epoch_columns,
        move_last=True,
    )
    if cfg.whole_seconds:
        dates = [c for c in shaped.columns if c.lower() in _lower(cfg.epoch_columns)]
        shaped = shaped.withColumns({c: F.date_trunc("SECOND", quoted(c)) for c in dates})
    taken = F.lit(True)
    if cfg.active is not None:
        taken = is_true(quoted(cfg.active))
    # An empty record says nothing; one without a date cannot be placed.
    values = [quoted(c) for c in shaped.columns if c != REJECT]
    undated = quoted(cfg.created).isNull() & quoted(cfg.updated).isNull()
    said = F.coalesce(*[v.cast("string") for v in values]).isNotNull()
    reject = F.coalesce(F.col(REJECT), F.when(taken & undated & said, F.to_json(F.struct(*values))))
    shaped = shaped.withColumn(REJECT, reject)
    if mark is not None:
        dates = [cfg.created, cfg.updated]
        taken = taken & F.coalesce(newer_than(shaped, mark, dates, cfg.strict), F.lit(False))
    return shaped.where(taken | F.col(REJECT).isNotNull())


def _not_taken_before(
    spark: SparkSession, cfg: InboundConfig, rows: DataFrame, mark: datetime
) -> DataFrame:
    """Rows above the mark, and older ones that no batch of the snapshot holds.

    Only the snapshot's key columns are read; rows above the mark are not joined.
    """
    newer = F.coalesce(
        newer_than(rows, mark, [cfg.created, cfg.updated], cfg.strict), F.lit(False)
    ) | F.col(REJECT).isNotNull()
    older = rows.where(~newer)
    if cfg.snapshot.path is None or files.exists(spark, cfg.snapshot.path):
        held = read_table(spark, cfg.snapshot).select(
            *[quoted(c).alias(f"_held_{i}") for i, c in enumerate(cfg.late_key)]
        )
        same = F.lit(True)
        for i, c in enumerate(cfg.late_key):
            same = same & quoted(c).eqNullSafe(F.col(f"_held_{i}"))
        older = older.join(held, same, "left_anti")
    return rows.where(newer).unionByName(older)


def _reject(
    spark: SparkSession, cfg: InboundConfig, rows: DataFrame, staging: Staging
) -> int:
    """Append rejected records that are new to the reject table; how many those are."""
    if rows.isEmpty():
        return 0
    if cfg.rejects is None:
        raise ValueError(f"a landed record cannot be taken: {rows.first()[REJECT][:200]!r}")
    ref = cfg.rejects
    if ref.path and ref.schema is None:
        ref = TableRef(ref.format, ref.path, ref.options, REJECT_SCHEMA)
    known = read_table(spark, ref).where(F.col("object_name") == cfg.object_name).select("record")
    fresh, seen = staging.write_observed(
        rows.select(F.col(REJECT).alias("record")).distinct().join(known, "record", "left_anti"),
        {"rows": F.count(F.lit(1))},
        "rejects",
    )
    count = seen["rows"]
    if count:
        append_table(
            fresh.select(F.lit(cfg.object_name).alias("object_name"), "record"), ref
        )
    return count


def read_registry(spark: SparkSession, cfg: InboundConfig) -> DataFrame:
    """The batch registry, empty before the first batch."""
    return read_table(spark, _registry_ref(cfg))


def _registry_ref(cfg: InboundConfig) -> TableRef:
    ref = cfg.registry
    if ref.path and ref.schema is None:
        return TableRef(ref.format, ref.path, ref.options, cfg.batch_columns.schema())
    return ref


def _append_batch(
    spark: SparkSession, cfg: InboundConfig, delta: DataFrame, batch_id: int | None
) -> int:
    """Write the snapshot batch, then register it.

    A batch is registered once it is complete. A crash in between leaves the id
    free, so the next run replaces the same snapshot partition.
    """
    registry, names, now = read_registry(spark, cfg), cfg.batch_columns, _utc_now()
    known = False
    if batch_id is None:
        # Ids are the registry's greatest plus one: footers know it, so no rows are read.
        newest = read_table(footer_session(spark), newest_value(_registry_ref(cfg), names.batch))
        if cfg.claims is None:
            batch_id = next_batch_id(newest, names).first()[0]
        else:
            batch_id = claim_batch_id(newest, cfg.claims, cfg.object_name, names)
    else:
        same = (quoted(names.batch) == batch_id) & (quoted(names.object_name) == cfg.object_name)
        known = not registry.where(same).isEmpty()

    dates = [quoted(c) for c in delta.columns if c.lower() in _lower(cfg.epoch_columns)]
    others = [quoted(c) for c in delta.columns if c.lower() not in _lower(cfg.epoch_columns)]
    tagged = tag_snapshot(delta, batch_id, now)
    if cfg.datetime_as_string:
        tagged = tagged.withColumns(
            {c: datetime_text(quoted(c), cfg.zone) for c in delta.select(*dates).columns}
        )
    append_snapshot(tagged.select(*others, "time_stamp", *dates, "batch_id"), cfg.snapshot)
    if not known:
        row = register_batch(registry, cfg.object_name, now, batch_id, names)
        append_table(row, _registry_ref(cfg))
    return batch_id


def _lower(names: Sequence[str]) -> set[str]:
    return {name.lower() for name in names}
