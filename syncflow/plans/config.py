"""Settings of the two sync jobs."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timedelta

from pyspark.sql import DataFrame

from syncflow.operators.audit import AuditColumns, BatchColumns
from syncflow.operators.delta import NEXT_RULES
from syncflow.operators.reshape import ColumnMap
from syncflow.sinks.export import BATCH_SIZE
from syncflow.sinks.keyed_table import KeyedTable
from syncflow.sources.tables import TableRef

#: Gets the folder of CSV batches, gives the delivery results.
Deliver = Callable[[str], DataFrame]


#: Lenient, raising on malformed values, or leaving the types of the source.
CASTS = ("try", "strict", None)


class _Settings:
    """Shared checks: a required setting may not be empty."""

    REQUIRED: tuple[str, ...] = ()

    def validate(self) -> None:
        empty = [name for name in self.REQUIRED if not getattr(self, name)]
        if empty:
            raise ValueError(f"settings must not be empty: {empty}")
        if self.rule not in NEXT_RULES:
            raise ValueError(f"rule must be one of {NEXT_RULES}, not {self.rule!r}")
        if self.on_failure not in ("hold", "advance"):
            raise ValueError(f"on_failure must be 'hold' or 'advance', not {self.on_failure!r}")
        if self.cast not in CASTS:
            raise ValueError(f"cast must be one of {CASTS}, not {self.cast!r}")


@dataclass
class OutboundConfig(_Settings):
    """Source rows -> keyed target and CSV batches, failures matched by key."""

    source: TableRef | None = None
    audit: TableRef | None = None
    failure_log: TableRef | None = None
    mapping: Sequence[ColumnMap] = ()
    key: str = ""  # source column; its mapped name is the key of the target
    created: str = ""
    updated: str | None = None
    target: KeyedTable | None = None
    export_path: str | None = None  # each run writes its own folder below
    deliver: Deliver | None = None
    mask: dict[str, str] = field(default_factory=dict)  # value column -> end-date column
    rule: str = "greatest"
    on_failure: str = "hold"
    strict: bool = True
    override: datetime | str | None = None
    null_policy: str = "overwrite"
    batch_size: int = BATCH_SIZE
    cast: str | None = "try"  # rows with a value that does not fit are set aside
    reject_overlong: bool = False  # set texts aside that are longer than mapped
    match: str = "key"  # how results find their rows: by "key", "position" or "batch"
    result_order: Sequence[str] = ()  # total order of the results, for "position"
    sequence: str | None = None  # exported row number: of all ("position"), in its batch ("batch")
    batch: str = "batch"  # for "batch": the column, and folder, of the exported batch number
    object_name: str | None = None
    audit_columns: AuditColumns = AuditColumns()

    REQUIRED = ("source", "audit", "failure_log", "mapping", "key", "created")

    def validate(self) -> None:
        super().validate()
        if self.target is None and self.export_path is None:
            raise ValueError("settings must name a target or an export_path")
        if self.deliver is not None and self.export_path is None:
            raise ValueError("deliver needs an export_path")
        if self.match not in ("key", "position", "batch"):
            raise ValueError(f"match must be 'key', 'position' or 'batch', not {self.match!r}")
        if self.match == "batch" and self.sequence is None:
            raise ValueError("matching by batch needs a sequence, the row's number in its batch")
        if self.match == "position" and self.deliver is not None and not self.result_order:
            raise ValueError("matching by position needs a result_order")
        if self.key.lower() not in [m.source.lower() for m in self.mapping]:
            raise ValueError(f"the mapping has no line for the key {self.key!r}")

    @property
    def target_key(self) -> str:
        return next(m.target for m in self.mapping if m.source.lower() == self.key.lower())


@dataclass
class InboundConfig(_Settings):
    """Landed JSON records -> batch-tagged snapshot."""

    landing: str = ""
    snapshot: TableRef | None = None
    registry: TableRef | None = None
    audit: TableRef | None = None
    mapping: Sequence[ColumnMap] = ()
    object_name: str = ""
    created: str = ""  # target names, epoch milliseconds in the records
    updated: str = ""
    epoch_columns: Sequence[str] = ()
    active: str | None = None  # target name of the flag; None takes all rows
    read_types: dict[str, str] = field(default_factory=dict)
    multi_line: bool = False
    cast: str | None = "try"
    late_key: Sequence[str] = ()  # target names that tell record versions apart
    rejects: TableRef | None = None  # takes records that do not parse; without it they raise
    manifest: str | None = None  # folder that remembers taken files; only new ones are opened
    manifest_lag: timedelta | None = None  # how late after its time a file may show up
    claims: str | None = None  # folder of claimed batch ids, if several runs share a registry
    unmapped: str | None = None  # column for the attributes that the mapping does not name
    rule: str = "greatest"
    on_failure: str = "hold"
    strict: bool = True
    override: datetime | str | None = None
    whole_seconds: bool = False  # cut dates to the second before anything is compared
    datetime_as_string: bool = False
    zone: str = "UTC"
    audit_columns: AuditColumns = AuditColumns()
    batch_columns: BatchColumns = BatchColumns()

    def validate(self) -> None:
        super().validate()
        if self.late_key and self.datetime_as_string:
            raise ValueError("late_key needs dates as timestamps, not as text")
        if self.late_key and self.manifest:
            raise ValueError("a manifest takes late records without a late_key")

    REQUIRED = (
        "landing", "snapshot", "registry", "audit", "mapping", "object_name", "created", "updated",
    )

