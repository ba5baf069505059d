"""The two standard jobs, ready but for the places of their tables."""

from __future__ import annotations

from dataclasses import replace

from syncflow.operators.audit import AuditColumns, BatchColumns
from syncflow.plans.config import InboundConfig, OutboundConfig
from syncflow.plans.standard_mappings import ACCOUNT_MAPPING, USER_MAPPING, parse_mapping
from syncflow.sources.tables import TableRef

# Column names of the tables around the standard jobs.
ACCOUNT_AUDIT = AuditColumns(
    count="Patients_Processed_Count",
    mark="created_on_date",
    object_name=None,
)
USER_AUDIT = AuditColumns(count="Record_Count", mark="latest_created_or_updated_date")
USER_BATCHES = BatchColumns("ObjectName", "Created_On_Date", "Is_Merged_To_DW", "batch_id")


def account_sync(
    source: TableRef,
    audit: TableRef,
    failure_log: TableRef,
    legacy: bool = False,
    **options,
) -> OutboundConfig:
    """Accounts outbound. Name a ``target``, an ``export_path``, or both.

    ``legacy`` follows creation dates only and moves the watermark on even if a
    run fails, so the rows of that run are skipped. Values keep their types, and
    the audit has no count of failures.
    """
    if legacy:
        options = {
            "rule": "created_only",
            "on_failure": "advance",
            "cast": None,
            "audit_columns": replace(ACCOUNT_AUDIT, failed_count=None),
            **options,
        }
    return OutboundConfig(
        **{
            "source": source,
            "audit": audit,
            "failure_log": failure_log,
            "mapping": parse_mapping(ACCOUNT_MAPPING),
            "key": "patient_bk",
            "created": "created_on_date",
            "updated": "updated_on_date",
            "mask": {"VBC_Program_Name": "ENROLLMENT_end_date"},
            "audit_columns": ACCOUNT_AUDIT,
            **options,
        }
    )


def user_sync(
    landing: str,
    snapshot: TableRef,
    registry: TableRef,
    audit: TableRef,
    legacy: bool = False,
    **options,
) -> InboundConfig:
    """Users inbound.

    ``legacy`` filters and takes the newest dates on whole seconds, writes dates as
    text in the ``zone`` given, and moves the watermark past a modification only
    after a whole day. The audit has no count of failures.
    """
    if legacy:
        options = {
            "rule": "day_gap",
            "whole_seconds": True,
            "datetime_as_string": True,
            "audit_columns": replace(USER_AUDIT, failed_count=None),
            **options,
        }
    return InboundConfig(
        **{
            "landing": landing,
            "snapshot": snapshot,
            "registry": registry,
            "audit": audit,
            "mapping": parse_mapping(USER_MAPPING),
            "object_name": "User",
            "created": "CreatedDate",
            "updated": "LastModifiedDate",
            "epoch_columns": ["LastModifiedDate", "CreatedDate", "LastLoginDate"],
            "active": "IsActive",
            "read_types": {"IsActive": "boolean"},
            "audit_columns": USER_AUDIT,
            "batch_columns": USER_BATCHES,
            **options,
        }
    )
