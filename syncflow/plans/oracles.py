"""The same queries in plain SQL, to compare with."""

from __future__ import annotations

_SOURCE = """
    select o.*, s.updated
    from orders o
    left join (select l_orderkey, max(l_shipdate) as updated from lineitem group by 1) s
      on o.o_orderkey = s.l_orderkey
"""

_DELTA = f"""
    select * from ({_SOURCE})
    where o_orderdate > timestamp '2001-06-01' or updated > timestamp '2001-06-01'
"""

_STATS = f"""
    select count(*) as row_count, max(o_orderdate) as c, max(updated) as m from ({_DELTA})
"""

_RESULTS = """
    select cast(o_custkey as varchar) as id, o_orderkey, o_custkey, o_orderdate,
           case when o_orderpriority = '5-LOW' then 'false'
                when o_orderpriority <> '4-NOT SPECIFIED' then 'true' end as success,
           case when o_orderpriority = '5-LOW' then 'REJECTED:' || o_orderstatus end as error
    from orders
"""

_FAILED = f"select * from ({_RESULTS}) where success is distinct from 'true'"

_KNOWN = f"""
    select o_custkey as c_custkey,
           case when o_orderpriority <> '5-LOW' then o_orderpriority end as c_mktsegment
    from (select *, row_number() over (
              partition by o_custkey order by o_orderdate desc, o_orderkey desc) as rn
          from ({_DELTA}))
    where rn = 1
"""

_INCOMING = f"""
    select * from ({_KNOWN})
    union all
    select -1 - c_custkey, c_mktsegment from ({_KNOWN})
"""


def _upsert(segment: str) -> str:
    return f"""
    with s as ({_INCOMING})
    select c.c_custkey, c.c_name, c.c_nationkey, c.c_acctbal, {segment} as c_mktsegment
    from customer c left join s on s.c_custkey = c.c_custkey
    union all
    select s.c_custkey, null, null, null, s.c_mktsegment
    from s where s.c_custkey not in (select c_custkey from customer)
    """


_OVERWRITE = _upsert("case when s.c_custkey is not null then s.c_mktsegment else c.c_mktsegment end")
_KEEP = _upsert("coalesce(s.c_mktsegment, c.c_mktsegment)")

_TEXT = """
    select cast(event_id as varchar) as event_id,
           case when event_type <> 'error' then cast(user_id as varchar) end as user_id,
           case when event_type = 'error' then 'None' else props end as props
    from events
"""

_MILLIS = "select event_id, epoch_us(ts) // 1000 as modified, event_type from events"

_NUMBERED = """
    select o_orderkey, o_orderdate,
           row_number() over (order by o_orderdate, o_orderkey) as row_num
    from orders
"""

_SENT = """
    select *, row_number() over (
        partition by o_custkey, run
        order by o_orderdate desc, program desc, o_totalprice desc, o_orderkey desc) as rn
    from (select *,
                 case when o_orderdate > timestamp '2000-01-01' then 2 else 1 end as run,
                 case when o_orderstatus = 'F' then 'NA' else o_orderpriority end as program
          from orders where o_orderpriority <> '1-URGENT')
"""

_OUTBOUND_FAILURES = f"""
    select cast(null as varchar) as o_custkey, 'key is null' as error_message,
           o_orderdate as created_on_date,
           case when o_orderdate > timestamp '2000-01-01' then 2 else 1 end as run
    from orders where o_orderpriority = '1-URGENT'
    union all
    select cast(o_custkey as varchar), 'PRICE_LIMIT', o_orderdate, run
    from ({_SENT}) where rn = 1 and o_totalprice > 400000
"""

# One run: the latest order of each customer is sent; urgent orders have no key.
_ONCE = """
    with latest as (
        select cast(o_custkey as varchar) as id, o_totalprice, o_orderdate, o_orderkey, o_custkey
        from (select *, row_number() over (
                  partition by o_custkey
                  order by o_orderdate desc, cast(o_totalprice as decimal(12,2)) desc,
                           o_orderkey desc) as rn
              from orders where o_orderpriority <> '1-URGENT')
        where rn = 1),
    unkeyed as (
        select cast(null as varchar) as id, 'key is null' as error_message, o_orderdate as dated
        from orders where o_orderpriority = '1-URGENT'),
"""


def _once(log: str, delivered: str, latest: str = "latest") -> str:
    """Target, log and audit of one run, from the rows logged and the rows delivered."""
    return f"""{_ONCE}
    log as (select * from unkeyed union all {log})
    select 'target' as part, id, cast(null as varchar) as error_message,
           cast(null as timestamp) as dated, o_orderkey as n
    from {latest} where {delivered}
    union all
    select 'log', id, error_message, dated, null from log
    union all
    select 'audit', (select cast(count(*) as varchar) from orders), null,
           (select max(o_orderdate) from orders), (select count(*) from log)
    """


_RECORDS = """
    select cast(event_id as varchar) as Id, event_type as Kind,
           case when event_type <> 'error' then 'true' else 'false' end as IsActive,
           date_trunc('millisecond', ts)
             + to_hours(cast(user_id as integer)) as LastModifiedDate,
           date_trunc('millisecond', ts) as CreatedDate,
           case when event_type <> 'click' then date_trunc('millisecond', ts) end as LastLoginDate,
           ts
    from events where event_type <> 'error'
"""

# Run 1 takes the older records; run 2 what lies above the mark run 1 reached.
_INBOUND = f"""
    with r as ({_RECORDS}),
    first_run as (select *, 1 as batch_id from r where ts <= timestamp '2024-01-10'),
    mark as (select coalesce(max(greatest(LastModifiedDate, CreatedDate)),
                             timestamp '1970-01-01') as m from first_run),
    second_run as (
        select r.*, 2 as batch_id from r, mark
        where r.CreatedDate > m or r.LastModifiedDate > m)
"""

_EVENT_COLUMNS = "event_id, user_id, event_type, value, props, ts"

_MOVED = """
    select c_custkey, c_name, c_nationkey,
           case when c_mktsegment = 'BUILDING' then 'BUILT' else c_mktsegment end as c_mktsegment
    from customer where c_acctbal >= 0
    union all
    select -c_custkey, c_name, c_nationkey, c_mktsegment
    from customer where c_acctbal >= 0 and c_mktsegment = 'MACHINERY'
"""

ORACLES: dict[str, str] = {
    "watermark_max": """
        select coalesce(max(o_orderdate), timestamp '1970-01-01') as watermark
        from orders where o_orderstatus = 'F'""",
    "watermark_default": """
        select coalesce(max(o_orderdate), timestamp '1970-01-01') as watermark
        from orders where o_orderstatus = 'none'""",
    "watermark_ms": "select date_trunc('millisecond', max(ts)) as watermark from events",
    "watermark_by_object": """
        select event_type, max(ts) as watermark from events group by event_type""",
    "delta_scan": _DELTA,
    "delta_scan_inclusive": f"""
        select * from ({_SOURCE})
        where o_orderdate >= timestamp '2001-06-01' or updated >= timestamp '2001-06-01'""",
    "delta_after_log": f"""
        with m as (select date_trunc('millisecond', max(o_orderdate)) as mark
                   from orders where o_orderstatus = 'F')
        select s.* from ({_SOURCE}) s, m where o_orderdate > mark or updated > mark""",
    "backfill_delta": "select * from orders where o_orderdate > timestamp '2000-01-01'",
    "delta_stats": f"""
        select row_count, c as max_o_orderdate, m as max_updated from ({_STATS})""",
    "active_delta": """
        select * from events where ts > timestamp '2024-01-10' and event_type <> 'error'""",
    "next_watermark_greatest": f"""
        select greatest(coalesce(greatest(c, m), timestamp '2001-06-01'),
                        timestamp '2001-06-01') as next_watermark from ({_STATS})""",
    "next_watermark_created_only": f"""
        select greatest(coalesce(c, timestamp '2001-06-01'),
                        timestamp '2001-06-01') as next_watermark from ({_STATS})""",
    "next_watermark_day_gap": f"""
        select greatest(coalesce(case when m >= c + interval 24 hour then m else c end,
                                 timestamp '2001-06-01'),
                        timestamp '2001-06-01') as next_watermark from ({_STATS})""",
    "mask_closed": """
        select c_custkey, c_name, c_nationkey, c_acctbal,
               case when c_acctbal < 0 then 'NA' else c_mktsegment end as c_mktsegment
        from customer""",
    "map_project": """
        select c_mktsegment as program, cast(c_custkey as varchar) as external_key,
               cast(c_acctbal as decimal(12,2)) as score, c_name as full_name
        from customer""",
    "map_from_file": """
        select c_mktsegment as program, cast(c_custkey as varchar) as external_key,
               cast(c_acctbal as decimal(12,2)) as score, c_name as full_name
        from customer""",
    "map_cast_try": """
        select cast(o_orderkey as varchar) as external_key,
               try_cast(o_totalprice as decimal(7,2)) as price,
               try_cast(o_orderpriority as integer) as priority_number,
               cast(o_orderdate as date) as order_day
        from orders""",
    "map_truncate": """
        select o_orderkey as order_key, left(o_orderpriority, 8) as priority,
               left(o_orderstatus, 1) as status
        from orders""",
    "overlong_rows": """
        select * from orders where length(o_orderpriority) > 8 or length(o_orderstatus) > 1""",
    "nullify_and_cast": """
        select event_id,
               case when event_type <> 'error' then user_id end as user_id,
               case when event_type <> 'error' and props <> '' then props end as props
        from events""",
    "epoch_to_datetime": f"""
        select event_id, event_type,
               strftime(to_timestamp(modified // 1000) at time zone 'UTC',
                        '%Y-%m-%d %H:%M:%S') as modified
        from ({_MILLIS})""",
    "epoch_to_datetime_zone": f"""
        select event_id, event_type,
               strftime(to_timestamp(modified // 1000) at time zone 'America/New_York',
                        '%Y-%m-%d %H:%M:%S') as modified
        from ({_MILLIS})""",
    "epoch_to_timestamp": """
        select event_id, date_trunc('millisecond', ts) as modified, event_type from events""",
    "text_watermark": """
        select count(*) as row_count,
               greatest(max(date_trunc('second', ts)), timestamp '2024-01-01') as next_watermark
        from events""",
    "require_columns": f"select * from ({_TEXT}) where user_id <> '' and event_id <> ''",
    "missing_columns": f"select * from ({_TEXT}) where user_id is null",
    "dedup_latest": """
        select * exclude (rn) from (
            select *, row_number() over (
                partition by l_orderkey, l_linenumber
                order by l_shipdate desc nulls last, l_partkey desc nulls last,
                         l_suppkey desc nulls last, l_quantity desc nulls last,
                         l_extendedprice desc nulls last, l_discount desc nulls last,
                         l_tax desc nulls last, l_returnflag desc nulls last,
                         l_linestatus desc nulls last) as rn
            from lineitem)
        where rn = 1""",
    "unkeyed_rows": f"select * exclude (updated) from ({_SOURCE}) where updated is null",
    "classify_changes": f"""
        select s.c_custkey, s.c_mktsegment,
               case when c.c_custkey is null then 'insert' else 'update' end as action
        from ({_INCOMING}) s left join customer c on c.c_custkey = s.c_custkey""",
    "upsert": _OVERWRITE,
    "upsert_keep": _KEEP,
    "keyed_table_upsert": _OVERWRITE,
    "bucketed_table_upsert": _OVERWRITE,
    "key_filter_rows": """
        select l_orderkey, l_linenumber, l_shipdate from lineitem
        where l_orderkey in (select o_orderkey from orders
                             where o_orderdate > timestamp '2001-06-01')""",
    "watermark_footer": """
        select max(event_id) as watermark, count(*) as row_count from events""",
    "number_rows": _NUMBERED,
    "number_rows_tied": """
        with n as (select l_shipdate, count(*) as row_count from lineitem group by 1),
        e as (select *, sum(row_count) over (order by l_shipdate) as last_num from n)
        select l_shipdate, cast(last_num - row_count + 1 as bigint) as first_num,
               cast(last_num as bigint) as last_num, row_count
        from e""",
    "assign_batches": f"""
        select (row_num - 1) // 1000 + 1 as batch_num, count(*) as row_count,
               min(o_orderdate) as first_date, max(o_orderdate) as last_date
        from ({_NUMBERED}) group by 1""",
    "preview": "select * from orders order by o_orderdate, o_orderkey limit 10",
    "export_batches": "select doc_id, lang, text from documents",
    "failures": f"select o_orderkey, success, error from ({_FAILED})",
    "failures_plain": f"select o_orderkey, success, error from ({_RESULTS}) where success <> 'true'",
    "align_by_key": f"select o_orderkey, error, o_orderdate from ({_FAILED})",
    "align_by_position": f"""
        select row_num, o_orderkey as sent_key, o_custkey, error
        from (select *, row_number() over (order by o_orderdate, o_orderkey) as row_num
              from ({_RESULTS}))
        where success is distinct from 'true'""",
    "failure_log": f"""
        select o_orderkey, error as error_message, o_orderdate as created_on_date
        from ({_FAILED})""",
    "failure_log_repeated_key": f"""
        select f.o_custkey, f.error as error_message, s.newest as created_on_date
        from ({_FAILED}) f
        join (select o_custkey, max(o_orderdate) as newest from orders group by 1) s
          on s.o_custkey = f.o_custkey""",
    "failure_summary": f"""
        select error as error_message, count(*) as failed_count from ({_FAILED}) group by 1""",
    "results_ingest": f"""
        select id, success, cast(null as varchar) as created, error,
               cast(o_orderkey as varchar) as o_orderkey
        from ({_FAILED})""",
    "audit_history": """
        with runs(mark, until) as (values
            (timestamp '1970-01-01', timestamp '2000-01-01'),
            (timestamp '2000-01-01', timestamp '2001-07-01'),
            (timestamp '2001-07-01', timestamp '2100-01-01')),
        seen as (
            select mark, until, count(o_orderkey) as n, max(o_orderdate) as newest
            from runs left join orders on o_orderdate <= until and o_orderdate > mark
            group by mark, until)
        select until as execution_start_time, until as execution_end_time,
               case when n > 0 then 1 else 2 end as is_success, n as record_count,
               coalesce(newest, mark) as watermark, 'orders' as object_name,
               cast(0 as bigint) as failed_count
        from seen""",
    "register_batch": """
        select 'click' as object_name, timestamp '2024-03-01 12:00:00' as created_on_date,
               0 as is_merged, max(event_id) + 1 as batch_id
        from events""",
    "latest_batch": "select max(event_id) as batch_id from events where event_type = 'click'",
    "append_snapshot": """
        select event_id, user_id, timestamp '2024-03-01' as time_stamp,
               cast(1 as bigint) as batch_id from events
        union all
        select event_id, user_id, timestamp '2024-03-02', 2 from events where user_id > 50""",
    "json_ingest": f"select {_EVENT_COLUMNS} from events",
    "stream_incremental": f"""
        select {_EVENT_COLUMNS} from (
            select *, row_number() over (
                partition by user_id order by ts desc, event_id desc) as rn
            from events)
        where rn = 1""",
    "stream_snapshots": f"""
        select {_EVENT_COLUMNS},
               cast(case when ts <= timestamp '2024-01-10' then 0 else 1 end as bigint) as batch_id
        from events""",
    "json_ingest_variant": f"""
        select {_EVENT_COLUMNS}, cast(props ->> '$.k' as bigint) as k,
               concat_ws(',', case when event_type is not null then 'event_type' end,
                         case when props is not null then 'props' end,
                         case when value is not null then 'value' end) as unmapped,
               true as parsed
        from events""",
    "stream_deduplicated": f"select {_EVENT_COLUMNS} from events",
    "register_batch_race": """
        select 'click' as object_name, timestamp '2024-03-01 12:00:00' as created_on_date,
               0 as is_merged, max(event_id) + 1 as batch_id
        from events
        union all
        select 'view', timestamp '2024-03-01 12:00:00', 0, max(event_id) + 2 from events""",
    "load_times": """
        select cast(7 as bigint) as batch_id, count(*) as row_count,
               cast(1 as bigint) as load_times, true as loaded_in_run,
               true as audit_in_order, true as audited_after_load
        from events""",
    "vanished_keys": f"""
        with s as ({_MOVED})
        select coalesce(c.c_custkey, s.c_custkey) as c_custkey,
               case when s.c_custkey is null then 'vanished'
                    when c.c_custkey is null then 'added' else 'changed' end as change
        from customer c full join s on s.c_custkey = c.c_custkey
        where s.c_custkey is null or c.c_custkey is null or c.c_mktsegment <> s.c_mktsegment""",
    "reconcile_ranges": """
        with r as (
            select substr(md5(length(o_orderkey::varchar)::varchar || ':' || o_orderkey::varchar),
                          1, 3) as range, o_orderkey % 1009 <> 7 as kept
            from orders)
        select range, count(*) as target_rows, count(*) filter (where kept) as source_rows
        from r group by range having count(*) <> count(*) filter (where kept)""",
    "outbound_delta": f"""
        select cast(o_orderkey as varchar) as order_key, c_name as full_name,
               case when c_acctbal < 0 then 'NA' else c_mktsegment end as program,
               cast(c_acctbal as decimal(12,2)) as score, o_orderpriority as priority
        from ({_DELTA}) join customer on o_custkey = c_custkey""",
    "run_outbound_target": f"""
        select customer_key, program, price, last_order from (
            select cast(o_custkey as varchar) as customer_key, program,
                   cast(o_totalprice as decimal(12,2)) as price, o_orderkey as last_order,
                   row_number() over (partition by o_custkey order by run desc) as newest
            from ({_SENT}) where rn = 1 and o_totalprice <= 400000)
        where newest = 1""",
    "run_outbound_failures": f"""
        select o_custkey, error_message, created_on_date from ({_OUTBOUND_FAILURES})""",
    "run_outbound_audit": f"""
        with runs as (
            select case when o_orderdate > timestamp '2000-01-01' then 2 else 1 end as run,
                   count(*) as n, max(o_orderdate) as newest
            from orders group by 1),
        failed as (select run, count(*) as n from ({_OUTBOUND_FAILURES}) group by 1)
        select 1 as is_success, runs.n as record_count, newest as watermark,
               'orders' as object_name, coalesce(failed.n, 0) as failed_count
        from runs left join failed on failed.run = runs.run
        union all
        select 2, 0, max(o_orderdate), 'orders', 0 from orders""",
    "run_outbound_unanswered": _once(
        "select id, 'no result', o_orderdate from latest where o_totalprice > 400000",
        "o_totalprice <= 400000",
    ),
    "run_outbound_unmatched": _once(
        """select id, 'no result', o_orderdate from latest where o_custkey % 10 < 2
           union all
           select 'x' || id, 'result without a sent row', null from latest
           where o_custkey % 10 = 0
           union all
           select null, 'result without a sent row', null from latest where o_custkey % 10 = 1""",
        "o_custkey % 10 > 1",
    ),
    "run_outbound_bad_values": _once(
        """select id, 'values do not fit: price', o_orderdate from latest
           where cast(o_totalprice as decimal(12,2)) >= 100000""",
        "cast(o_totalprice as decimal(12,2)) < 100000",
    ),
    "run_outbound_positional": _once(
        "select id, 'PRICE_LIMIT', o_orderdate from latest where o_totalprice > 400000",
        "o_totalprice <= 400000",
    ),
    "run_outbound_batch_positions": _once(
        "select id, 'PRICE_LIMIT', o_orderdate from latest where o_totalprice > 400000",
        "o_totalprice <= 400000",
    ),
    "run_outbound_failed": """
        select 0 as is_success, 0 as record_count, timestamp '1970-01-01' as watermark,
               'orders' as object_name, 0 as failed_count
        union all
        select 1, count(*), max(o_orderdate), 'orders',
               count(*) filter (where o_orderpriority = '1-URGENT')
        from orders""",
    "run_outbound_uncast": f"""
        {_ONCE.rstrip().rstrip(",")}
        select id as customer_key, cast(o_totalprice as double) as price, o_orderkey as last_order
        from latest""",
    "run_inbound_late": f"""
        select Id, Kind, IsActive, LastModifiedDate, CreatedDate, LastLoginDate,
               cast(case when ts <= timestamp '2024-01-10' then 1 else 2 end as bigint) as batch_id
        from ({_RECORDS})""",
    "run_inbound_legacy": f"""
        with r as (
            select date_trunc('second', CreatedDate) as c,
                   date_trunc('second', LastModifiedDate) as m, ts from ({_RECORDS})),
        first as (
            select count(*) as n, max(c) as c, max(m) as m from r
            where ts <= timestamp '2024-01-10'),
        mark as (select case when m >= c + interval 24 hours then m else c end as w, n from first),
        second as (
            select count(*) as n, max(r.c) as c, max(r.m) as m from r, mark
            where r.c > w or r.m > w)
        select 1 as is_success, n as record_count, w as watermark, 'User' as object_name,
               cast(0 as bigint) as failed_count
        from mark
        union all
        select 1, second.n,
               greatest(case when m >= c + interval 24 hours then m else c end, w), 'User', 0
        from second, mark""",
    "run_inbound_rejects": f"""
        with kept as (select * from ({_RECORDS}) where Kind <> 'click'),
        mark as (select max(greatest(LastModifiedDate, CreatedDate)) as m
                 from kept where ts <= timestamp '2024-01-10'),
        runs as (
            select 1 as run, (select count(*) from kept where ts <= timestamp '2024-01-10') as n,
                   (select count(*) from events
                    where event_type in ('error', 'click') and ts <= timestamp '2024-01-10') as bad
            union all
            select 2, (select count(*) from kept, mark where ts > timestamp '2024-01-10'
                       and (CreatedDate > m or LastModifiedDate > m)),
                   (select count(*) from events
                    where event_type in ('error', 'click') and ts > timestamp '2024-01-10')
            union all
            select 3, 0, 0)
        select 'reject' as part,
               case when event_type = 'error' then '{{"Id":"' || event_id || '","Kin'
                    else '{{"Id":"' || event_id || '","CreatedDate":"soon"}}' end as record
        from events where event_type in ('error', 'click')
        union all
        select 'audit', n || '/' || bad from runs""",
    "run_inbound_snapshot": f"""
        {_INBOUND}
        select Id, Kind, IsActive, LastModifiedDate, CreatedDate, LastLoginDate,
               cast(batch_id as bigint) as batch_id
        from (select * from first_run union all select * from second_run)""",
    "run_inbound_manifest": f"""
        select Id, Kind, IsActive, LastModifiedDate, CreatedDate, LastLoginDate,
               cast(case when ts <= timestamp '2024-01-10' then 1 else 2 end as bigint) as batch_id
        from ({_RECORDS})""",
    "run_inbound_unmapped": f"""
        select Id, '{{"Kind__c":"' || Kind || '"}}' as others, IsActive, LastModifiedDate,
               CreatedDate, LastLoginDate,
               cast(case when ts <= timestamp '2024-01-10' then 1 else 2 end as bigint) as batch_id
        from ({_RECORDS})""",
    "stream_inbound": f"""
        select Id, Kind, IsActive, LastModifiedDate, CreatedDate, LastLoginDate,
               cast(case when ts <= timestamp '2024-01-10' then 1 else 2 end as bigint) as batch_id
        from ({_RECORDS})""",
    "run_inbound_audit": f"""
        {_INBOUND},
        runs as (
            select 1 as run, count(*) as n,
                   max(greatest(LastModifiedDate, CreatedDate)) as newest from first_run
            union all
            select 2, count(*), max(greatest(LastModifiedDate, CreatedDate)) from second_run
            union all
            select 3, 0, null)
        select case when n > 0 then 1 else 2 end as is_success, n as record_count,
               max(newest) over (order by run) as watermark, 'User' as object_name,
               cast(0 as bigint) as failed_count
        from runs""",
}
