"""The same questions in DuckDB SQL."""

from __future__ import annotations

_PURCHASES = "(select event_id, user_id, ts from events where event_type='purchase')"
_VIEWS = "(select * from events where event_type='view')"
_CLICKS = "(select * from events where event_type='click')"
_ORDERS = (
    "(select o_custkey, o_orderdate as ets, o_orderdate + to_days(cast(o_orderkey % 5 as integer)) as cts, "
    "o_orderkey as id, o_totalprice, o_orderpriority from orders)"
)
_NEWEST_ORDER = "row_number() over (partition by o_custkey order by ets desc, cts desc, id desc) as rn"
_NEWEST_EVENT = "row_number() over (partition by user_id order by ts desc, event_id desc) as rn"
_SCORES = (
    "select user_id, ts, case when event_type in ('purchase','signup') then value end as f1, "
    "case when event_type <> 'error' then value end as f2 "
    f"from (select *, {_NEWEST_EVENT} from events where {{}}) where rn = 1"
)
_NEWEST_SHIPPED = (
    "(select * from (select *, row_number() over (partition by l_partkey, l_suppkey order by l_shipdate desc, "
    "l_orderkey desc, l_linenumber desc, l_quantity desc) as rn from lineitem) where rn = 1)"
)
_SHIP_SCHEMA = "struct<l_quantity:double>"
_SHIP_REF = f"substr(md5('{_SHIP_SCHEMA}'), 1, 8)"
_SHIP_VALUE = """('{"l_quantity":' || cast(l_quantity as varchar) || '}')"""


def _score_batch(condition: str) -> str:
    return "(" + _SCORES.format(condition) + ")"


def _last_line(key: str, feature: str) -> str:
    """Latest line per key and ship date, ties by order, line and price."""
    return (
        f"(select {key}, l_shipdate, {feature} from (select *, row_number() over (partition by {key}, l_shipdate "
        "order by l_orderkey desc, l_linenumber desc, l_extendedprice desc, l_discount desc) as rn from lineitem) where rn = 1)"
    )


ORACLES: dict[str, str] = {
    "q_scan_range": """
        select event_id, user_id, ts as event_timestamp, value from events
        where ts >= timestamp '2024-01-08' and ts < timestamp '2024-01-15'""",
    "q_date_partition": """
        select cast(ts as date) as d, count(*) as n from events
        where ts >= timestamp '2024-01-08' and ts < timestamp '2024-01-15' group by 1""",
    "q_mapping_expr": """
        select event_id, user_id as customer_id, value + 1 as value_plus, value * 2 + event_id as mix,
               ts as event_timestamp from events""",
    "q_nested_extract": "select event_id, cast(json_extract(props, '$.k') as bigint) as k from events",
    "q_float_cast": """
        select p_partkey, cast(p_retailprice as float) as p_retailprice,
               timestamp '1998-01-01' as event_timestamp from part""",
    "q_time_normalise": "select event_id, ts as event_timestamp from events",
    "q_csv_load": "select * from customer",
    "q_latest_per_key": f"""
        select o_custkey, ets as event_timestamp, o_totalprice, o_orderpriority
        from (select *, {_NEWEST_ORDER} from {_ORDERS}
              where ets between timestamp '1996-01-01' and timestamp '1999-12-31') where rn = 1""",
    "q_global_latest": "select event_id, ts, value from events order by ts desc, event_id desc limit 1",
    "q_pull_all": """
        select o_custkey, o_totalprice, o_orderdate as event_timestamp from orders
        where o_orderdate between timestamp '1997-01-01' and timestamp '1997-12-31'""",
    "q_pit_unlimited": f"""
        select s.event_id, s.user_id, s.ts, f.value as views__value
        from {_PURCHASES} s asof left join {_VIEWS} f on s.user_id = f.user_id and s.ts >= f.ts""",
    "q_pit_max_age": f"""
        select s.event_id, s.user_id, s.ts,
               case when f.ts >= s.ts - interval 6 hour then f.value end as views__value
        from {_PURCHASES} s asof left join {_VIEWS} f on s.user_id = f.user_id and s.ts >= f.ts""",
    "q_pit_created_ties": f"""
        select c.c_custkey as o_custkey, f.o_totalprice as orders__o_totalprice,
               f.o_orderpriority as orders__o_orderpriority
        from customer c left join (
            select *, {_NEWEST_ORDER} from {_ORDERS}
            where ets <= timestamp '1998-06-15' and ets >= timestamp '1998-06-15' - interval 365 day
        ) f on f.o_custkey = c.c_custkey and f.rn = 1""",
    "q_pit_composite_key": """
        select s.l_partkey, s.l_suppkey, f.l_quantity as ship__l_quantity
        from (select distinct l_partkey, l_suppkey from lineitem) s left join (
            select *, row_number() over (partition by l_partkey, l_suppkey
                order by l_shipdate desc, l_orderkey desc, l_linenumber desc, l_quantity desc) as rn
            from lineitem where l_shipdate <= timestamp '1998-06-01'
        ) f on f.l_partkey = s.l_partkey and f.l_suppkey = s.l_suppkey and f.rn = 1""",
    "q_pit_duplicate_spine": f"""
        select s.event_id, s.ts, f.value as views__value
        from (select * from {_PURCHASES} union all select * from {_PURCHASES}) s
        asof left join {_VIEWS} f on s.user_id = f.user_id and s.ts >= f.ts""",
    "q_pit_multi": f"""
        select s.event_id, s.user_id, s.ts,
               case when v.ts >= s.ts - interval 6 hour then v.value end as views__value,
               c.value as clicks__value, o.o_totalprice as orders__o_totalprice
        from {_PURCHASES} s
        asof left join {_VIEWS} v on s.user_id = v.user_id and s.ts >= v.ts
        asof left join {_CLICKS} c on s.user_id = c.user_id and s.ts >= c.ts
        left join (select *, {_NEWEST_ORDER} from {_ORDERS}) o on o.o_custkey = s.user_id and o.rn = 1""",
    "q_pit_two_keys": f"""
        select s.l_orderkey, s.l_linenumber, s.l_partkey, s.l_suppkey, s.l_quantity, s.l_shipdate,
               case when p.l_shipdate >= s.l_shipdate - interval 90 day then p.l_extendedprice end as part__l_extendedprice,
               case when u.l_shipdate >= s.l_shipdate - interval 90 day then u.l_discount end as supp__l_discount
        from lineitem s
        asof left join {_last_line("l_partkey", "l_extendedprice")} p
            on s.l_partkey = p.l_partkey and s.l_shipdate >= p.l_shipdate
        asof left join {_last_line("l_suppkey", "l_discount")} u
            on s.l_suppkey = u.l_suppkey and s.l_shipdate >= u.l_shipdate""",
    "q_pit_hot_keys": """
        select s.l_orderkey, s.l_linenumber, s.l_linestatus as status, s.l_shipdate,
               f.o_totalprice as status_orders__o_totalprice
        from lineitem s asof left join (
            select * from (select *, row_number() over (partition by o_orderstatus, o_orderdate
                order by o_orderkey desc, o_totalprice desc) as rn from orders) where rn = 1
        ) f on s.l_linestatus = f.o_orderstatus and s.l_shipdate >= f.o_orderdate""",
    "q_pit_bare_names": f"""
        select s.event_id, s.user_id, s.ts,
               case when f.ts >= s.ts - interval 1 hour then f.event_type end as event_type,
               case when f.ts >= s.ts - interval 1 hour then f.value end as value
        from {_PURCHASES} s asof left join (select * from events where event_type <> 'purchase') f
            on s.user_id = f.user_id and s.ts >= f.ts""",
    "q_min_distance": f"""
        select s.event_id, epoch_us(s.ts) // 1000000 - epoch_us(f.ts) // 1000000 as min_distance
        from {_PURCHASES} s asof join {_VIEWS} f on s.user_id = f.user_id and s.ts >= f.ts""",
    "q_on_demand": f"""
        select s.event_id, s.value / nullif(f.value, 0) as ratio
        from (select * from events where event_type = 'purchase') s
        asof left join {_VIEWS} f on s.user_id = f.user_id and s.ts >= f.ts""",
    "q_training_rows": f"""
        select s.event_id, s.user_id, s.ts, f.value as views__value
        from {_PURCHASES} s asof join {_VIEWS} f on s.user_id = f.user_id and s.ts >= f.ts
        where f.ts >= s.ts - interval 6 hour and f.value is not null""",
    "q_semi_reduce": f"""
        select o_orderkey, o_custkey from orders where o_custkey in (select user_id from {_PURCHASES} p)""",
    "q_sketch_reduce": """
        select (select count(*) from lineitem) as n_before, count(*) as n_kept, true as few_others
        from lineitem where l_partkey in (select p_partkey from part where p_size <= 10)""",
    "q_pit_snapshot": f"""
        select s.event_id, s.user_id, s.ts, f.value as views__value
        from {_PURCHASES} s asof left join {_VIEWS} f on s.user_id = f.user_id and s.ts >= f.ts
        where s.ts >= timestamp '2024-01-15 07:00:00'""",
    "q_pit_snapshot_late": f"""
        select s.event_id, s.user_id, s.ts, f.value as views__value
        from {_PURCHASES} s asof left join {_VIEWS} f on s.user_id = f.user_id and s.ts >= f.ts
        where s.ts >= timestamp '2024-01-14 12:00:00'""",
    "q_spine_bounds": f"select min(ts) as min_ts, max(ts) as max_ts from {_PURCHASES} p",
    "q_range_join_candidates": f"""
        select s.user_id, count(*) as n from {_PURCHASES} s join {_VIEWS} f
            on s.user_id = f.user_id and f.ts <= s.ts and f.ts >= s.ts - interval 6 hour group by 1""",
    "q_compact_batch": f"""
        select user_id, event_id, ts, value from (select *, {_NEWEST_EVENT} from events) where rn = 1""",
    "q_online_upsert": f"""
        select coalesce(n.user_id, o.user_id) as user_id,
               case when o.ts is null or n.ts >= o.ts then n.ts else o.ts end as event_timestamp,
               case when n.ts is null then o.f1 when o.ts is null then n.f1
                    when n.ts >= o.ts then coalesce(n.f1, o.f1) else o.f1 end as f1,
               case when n.ts is null then o.f2 when o.ts is null then n.f2
                    when n.ts >= o.ts then coalesce(n.f2, o.f2) else o.f2 end as f2
        from {_score_batch("event_type in ('purchase','view')")} o
        full join {_score_batch("event_type not in ('purchase','view')")} n on n.user_id = o.user_id""",
    "q_online_compacted": f"""
        select user_id, max(ts) as event_timestamp,
               arg_max(f1, b) filter (where f1 is not null) as f1,
               arg_max(f2, b) filter (where f2 is not null) as f2
        from (select 0 as b, * from {_score_batch("ts < timestamp '2024-01-10'")}
              union all
              select 1, * from {_score_batch("ts >= timestamp '2024-01-10' and ts < timestamp '2024-01-20'")}
              union all
              select 2, * from {_score_batch("ts >= timestamp '2024-01-20'")}) group by 1""",
    "q_online_lookup": f"""
        select c.c_custkey as user_id, f.value as activity__value from customer c
        left join (select * from (select *, {_NEWEST_EVENT} from events) where rn = 1) f on f.user_id = c.c_custkey""",
    "q_online_lookup_hot": """
        select c_custkey, c_nationkey, n_name as nation__n_name
        from customer left join nation on n_nationkey = c_nationkey""",
    "q_online_expired": f"""
        select c.c_custkey as user_id,
               case when f.ts + interval 2 day > timestamp '2024-01-31' then f.value end as value
        from customer c
        left join (select * from (select *, {_NEWEST_EVENT} from events) where rn = 1) f on f.user_id = c.c_custkey""",
    "q_ttl_change": f"""
        select user_id, ts as event_timestamp, value, ts + interval 1 day as expiry_timestamp
        from (select *, {_NEWEST_EVENT} from events) where rn = 1""",
    "q_key_expiry": """
        select user_id, max(x) as expiry_timestamp from (
            select user_id, max(ts) + interval 30 day as x from events where event_type = 'view' group by 1
            union all
            select user_id, max(ts) + interval 60 day from events where event_type = 'click' group by 1
        ) group by 1""",
    "q_materialize": f"""
        select o_custkey, ets as event_timestamp, o_totalprice, ets + interval 365 day as expiry_timestamp
        from (select *, {_NEWEST_ORDER} from {_ORDERS}) where rn = 1""",
    "q_materialize_missing": f"""
        select user_id, ts as event_timestamp, value from (
            select *, row_number() over (partition by user_id order by ts desc, value desc) as rn from {_VIEWS}
            where ts >= timestamp '2024-01-05' and ts < timestamp '2024-01-20') where rn = 1""",
    "q_push_online": """
        select user_id, ts as event_timestamp, value * 2 as spend from (
            select *, row_number() over (partition by user_id order by ts desc, value desc) as rn
            from events where event_type = 'purchase') where rn = 1""",
    "q_embedding_pit": """
        select vec_id, label, len(embedding) as dim, embedding[1] as first, embedding[-1] as last,
               list_min(embedding) as least, list_max(embedding) as most from embeddings""",
    "q_kv_layout": f"""
        select 'default#user_id#' || user_id as entity_key, substr(md5(f), 1, 8) as field_hash, f as feature, v as feature_value
        from (select user_id, value, case when event_type = 'purchase' then value end as pv
              from (select *, {_NEWEST_EVENT} from events) where rn = 1)
        unpivot (v for f in (value as 'activity:value', pv as 'activity:pv'))""",
    "q_kv_times": f"""
        select 'default#user_id#' || user_id as entity_key, field, substr(md5(field), 1, 8) as field_hash, value from (
            select user_id, '_ts:activity' as field, ts as value from (select *, {_NEWEST_EVENT} from events) where rn = 1
            union all
            select user_id, '_ex:activity', ts + interval 30 day from (select *, {_NEWEST_EVENT} from events) where rn = 1)""",
    "q_wide_layout_key": f"""
        select concat_ws('#', cast(l_partkey as varchar), cast(l_suppkey as varchar)) as row_key, l_shipdate as ts,
               {_SHIP_REF} as schema_ref, upper({_SHIP_REF}) || hex({_SHIP_VALUE}) as value from {_NEWEST_SHIPPED}""",
    "q_column_layout_rows": f"""
        select concat_ws('#', cast(l_partkey as varchar), cast(l_suppkey as varchar)) as key, {_SHIP_VALUE} as ship,
               {_SHIP_REF} as ship__schema_ref, epoch_us(l_shipdate) as write_time, cast(864000 as bigint) as ttl
        from {_NEWEST_SHIPPED}""",
    "q_schema_registry": f"""
        select substr(md5(schema), 1, 8) as schema_ref, schema, n from (
            select '{_SHIP_SCHEMA}' as schema, count(*) as n from {_NEWEST_SHIPPED}
            union all
            select 'struct<value:double,pv:double>', count(*) from (select *, {_NEWEST_EVENT} from events) where rn = 1)""",
    "q_row_validity": """
        select event_type <> 'error' and user_id is not null and ts is not null as is_valid, count(*) as n
        from events group by 1""",
    "q_deadletter": "select event_id, 'entity_null' as reason from events where event_type = 'error'",
    "q_expectations": """
        select event_id, value between 0 and 50 and event_type in ('click','view','purchase') as is_valid
        from events""",
    "q_check_counts": """
        select 'expect_column_values_to_be_between(value, max_value=50, min_value=0)' as check_name,
               count(*) filter (where not value between 0 and 50) as failed from events
        union all
        select 'expect_column_values_to_be_in_set(event_type, value_set=[click, purchase, view])',
               count(*) filter (where event_type not in ('click','view','purchase')) from events""",
    "q_rules_over_rows": """
        with e as (select event_id, case when event_type <> 'error' then user_id end as user_id, event_type from events),
        counted as (
            select count(*) over (partition by event_id) as ids, event_type, user_id,
                   count(*) over (partition by user_id, event_type) as pairs,
                   count(*) over (partition by event_type) / (select count(event_type) from e) as share from e)
        select 'expect_column_values_to_be_unique(event_id)' as check_name, count(*) filter (ids > 1) as failed from counted
        union all
        select 'expect_compound_columns_to_be_unique(column_list=[event_type, user_id])',
               count(*) filter (pairs > 1 and user_id is not null) from counted
        union all
        select 'expect_column_value_shares_to_be_between(event_type, max_value=0.2)', count(*) filter (share > 0.2) from counted""",
    "q_observed_checks": """
        select 'expect_column_unique_value_count_to_be_between(user_id, min_value=1)' as check_name,
               cast(count(distinct user_id) as double) as observed_value, true as success,
               cast(0 as bigint) as reported_value from events
        union all
        select 'expect_column_min_to_be_between(value, min_value=1000)', min(value), min(value) >= 1000,
               case when min(value) >= 1000 then 0 else cast(trunc(min(value) * 100) as bigint) end from events
        union all
        select 'expect_column_max_to_be_between(value, max_value=100)', max(value), max(value) <= 100,
               case when max(value) <= 100 then 0 else cast(trunc(max(value) * 100) as bigint) end from events
        union all
        select 'expect_table_row_count_to_be_between(min_value=1)', cast(count(*) as double), true, 0 from events""",
    "q_suite_function": """
        select event_type, value between 0 and 50 and event_type in ('click','view','purchase') as is_valid,
               count(*) as n from events group by 1, 2""",
    "q_ingest_online": """
        select user_id, ts as event_timestamp, event_id, value, event_type from (
            select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rn from events
            where ts >= timestamp '2024-01-03' and ts < timestamp '2024-01-29'
              and value between 0 and 50 and event_type in ('click','view','purchase')) where rn = 1""",
    "q_ingest_flagged": """
        select reason, count(*) as n from (
            select 'entity_null' as reason from events where event_type = 'error'
            union all
            select 'expect_column_values_to_be_between(value, max_value=50, min_value=0)' from events where not value between 0 and 50
            union all
            select 'expect_column_values_to_be_in_set(event_type, value_set=[click, purchase, view])' from events
            where event_type not in ('click','view','purchase')) group by 1""",
    "q_stream_state": f"""
        select user_id, ts as event_timestamp, event_id, value from (select *, {_NEWEST_EVENT} from events) where rn = 1""",
    "q_keyed_state": f"""
        select user_id, ts as event_timestamp, event_id, value from (select *, {_NEWEST_EVENT} from events) where rn = 1""",
    "q_keyed_expired": f"""
        select c.c_custkey as user_id,
               case when f.ts + interval 2 day > timestamp '2024-01-31' then f.value end as value
        from customer c
        left join (select * from (select *, {_NEWEST_EVENT} from events) where rn = 1) f on f.user_id = c.c_custkey""",
    "q_stream_deadletter": """
        select cast(r as int) as run, user_id, ts as event_timestamp, 'malformed' as reason
        from events, range(1, 3) runs(r) where event_type = 'error'""",
    "q_lag_summary": """
        select event_type, count(*) as n, min(lag) as min_lag_us, max(lag) as max_lag_us,
               quantile_disc(lag, 0.5) as p50_lag_us, quantile_disc(lag, 0.95) as p95_lag_us,
               quantile_disc(lag, 0.99) as p99_lag_us,
               cast(round(avg(lag) / 1e6) as bigint) as mean_lag_s, cast(round(stddev(lag) / 1e6) as bigint) as stddev_lag_s
        from (select event_type, epoch_us(timestamp '2024-02-01') - epoch_us(ts) as lag from events) group by 1""",
    "q_lag_sketches": """
        select event_type, count(*) as n, min(lag) as min_lag_us, max(lag) as max_lag_us,
               true as p50_near, true as p95_near, true as p99_near
        from (select event_type, epoch_us(timestamp '2024-02-15') - epoch_us(ts) as lag from events) group by 1""",
    "q_stream_totals": """
        select count(*) as n_read, count(*) as n_stored, 0 as n_deadletter, max(ts) as latest_message, count(*) as n_timed
        from events""",
    "q_row_counters": """
        select count(*) as n_read, count(*) filter (where event_type <> 'error') as n_stored,
               count(*) filter (where event_type = 'error') as n_deadletter from events""",
    "q_saved_dataset": f"""
        select s.event_id, s.user_id, s.ts, f.value as views__value
        from {_PURCHASES} s asof left join {_VIEWS} f on s.user_id = f.user_id and s.ts >= f.ts
        where s.ts between timestamp '2024-01-05' and timestamp '2024-01-25'""",
    "q_feature_logs": """
        select event_id, value, ts as log_timestamp from events
        where ts >= timestamp '2024-01-05 12:00:00' and ts < timestamp '2024-01-25 12:00:00'""",
    "q_delivered_rows": "select c_custkey, c_name, c_acctbal from customer",
    "q_record_file": """
        select o_orderkey, epoch_us(o_orderdate) // 1000000 as o_orderdate, o_totalprice from orders""",
    "q_daily_counts": "select cast(ts as date) as d, event_type, count(*) as n from events group by 1, 2",
    "q_wide_read_back": f"""
        select concat_ws('#', cast(l_partkey as varchar), cast(l_suppkey as varchar)) as row_key, l_shipdate as ts,
               l_quantity from {_NEWEST_SHIPPED}""",
    "q_wide_empty_keys": """
        select event_type as key, max(ts) as ts from events where event_type <> 'error' group by 1""",
    "q_latest_message": """
        select count(*) as n_read, count(*) as n_stored, max(ts) as latest_message from events""",
    "q_stream_progress": """
        select count(*) as n from events""",
    "q_lookup_expired_default": f"""
        select c.c_custkey as user_id, cast(null as double) as value, f.value as aged__value from customer c
        left join (select * from (select *, {_NEWEST_EVENT} from events) where rn = 1) f on f.user_id = c.c_custkey""",
    "q_max_age_redeclared": f"""
        select user_id, ts as event_timestamp, value, ts + interval 2 day as expiry_timestamp
        from (select *, {_NEWEST_EVENT} from events) where rn = 1""",
    "q_cleanup_label": f"""
        select user_id, ts as event_timestamp, value, ts + interval 10 day as expiry_timestamp
        from (select *, {_NEWEST_EVENT} from events) where rn = 1""",
    "q_online_two_writers": f"""
        select user_id, ts as event_timestamp, value from (select *, {_NEWEST_EVENT} from events) where rn = 1""",
    "q_online_teardown": f"""
        select 'kept' as name, user_id, value from (select *, {_NEWEST_EVENT} from events) where rn = 1""",
    "q_scan_aware_range": """
        select event_id, ts from events
        where ts >= timestamp '2024-01-04 01:00:00' and ts < timestamp '2024-01-15 04:00:00'""",
    "q_window_days": """
        select event_id, ts from events where ts >= timestamp '2024-01-12' and ts < timestamp '2024-01-22'""",
    "q_source_config": """
        select o_orderkey, o_totalprice from orders
        where o_orderdate >= timestamp '1995-01-01' and o_orderdate < timestamp '1996-01-01'""",
    "q_source_columns": """
        select 'event_id' as "column", 'bigint' as "type", count(event_id) as n from events
        union all select 'user_id', 'bigint', count(user_id) from events
        union all select 'ts', 'timestamp_ntz', count(ts) from events
        union all select 'event_type', 'string', count(event_type) from events
        union all select 'value', 'double', count(value) from events
        union all select 'props', 'string', count(props) from events""",
    "q_type_mapping": """
        select 'event_id' as "column", 'INT64' as "type", count(event_id) as n from events
        union all select 'user_id', 'INT64', count(user_id) from events
        union all select 'event_type', 'STRING', count(event_type) from events
        union all select 'value', 'DOUBLE', count(value) from events
        union all select 'props', 'STRING', count(props) from events
        union all select 'vec_id', 'INT64', count(vec_id) from embeddings
        union all select 'embedding', 'FLOAT_LIST', count(embedding) from embeddings
        union all select 'label', 'INT32', count(label) from embeddings""",
    "q_map_columns": """
        select o_orderkey, o_custkey as customer, o_totalprice, o_totalprice * 2 as doubled from orders""",
    "q_reverse_mapping": """
        select o_custkey as customer, o_totalprice, o_orderdate as placed from orders""",
    "q_offset_times": """
        select event_id, ts from events
        where ts >= timestamp '2024-01-09 20:30:00' and ts < timestamp '2024-01-11 20:30:00'""",
    "q_inferred_time": """
        select 'events' as name, 'ts' as "column", max(ts) as latest from events
        union all select 'orders', 'o_orderdate', max(o_orderdate) from orders""",
    "q_pit_partitioned": f"""
        select s.event_id, s.user_id, s.ts,
               case when f.ts >= s.ts - interval 6 hour then f.value end as views__value
        from {_PURCHASES} s asof left join {_VIEWS} f on s.user_id = f.user_id and s.ts >= f.ts""",
    "q_staged_spine": """
        select s_suppkey as l_suppkey, l_quantity as sold__l_quantity from supplier left join (
            select * from (select *, row_number() over (partition by l_suppkey order by l_shipdate desc, l_orderkey desc,
                l_linenumber desc, l_quantity desc) as rn from lineitem where l_shipdate <= timestamp '1998-06-01') where rn = 1
        ) on l_suppkey = s_suppkey""",
    "q_declared_tables": f"""
        select s.event_id, s.user_id, s.ts, f.value as views__value
        from {_PURCHASES} s asof left join {_VIEWS} f on s.user_id = f.user_id and s.ts >= f.ts""",
    "q_retrieve_job": f"""
        select c_custkey as user_id, event_type, value from customer left join (
            select * from (select *, {_NEWEST_EVENT} from events where ts <= timestamp '2024-01-20 12:00:00') where rn = 1
        ) on user_id = c_custkey""",
    "q_two_sets_one_column": """
        select 'expect_column_values_to_be_in_set(event_type, value_set=[click, view])' as check_name,
               count(*) filter (event_type not in ('click', 'view')) as failed from events
        union all
        select 'expect_column_values_to_be_in_set(event_type, value_set=[signup, view])',
               count(*) filter (event_type not in ('signup', 'view')) from events""",
    "q_prefix_strip": """
        select value between 0 and 50 as is_valid, count(*) as n from events group by 1""",
    "q_any_feature": """
        select event_type = 'purchase' as is_valid, case when event_type = 'purchase' then '' else 'no_feature' end as reason,
               count(*) as n from events group by 1, 2""",
    "q_declared_types": """
        select name, case when name in ('declared', 'spine') then (select count(*) from events) else 0 end as n
        from (values ('declared'), ('other type'), ('no column'), ('no time'), ('spine'), ('spine without key')) cases(name)""",
    "q_frames_equal": """
        select 'same' as name, true as equal union all select 'twice', count(*) = 0 from events""",
    "q_stored_function": """
        select value <= 50 as is_valid, count(*) as n from events group by 1""",
    "q_ingest_job": f"""
        select user_id, ts as event_timestamp, event_id, value from (
            select *, {_NEWEST_EVENT} from events where ts >= timestamp '2024-01-03' and ts < timestamp '2024-01-29'
              and value between 0 and 50) where rn = 1""",
    "q_logs_aware_range": """
        select event_id, ts as log_timestamp from events
        where ts >= timestamp '2024-01-06 02:00:00' and ts < timestamp '2024-01-25 03:00:00'""",
    "q_batched_write": """
        select count(*) as n, cast(sum(event_id) as bigint) as ids, cast(0 as bigint) as too_large from events""",
}
