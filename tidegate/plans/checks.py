"""For each registered query, independent SQL for DuckDB over the same tables."""

from __future__ import annotations

from tidegate import fixtures as fx
from tidegate.plans.queries import END, KNOWN_ASSETS, LOADED, MID_MONTH, START

DUCK_SLOTS = {
    "{text}": "varchar",
    "{k}": "json_extract_string(props, '$.k')",
    "{time}": "strftime(device_ts, '%Y-%m-%dT%H:%M:%S.%fZ')",
}


def _text(instant: str) -> str:
    return f"strftime({instant}, '%Y-%m-%d %H:%M:%S.%f')"


# Bus records and strict bronze of both fixtures.
_HEAD = """
bronze as (
  select body, rowhash, enq, jb,
         (jb->>'$.deviceId') as device, (jb->>'$.templateName') as template,
         (jb->>'$.templateId') as template_id,
         try_strptime(jb->>'$.enqueuedTime', '%Y-%m-%dT%H:%M:%S.%fZ') as sent
  from (select body, sha256(body) as rowhash, min(enq) as enq,
               case when json_valid(body) then body end as jb
        from raw where body is not null group by body) d)
"""

EVENTS = (
    f"with fields as ({fx.fill(fx.EVENT_FIELDS, DUCK_SLOTS)}),\n"
    "raw as (select body, unnest(case when value < 10 then [ts, ts + interval 1 hour] else [ts] end) as enq\n"
    f"        from (select *, {fx.fill(fx.EVENT_BODY, DUCK_SLOTS)} as body from fields) f),\n{_HEAD}"
)
LINES = (
    f"with fields as ({fx.fill(fx.LINE_FIELDS, DUCK_SLOTS)}),\n"
    f"raw as (select {fx.fill(fx.LINE_BODY, DUCK_SLOTS)} as body, l_shipdate as enq from fields),\n{_HEAD}"
)

RAW_ROWS = f"select body, {_text('enq')} as \"enqueuedTime\" from raw"

BRONZE_ROWS = f"""
select {_text('enq')} as "enqueuedTime", body, template_id as "templateId", template as "templateName",
       device as "deviceId", {_text('sent')} as "deviceEnqueuedTime", rowhash,
       cast(year(sent) as int) as "yearDevice", cast(month(sent) as int) as "monthDevice"
from bronze
"""

SILVER_COMMON = f"""
       {_text('enq')} as "Eventhub_enqueuedTime", {_text('sent')} as "Device_EnqueuedTime",
       {_text("timezone('America/Los_Angeles', timezone('UTC', sent))")} as "Device_EnqueuedTime_PST",
       strftime(sent, '%Y-%m-%d') as "Device_Date",
       cast(year(sent) as int) as "yearDevice", cast(month(sent) as int) as "monthDevice", body,
       try_cast(split_part(device, '-', 1) as int) as stationid,
       device as "deviceId", template as "templateName", rowhash
"""

HAS_TELEMETRY = "json_type(jb, '$.telemetry') = 'OBJECT'"
EVENT_TELEMETRY = (
    "try_cast(jb->>'$.telemetry.k' as int) as k, try_cast(jb->>'$.telemetry.value' as double) as value"
)
LINE_TELEMETRY = (
    "cast(cast(jb->>'$.telemetry.discount' as float) as double) as discount, "
    "cast(jb->>'$.telemetry.extendedprice' as double) as extendedprice, "
    "cast(jb->>'$.telemetry.linenumber' as int) as linenumber, "
    "cast(jb->>'$.telemetry.returned' as boolean) as returned"
)


def _names(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _silver(base: str, where: str, telemetry: str = "") -> str:
    columns = f"{SILVER_COMMON}, {telemetry}" if telemetry else SILVER_COMMON
    return f"{base} select {columns} from bronze where {where} and {HAS_TELEMETRY}"


VIEW = _silver(EVENTS, "template = 'view'", EVENT_TELEMETRY)
STRICT = EVENTS + BRONZE_ROWS
LINE_COPIES = f"{LINES} select rowhash, count(*) as copies from bronze group by rowhash"

BATCHES = f"""
{EVENTS}, first_half as (select * from raw where enq <= timestamp '{MID_MONTH}'),
found as (select count(distinct body) as n from first_half),
metrics as (
  select 'bronze' as target, cast(0 as bigint) as batch_id, count(*) as rows_in,
         count(distinct body) as inserted, cast(0 as bigint) as matched_keys,
         count(*) - count(body) as quarantined
  from first_half
  union all
  select 'bronze', 1, count(*), count(distinct body) - max(found.n), max(found.n), count(*) - count(body)
  from raw, found)
"""

REASON = f"""case when body is null then 'null_body' when template is null then 'no_template'
       when template not in ({_names(KNOWN_ASSETS)}) then 'unknown_template' else 'no_telemetry' end"""

PLACES = f"""{EVENTS}
    select rowhash, case when coalesce(template in ({_names(fx.EVENT_ASSETS)}) and {HAS_TELEMETRY}, false) then 'silver'
           else {REASON.replace(_names(KNOWN_ASSETS), _names(fx.EVENT_ASSETS))} end as place
    from bronze"""

CHECKS: dict[str, str] = {
    "s1_source_replay": f"{EVENTS} {RAW_ROWS}",
    "s2_start_position": f"{EVENTS} {RAW_ROWS} where enq >= timestamp '{START}'",
    "s3_end_position": f"{EVENTS} {RAW_ROWS} where enq between timestamp '{START}' and timestamp '{END}'",
    "s3_end_position_stream": f"{EVENTS} {RAW_ROWS} where enq between timestamp '{START}' and timestamp '{END}'",
    "k4_compaction": f"""{EVENTS}
        select cast(year(sent) as int) as "yearDevice", cast(month(sent) as int) as "monthDevice", rowhash,
               template as "templateName", cast(1 as bigint) as files from bronze""",
    "s4_bronze_as_stream": STRICT,
    "s5_template_fields": """
        select distinct event_type as asset, unnest(json_keys(props)) as name, 'integer' as type,
               cast(null as varchar) as error from events
        union all
        select distinct event_type, 'value', 'double', cast(null as varchar) from events
        union all
        select distinct event_type, 'props', 'string', 'unknown type string' from events""",
    "f1_f2_header_parse": f"""{EVENTS}
        select r.body, {_text('r.enq')} as "enqueuedTime", device as "deviceId", template as "templateName",
               template_id as "templateId", {_text('sent')} as "deviceEnqueuedTime"
        from raw r left join bronze b on r.body = b.body""",
    "f4_rowhash": f"{EVENTS} select body, sha256(body) as rowhash from raw",
    "f4_rowhash_whole_texts": "select doc_id, sha256(text) as rowhash from documents",
    "f5_partition_columns": f"""{LINES}
        select b.rowhash, cast(year(sent) as int) as "yearDevice", cast(month(sent) as int) as "monthDevice"
        from raw r join bronze b on r.body = b.body""",
    "f6_load_time": f"{EVENTS} select rowhash, '{LOADED}.000000' as \"loadDatetime\" from bronze",
    "f7_f9_device_time": f"""{EVENTS}
        select rowhash, {_text('sent')} as sent, strftime(sent, '%Y-%m-%d') as sent_date
        from bronze""",
    "f8_pacific_time": f"""{EVENTS}
        select rowhash, {_text('sent')} as utc_time,
               {_text("timezone('America/Los_Angeles', timezone('UTC', sent))")} as pacific_time
        from bronze""",
    "f10_station_id": f"""{EVENTS}
        select rowhash, device as "deviceId", try_cast(split_part(device, '-', 1) as int) as stationid
        from bronze""",
    "f3_envelope_fields": f"""{LINES}
        select rowhash, (jb->>'$.applicationId') as "applicationId", (jb->>'$.component') as component,
               (jb->>'$.enrichments') as enrichments, (jb->>'$.messageSource') as "messageSource",
               (jb->>'$.module') as module, (jb->>'$.schema') as schema, template_id as "templateId",
               (jb->>'$.enqueuedTime') as "enqueuedTime", device as "deviceId", template as "templateName",
               (jb->'$.messageProperties'->>'iothub-creation-time-utc') as created,
               case when {HAS_TELEMETRY} then 0 else 1 end as flagged
        from bronze""",
    "p5_template_filter": f"{EVENTS} select rowhash, body from bronze where template = 'view'",
    "p6_case_insensitive": f"{EVENTS} select rowhash, device as \"deviceId\" from bronze where template = 'view'",
    "p7_flagged": f"""{EVENTS}
        select rowhash, case when coalesce({HAS_TELEMETRY}, false) then 0 else 1 end as flagged from bronze""",
    **{
        f"f3_p3_silver_{asset}": _silver(EVENTS, f"template = '{asset}'", EVENT_TELEMETRY)
        for asset in fx.EVENT_ASSETS
    },
    "f3_p3_silver_all_types": _silver(
        LINES, f"template in ({_names(fx.LINE_ASSETS)})", LINE_TELEMETRY
    ),
    "j1_merge_compat": f"""{EVENTS}, first_half as (select * from raw where enq <= timestamp '{MID_MONTH}')
        select sha256(body) as rowhash, count(*) as copies
        from (select body from first_half union all
              select body from raw where body is null
                 or body not in (select body from first_half where body is not null)) t
        group by 1""",
    "j1_merge_strict": STRICT,
    "j1_merge_pruned_equals_plain": LINE_COPIES,
    "j1_merge_large_batch": LINE_COPIES,
    "j1_merge_time_of_day": f"""{EVENTS}
        select distinct sha256(regexp_replace(body, '"enqueuedTime":"[0-9-]+T', '"enqueuedTime":"')) as rowhash,
               cast(1 as bigint) as copies, false as dated
        from raw where body is not null""",
    "j1_merge_undated": "select distinct sha256(text) as rowhash, cast(1 as bigint) as copies from documents",
    "j1_merge_undated_again": """
        with base as (select distinct sha256(text) as rowhash from documents where text is not null),
        chosen as (select distinct text from documents where starts_with(sha256(text), '0')),
        batch as (select sha256(text) as rowhash from chosen union select sha256(text || ' again') from chosen)
        select rowhash, cast(1 as bigint) as copies,
               (select count(*) from batch join base using (rowhash)) as known_in_batch
        from (select rowhash from base union select rowhash from batch) r""",
    "k2_bootstrap_then_merge": _silver(EVENTS, f"template in ({_names(fx.EVENT_ASSETS)})"),
    "t6_fanout_all_templates": _silver(EVENTS, f"template in ({_names(fx.EVENT_ASSETS)})"),
    "t6_fanout_rejects": f"""{EVENTS}
        select rowhash, {REASON} as reason from bronze
        where not coalesce(template in ({_names(KNOWN_ASSETS)}) and {HAS_TELEMETRY}, false)""",
    "t6_fanout_single_stream": _silver(LINES, f"template in ({_names(fx.LINE_ASSETS)})"),
    "t5_time_boxed": f"{EVENTS} select rowhash, cast(1 as bigint) as copies from bronze",
    # The first batch holds what was enqueued from the middle of the month on, so its
    # copy of a message is the one that is kept.
    "t8_late_rows_kept": STRICT.replace(
        "min(enq) as enq",
        f"coalesce(min(enq) filter (enq >= timestamp '{MID_MONTH}'), min(enq)) as enq",
    ),
    "t8_recent_copies": f"""{EVENTS}
        select rowhash, template as "templateName", cast(year(sent) as int) as "yearDevice", cast(month(sent) as int) as "monthDevice",
               cast(0 as bigint) as known,
               (select count(*) + count(*) filter (enq = timestamp '{MID_MONTH}') from raw where body is null) as keyless
        from bronze""",
    "a1_batch_metrics": f"{BATCHES} select * from metrics",
    "a1_stream_progress": f"""{EVENTS}
        select 'kept' as query, cast(0 as bigint) as batch_id, count(*) filter (enq <= timestamp '{MID_MONTH}') as rows_in,
               true as timed, true as marked from raw
        union all
        select 'kept', 1, count(*) filter (enq >= timestamp '{MID_MONTH}'), true, true from raw""",
    "l2_last_batch": f"{BATCHES} select * from metrics order by batch_id desc limit 1",
    "c1_table_over_existing_folder": f"{EVENTS} select rowhash, cast(1 as bigint) as copies from bronze",
    "c2_list_tables": "select distinct 'silver_' || event_type as \"tableName\" from events",
    "d5_reset_dry_run": f"""{EVENTS}
        select 'silver_' || template as "tableName", count(*) as row_count from bronze
        where template in ({_names(fx.EVENT_ASSETS)}) and {HAS_TELEMETRY} group by 1""",
    "d1_quarantine": f"""{EVENTS},
        everything as (select body, rowhash, enq, jb, device, template, template_id, sent from bronze
                       union all
                       select body, null, enq, null, null, null, null, null from raw where body is null)
        select {_text('enq')} as "enqueuedTime", body, template_id as "templateId", template as "templateName",
               device as "deviceId", {_text('sent')} as "deviceEnqueuedTime", rowhash,
               cast(year(sent) as int) as "yearDevice", cast(month(sent) as int) as "monthDevice",
               {REASON} as reason
        from everything
        where not coalesce(template in ({_names(KNOWN_ASSETS)}) and {HAS_TELEMETRY}, false)""",
    "d8_conservation": f"""{EVENTS},
        received as (select b.template, b.sent, b.rowhash, r.body from raw r left join bronze b on r.body = b.body),
        places as (
          select template, year(sent) as y, month(sent) as m, count(*) as received,
                 count(distinct rowhash) as bronze, count(rowhash) - count(distinct rowhash) as copies,
                 count(*) filter (body is null) as bodiless
          from received group by 1, 2, 3),
        refined as (
          select template, year(sent) as y, month(sent) as m,
                 count(*) filter (coalesce(template in ({_names(KNOWN_ASSETS)}) and {HAS_TELEMETRY}, false)) as silver,
                 count(*) as n
          from bronze group by 1, 2, 3)
        select p.template as "templateName", cast(p.y as int) as "yearDevice", cast(p.m as int) as "monthDevice", received, bronze,
               copies, bodiless, coalesce(silver, 0) as silver, coalesce(n - silver, 0) as rejected, true as balanced
        from places p left join refined r on p.template is not distinct from r.template
             and p.y is not distinct from r.y and p.m is not distinct from r.m""",
    "d1_release": PLACES,
    "t6_template_joins_later": PLACES,
    "d2_orphans": f"""{EVENTS}
        select template as "templateName", count(*) as messages from bronze
        where template is null or template not in ({_names(KNOWN_ASSETS)}) group by 1""",
    "d3_redelivery": f"""{EVENTS},
        copies as (select body, count(*) as n from raw where body is not null group by body)
        select template as "templateName", cast(sum(n) as bigint) as deliveries, count(*) as messages,
               count(*) filter (n > 1) as redelivered_messages, max(n) as max_copies,
               cast(sum(n) - count(*) as double) / cast(sum(n) as double) as redelivery_rate
        from copies join bronze using (body) group by 1""",
    "d3_summaries": f"""{EVENTS}
        select jb->>'$.templateName' as "templateName", count(*) as deliveries,
               true as devices_within, true as delay_within
        from (select case when json_valid(body) then body end as jb from raw) d group by 1""",
    "c3_c4_reset": f"""{EVENTS}
        select template as "templateName", count(*) as messages,
               (select count(distinct event_type) from events) as tables_dropped,
               cast(0 as bigint) as tables_left, cast(0 as bigint) as folders_left
        from bronze group by 1""",
    "d3_copies_whole_texts": "select sha256(text) as rowhash, count(*) as copies from documents group by 1",
    "d6_drift": f"""{EVENTS},
        keys as (select template, unnest(json_keys(jb, '$.telemetry')) as field from bronze
                 where template in ({_names(fx.EVENT_ASSETS)}) and {HAS_TELEMETRY})
        select template as "templateName", field, count(*) as messages from keys
        where field not in ('value', 'k') group by 1, 2""",
    "d6_mistyped": f"""{EVENTS}
        select template as "templateName", 'value' as field, count(*) as messages from bronze
        where template in ({_names(fx.EVENT_ASSETS)}) and json_type(jb, '$.telemetry.value') = 'VARCHAR' group by 1""",
    "d6_typed_drift": f"""{EVENTS},
        found as (select template, unnest(json_keys(jb, '$.telemetry')) as path, jb from bronze
                   where template in ({_names(fx.EVENT_ASSETS)}) and {HAS_TELEMETRY}),
        typed as (select template, path, json_type(jb, '$.telemetry.' || path) as t from found)
        select template as "templateName", path,
               case when t in ('UBIGINT', 'BIGINT') then 'integer' when t = 'DOUBLE' then 'double' else 'string' end as type,
               count(*) as messages
        from typed
        where not ((path = 'value' and t in ('UBIGINT', 'BIGINT', 'DOUBLE')) or (path = 'k' and t in ('UBIGINT', 'BIGINT')))
        group by 1, 2, 3""",
    "d7_compiled_templates": f"""{EVENTS},
        new_fields as (select template, unnest(json_keys(jb, '$.telemetry')) as name from bronze
                       where template in ({_names(fx.EVENT_ASSETS)}) and {HAS_TELEMETRY}),
        every as (select distinct template, name from new_fields
                   union select unnest([{_names(fx.EVENT_ASSETS)}]), unnest(['k', 'k', 'k', 'k', 'k'])
                   union select unnest([{_names(fx.EVENT_ASSETS)}]), unnest(['value', 'value', 'value', 'value', 'value']))
        select 'new ' || template as asset,
               cast(row_number() over (partition by template order by name) - 1 as int) as position, name, name as column,
               case name when 'value' then 'double' else 'int' end as type, cast(null as varchar) as error
        from every
        union all
        select distinct event_type, cast(null as int), null, null, null, 'props: unknown type string' from events""",
    "d8_rebuild": _silver(EVENTS, f"template in ({_names(fx.EVENT_ASSETS)})"),
}
