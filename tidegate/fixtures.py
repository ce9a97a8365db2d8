"""Device envelopes derived from the given tables, for queries and tests.

``events`` become messages of five templates (one per event type) that contain
every kind of defect the operators must handle; the reading ``k`` of an event
decides which.  ``lineitem`` becomes messages of three templates with the full
envelope and all four telemetry types, spread over seven years of device time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.sources.templates import Template, template

EVENT_ASSETS = ("click", "error", "purchase", "signup", "view")
LINE_ASSETS = ("Line A", "Line N", "Line R")

# The message texts below are shared with the SQL checks: they hold only what both
# engines spell alike, and the slots {text}, {k} and {time} for what they do not.
EVENT_FIELDS = """
select event_type, ts, value, k,
       cast(user_id as {text}) as u, cast(value as {text}) as v, cast(k as {text}) as kt,
       {time} as t
from (select *, case when day(ts) > 15 then ts + interval 6 months else ts end as device_ts
      from (select *, cast({k} as int) as k from events) a) b
"""

EVENT_BODY = """
case
 when k = 13 then cast(null as {text})
 when k = 29 then '{"deviceId":'
 when k = 41 then concat('{"deviceId":"',u,'-',event_type,'","templateName":"',event_type,
                         '","enqueuedTime":"',t,'"}')
 when k = 53 then concat('{"deviceId":"',u,'-',event_type,'","templateName":"',event_type,
                         '","enqueuedTime":"',t,'","telemetry":{}}')
 when k = 67 then concat('{"deviceId":"dev-',u,'","templateName":"',event_type,
                         '","enqueuedTime":"',t,'","telemetry":{"value":',v,',"k":',kt,'}}')
 when k = 71 then concat('{"deviceId":"',u,'-',event_type,'","templateName":"',event_type,
                         '","enqueuedTime":"soon","telemetry":{"value":',v,',"k":',kt,'}}')
 when k = 79 then concat('{"deviceId":"',u,'-',event_type,'","templateName":"',event_type,
                         '","enqueuedTime":"',t,'","telemetry":{"value":"bad","k":',kt,'}}')
 when k = 83 then concat('{"deviceId":"',u,'-',event_type,'","enqueuedTime":"',t,
                         '","telemetry":{"value":',v,',"k":',kt,'}}')
 when k = 89 then concat('{"deviceId":"',u,'-',event_type,'","templateName":"',event_type,
                         '","enqueuedTime":"',t,'","telemetry":{"value":',v,',"k":',kt,',"rssi":',kt,'}}')
 when k = 97 then concat('{"deviceId":"',u,'-',event_type,'","templateName":"old-',event_type,
                         '","enqueuedTime":"',t,'","telemetry":{"value":',v,',"k":',kt,'}}')
 else concat('{"deviceId":"',u,'-',event_type,'","templateName":"',event_type,
             '","enqueuedTime":"',t,'","telemetry":{"value":',v,',"k":',kt,'}}') end
"""

LINE_FIELDS = """
select *, {time} as t, cast(l_orderkey as {text}) as o, cast(l_partkey as {text}) as p,
       cast(l_suppkey as {text}) as s, cast(l_linenumber as {text}) as n,
       cast(l_discount as {text}) as d, cast(l_extendedprice as {text}) as e,
       cast(l_returnflag = 'R' as {text}) as r
from (select *, l_shipdate as device_ts from lineitem) a
"""

LINE_BODY = """
concat('{"applicationId":"orders","component":"part-',p,'","enrichments":{"order":"',o,'","status":"',l_linestatus,
       '"},"messageProperties":{"iothub-creation-time-utc":"',t,'"},"messageSource":"telemetry","module":null,',
       '"schema":"default@v1","templateId":"line-',l_returnflag,'","enqueuedTime":"',t,'","deviceId":"',s,'-',p,
       '","templateName":"Line ',l_returnflag,'","telemetry":{"discount":',d,',"extendedprice":',e,
       ',"linenumber":',n,',"returned":',r,'}}')
"""

SPARK_SLOTS = {
    "{text}": "string",
    "{k}": "get_json_object(props, '$.k')",
    "{time}": "date_format(device_ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'\")",
}


def fill(text: str, slots: dict[str, str]) -> str:
    for slot, value in slots.items():
        text = text.replace(slot, value)
    return text


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Use all cores on a table that is one small file; larger tables stay as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def records(fields: DataFrame, body: str, times: str) -> DataFrame:
    """One bus record per enqueued time.

    Bodies come out of a generator, so no filter on them is moved into the text
    building, just as none could be with bodies read from files.
    """
    body = fill(body, SPARK_SLOTS)
    return fields.selectExpr(
        f"inline(transform({times}, at -> struct({body} as body, cast(at as timestamp) as enqueuedTime)))"
    )


def event_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bus records of all events; readings below 10 are delivered again an hour later."""
    fields = spark.sql(
        fill(EVENT_FIELDS.replace("from events)", "from {events})"), SPARK_SLOTS),
        events=spread(table(spark, sf_dir, "events").drop("event_id")),
    )
    times = "case when value < 10 then array(ts, ts + interval 1 hour) else array(ts) end"
    return records(fields, EVENT_BODY, times)


def line_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bus records of all line items, enqueued at their device time."""
    fields = spark.sql(
        fill(LINE_FIELDS.replace("from lineitem)", "from {lineitem})"), SPARK_SLOTS),
        lineitem=spread(table(spark, sf_dir, "lineitem").drop("l_tax", "l_quantity")),
    )
    return records(fields, LINE_BODY, "array(l_shipdate)")


def document_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents as message bodies: no JSON, no device time, many exact copies."""
    return table(spark, sf_dir, "documents").select(
        F.col("text").alias("body"), F.lit("2024-01-01").cast("timestamp").alias("enqueuedTime")
    )


def event_templates() -> dict[str, Template]:
    return {a: template(a, {"value": "double", "k": "integer"}) for a in EVENT_ASSETS}


def line_templates() -> dict[str, Template]:
    fields = {
        "extendedprice": "double",
        "linenumber": "integer",
        "returned": "boolean",
        "discount": "float",
    }
    return {a: template(a, fields) for a in LINE_ASSETS}
