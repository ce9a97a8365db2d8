"""Silver: bronze messages of one device template to typed rows."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate import schemas
from tidegate.functions import flagged, local_time, station_id, utc_date, utc_time
from tidegate.sources.templates import Template


def of_template(bronze: DataFrame, asset: str) -> DataFrame:
    """Messages of one template; the name is matched exactly, including case."""
    return bronze.where(F.col("templateName") == F.lit(asset))


def parse_envelope(bronze: DataFrame, template: Template) -> DataFrame:
    """Add the whole parsed envelope as ``message`` and the ``flagged`` column."""
    parsed = F.from_json("body", schemas.envelope(template.json_schema()))
    return bronze.withColumn("message", parsed).withColumn(
        "flagged", flagged(F.col("message.telemetry"))
    )


def _well_formed(body: Column, template: Template) -> Column:
    """The parsed message in an array of one, or an empty array if flagged.

    Only the two envelope fields silver reads are parsed.  Exploding this array
    parses each body once; a filter above a parse would be pushed below it and
    parse every body a second time.
    """
    needed = T.StructType(
        [
            T.StructField("enqueuedTime", T.StringType()),
            T.StructField("telemetry", template.json_schema()),
        ]
    )
    return F.filter(F.array(F.from_json(body, needed)), lambda m: flagged(m.telemetry) == 0)


def to_silver(bronze: DataFrame, template: Template, assets: Sequence[str] = ()) -> DataFrame:
    """Well-formed messages of one template with typed telemetry columns.

    ``assets`` names templates with the same fields, whose messages are taken in the same pass.
    """
    sent = utc_time(F.col("message.enqueuedTime"))
    telemetry = [
        F.col("message.telemetry").getField(name).alias(column)
        for name, column, _ in template.columns
    ]
    return (
        (bronze.where(F.col("templateName").isin(*assets)) if assets else of_template(bronze, template.asset))
        .withColumn("message", F.explode(_well_formed(F.col("body"), template)))
        .withColumn("sent", sent)
        .select(
            F.col("enqueuedTime").cast("timestamp").alias("Eventhub_enqueuedTime"),
            F.col("sent").alias("Device_EnqueuedTime"),
            local_time(F.col("sent")).alias("Device_EnqueuedTime_PST"),
            utc_date(F.col("sent")).alias("Device_Date"),
            "yearDevice",
            "monthDevice",
            "body",
            station_id(F.col("deviceId")).alias("stationid"),
            "deviceId",
            "templateName",
            *telemetry,
            F.col("loadDatetime").alias("loaddatetime"),
            "rowhash",
        )
    )


def silver_of_all(bronze: DataFrame, templates: Iterable[Template]) -> DataFrame:
    """Silver of several templates, with the columns of each, from one pass over bronze for all that have the same fields."""
    alike: dict[tuple, list[Template]] = {}
    for t in templates:
        alike.setdefault(tuple((name, column, kind.simpleString()) for name, column, kind in t.columns), []).append(t)
    parts = (to_silver(bronze, group[0], [t.asset for t in group]) for group in alike.values())
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
