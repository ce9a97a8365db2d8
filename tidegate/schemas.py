"""Schemas of the raw bus record, the JSON envelope and both layers."""

from __future__ import annotations

from pyspark.sql import types as T

# Column and field names, field order and types are part of the
# data contract with the devices and with readers of both layers.
PARTITION_COLUMNS = ("yearDevice", "monthDevice")

RAW = T.StructType(
    [
        T.StructField("body", T.StringType()),
        T.StructField("enqueuedTime", T.TimestampType()),
    ]
)

HEADER = T.StructType(
    [
        T.StructField("enqueuedTime", T.StringType()),
        T.StructField("deviceId", T.StringType()),
        T.StructField("templateName", T.StringType()),
        T.StructField("templateId", T.StringType()),
    ]
)

BRONZE = T.StructType(
    [
        T.StructField("enqueuedTime", T.TimestampType()),
        T.StructField("body", T.StringType()),
        T.StructField("templateId", T.StringType()),
        T.StructField("templateName", T.StringType()),
        T.StructField("deviceId", T.StringType()),
        T.StructField("deviceEnqueuedTime", T.TimestampType()),
        T.StructField("rowhash", T.StringType()),
        T.StructField("loadDatetime", T.TimestampType()),
        T.StructField("yearDevice", T.IntegerType()),
        T.StructField("monthDevice", T.IntegerType()),
    ]
)

MESSAGE_PROPERTIES = T.StructType([T.StructField("iothub-creation-time-utc", T.StringType())])

ENVELOPE_FIELDS = (
    T.StructField("applicationId", T.StringType()),
    T.StructField("component", T.StringType()),
    T.StructField("enrichments", T.StringType()),
    T.StructField("messageProperties", MESSAGE_PROPERTIES),
    T.StructField("messageSource", T.StringType()),
    T.StructField("module", T.StringType()),
    T.StructField("schema", T.StringType()),
    T.StructField("templateId", T.StringType()),
    T.StructField("enqueuedTime", T.StringType()),
    T.StructField("deviceId", T.StringType()),
    T.StructField("templateName", T.StringType()),
)

SILVER_HEAD = (
    T.StructField("Eventhub_enqueuedTime", T.TimestampType()),
    T.StructField("Device_EnqueuedTime", T.TimestampType()),
    T.StructField("Device_EnqueuedTime_PST", T.TimestampType()),
    T.StructField("Device_Date", T.DateType()),
    T.StructField("yearDevice", T.IntegerType()),
    T.StructField("monthDevice", T.IntegerType()),
    T.StructField("body", T.StringType()),
    T.StructField("stationid", T.IntegerType()),
    T.StructField("deviceId", T.StringType()),
    T.StructField("templateName", T.StringType()),
)

SILVER_TAIL = (
    T.StructField("loaddatetime", T.TimestampType()),
    T.StructField("rowhash", T.StringType()),
)

TELEMETRY_TYPES = {
    "boolean": T.BooleanType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "integer": T.IntegerType(),
}


def envelope(telemetry: T.StructType) -> T.StructType:
    """The whole JSON envelope around one template's telemetry struct."""
    return T.StructType([*ENVELOPE_FIELDS, T.StructField("telemetry", telemetry)])


def silver_schema(telemetry: T.StructType) -> T.StructType:
    """Schema of a silver dataset whose telemetry columns are ``telemetry``."""
    return T.StructType([*SILVER_HEAD, *telemetry.fields, *SILVER_TAIL])
