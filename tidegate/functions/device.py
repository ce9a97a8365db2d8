"""Column expressions on device messages.

All of them are built-ins, so they stay inside the JVM.  Text that comes from a
device is only converted with ``try_*`` forms: with ANSI on (the Spark 4
default) a plain cast of one bad reading would fail the whole stream.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidegate.schemas import HEADER

# Fixed value: local time of the devices, with daylight saving.
DEVICE_ZONE = "America/Los_Angeles"

# A text that starts with a year, which has at least four digits.
DATED = r"^[^0-9:T]*[0-9]{4}"


def row_hash(body: Column) -> Column:
    """Message identity: lower-case hex SHA-256 of the body text, null for null."""
    return F.sha2(body, 256)


def header(body: Column) -> Column:
    """The header fields of a message, parsed in one pass."""
    return F.from_json(body, HEADER)


def utc_time(text: Column) -> Column:
    """Instant written in device text, null where it is not a date with or without a time.

    A time of day alone is no instant: Spark would take it as one of the day of the run,
    and a message must get the same time, and the same partition, in every run.
    """
    return F.when(text.rlike(DATED), F.try_to_timestamp(text))


def header_time(text: Column) -> Column:
    """Device time of the header: a date and time, or a number of seconds since 1970."""
    micros = F.try_multiply(text.try_cast("long"), F.lit(1_000_000).cast("long"))
    return F.when(text.rlike(r"^-?[0-9]{7,}$"), F.timestamp_micros(micros)).otherwise(utc_time(text))


def local_time(instant: Column, zone: str = DEVICE_ZONE) -> Column:
    """Wall-clock time at the device for a UTC instant."""
    return F.from_utc_timestamp(instant, zone)


def utc_date(instant: Column) -> Column:
    """UTC date of an instant (not the date as written, when an offset is given)."""
    return F.to_date(instant)


def station_id(device_id: Column) -> Column:
    """Station number in front of the first hyphen, null where it is no number."""
    return F.substring_index(device_id, "-", 1).try_cast("int")


def flagged(telemetry: Column) -> Column:
    """1 for a message without a telemetry object, else 0.

    ``from_json`` yields a struct of nulls, not null, for most unreadable bodies,
    so the state of the telemetry field alone decides.
    """
    return F.when(telemetry.isNull(), 1).otherwise(0)
