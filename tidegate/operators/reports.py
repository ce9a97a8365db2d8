"""Upkeep reports over bronze: orphan templates, redelivery, drift and wrong types.

Each counts with partial aggregation before its shuffle, so one template, message
or field with a large share of all rows reaches the shuffle as a few rows per task.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate import schemas
from tidegate.operators.quarantine import telemetry_text
from tidegate.sources.templates import Template


def orphans(bronze: DataFrame, assets: Iterable[str]) -> DataFrame:
    """Messages per template name that no known template claims (null: no name)."""
    known = sorted(assets)
    claimed = F.col("templateName").isin(known) if known else F.lit(False)
    return (
        bronze.where(F.col("body").isNotNull() & ~F.coalesce(claimed, F.lit(False)))
        .groupBy("templateName")
        .agg(F.count(F.lit(1)).alias("messages"))
    )


def _deliveries(received: DataFrame) -> DataFrame:
    """Deliveries per message; the hash is shuffled as 32 bytes, not as 64 characters."""
    return (
        received.where(F.col("rowhash").isNotNull())
        .groupBy("templateName", F.unhex("rowhash").alias("hash"))
        .agg(F.count(F.lit(1)).alias("copies"))
    )


def copies(received: DataFrame) -> DataFrame:
    """Deliveries per message, from the rows as received (before the merge)."""
    return _deliveries(received).select(
        "templateName", F.lower(F.hex("hash")).alias("rowhash"), "copies"
    )


def redelivery(received: DataFrame) -> DataFrame:
    """Deliveries, messages and share of redeliveries per template."""
    return (
        _deliveries(received)
        .groupBy("templateName")
        .agg(
            F.sum("copies").alias("deliveries"),
            F.count(F.lit(1)).alias("messages"),
            F.count_if(F.col("copies") > 1).alias("redelivered_messages"),
            F.max("copies").alias("max_copies"),
        )
        .withColumn(
            "redelivery_rate",
            (F.col("deliveries") - F.col("messages")) / F.col("deliveries"),
        )
    )


def drift(bronze: DataFrame, templates: Iterable[Template]) -> DataFrame:
    """Telemetry fields that messages carry but their template lacks, with counts.

    The known names of a template are subtracted inside the row, so only unknown
    fields are exploded and counted.  The templates, one row each, are broadcast.
    """
    templates = sorted(templates, key=lambda t: t.asset)
    if not templates:
        return bronze.sparkSession.createDataFrame(
            [], "templateName string, field string, messages bigint"
        )
    known = bronze.sparkSession.createDataFrame(
        [(t.asset, [name for name, _, _ in t.columns]) for t in templates],
        "templateName string, known array<string>",
    )
    unknown = F.array_except(F.map_keys(telemetry_text(F.col("body"))), F.col("known"))
    return (
        bronze.where(F.col("templateName").isin([t.asset for t in templates]))
        .select("templateName", "body")
        .join(F.broadcast(known), "templateName")
        .select("templateName", F.explode(unknown).alias("field"))
        .groupBy("templateName", "field")
        .agg(F.count(F.lit(1)).alias("messages"))
    )


def mistyped(bronze: DataFrame, templates: Iterable[Template]) -> DataFrame:
    """Fields whose reading did not fit the type in their template, with counts.

    Such a reading is null in silver, like one that was not sent.  All templates share
    one pass; those with the same fields share a parse.
    """
    alike: dict[str, list[Template]] = {}
    for t in sorted(templates, key=lambda t: t.asset):
        alike.setdefault(t.json_schema().json(), []).append(t)
    if not alike:
        return bronze.sparkSession.createDataFrame([], "templateName string, field string, messages bigint")
    lost = None
    for same in alike.values():
        found = _lost_fields(same[0])
        named = F.col("templateName").isin([t.asset for t in same])
        lost = F.when(named, found) if lost is None else lost.when(named, found)
    assets = [t.asset for same in alike.values() for t in same]
    return (
        bronze.where(F.col("templateName").isin(assets))
        .select("templateName", "body", telemetry_text(F.col("body")).alias("sent"))
        .select("templateName", F.explode(lost).alias("field"))
        .groupBy("templateName", "field")
        .agg(F.count(F.lit(1)).alias("messages"))
    )


def _lost_fields(template: Template) -> Column:
    """Names of the fields that were sent but are null when parsed; the body is parsed once."""
    typed = F.from_json("body", T.StructType([T.StructField("telemetry", template.json_schema())]))

    def names(parsed: Column) -> Column:
        nulls = [
            F.when(F.col("sent").getItem(name).isNotNull() & parsed.getField(name).isNull(), F.lit(name))
            for name, _, _ in template.columns
        ]
        return F.array_compact(F.array(*nulls))

    return F.transform(F.array(typed.getField("telemetry")), names).getItem(0)


# Types of a reading that a column of a template's type holds without loss.
FITS = {"boolean": ("boolean",), "integer": ("integer",), "float": ("integer", "double"), "double": ("integer", "double")}


def _kind(value: Column) -> Column:
    """JSON type of a variant: integer, double, boolean, string, object, array or null."""
    name = F.schema_of_variant(value)
    return (
        F.when(value.isNull() | (name == "VOID"), "null")
        .when(name.startswith("OBJECT"), "object")
        .when(name.startswith("ARRAY"), "array")
        .when(name == "BOOLEAN", "boolean")
        .when(name.rlike(r"^(BIGINT|DECIMAL\(\d+,0\))$"), "integer")
        .when(name.rlike("^(DECIMAL|DOUBLE|FLOAT)"), "double")
        .otherwise("string")
    )


def readings(bronze: DataFrame, depth: int = 3) -> DataFrame:
    """Telemetry as found: ``templateName, path, type, value``, one row per field down to ``depth``.

    Names of nested fields are joined by dots, elements of arrays are called ``[]``.  Bodies
    are parsed as variants, so a field's type needs no schema.  Messages that are
    no JSON, name a field twice, or whose telemetry is no object give nothing.
    """
    parsed = F.expr("try_variant_get(try_parse_json(body), '$.telemetry', 'variant')")
    level = bronze.select("templateName", F.lit("").alias("path"), parsed.alias("value"))
    level = level.where(F.col("value").isNotNull() & (_kind(F.col("value")) == "object"))
    found = None
    for _ in range(depth):
        tvf = bronze.sparkSession.tvf
        inner = level.withColumnsRenamed({"path": "above", "value": "whole"})
        inner = inner.lateralJoin(tvf.variant_explode(F.col("whole").outer()))
        name = F.concat_ws(".", F.nullif("above", F.lit("")), F.coalesce("key", F.lit("[]")))
        level = inner.select("templateName", name.alias("path"), "value")
        rows = level.select("templateName", "path", _kind(F.col("value")).alias("type"), "value")
        found = rows if found is None else found.unionByName(rows)
        level = level.where(_kind(F.col("value")).isin("object", "array"))
    return found


def typed_drift(bronze: DataFrame, templates: Iterable[Template], depth: int = 3) -> DataFrame:
    """Readings that their template does not take as they are: ``templateName, path, type, messages``.

    These are fields it lacks, nested ones too, and fields of another type.  A reading of null
    fits everywhere.  Counted before they are shuffled; a message that holds a path
    twice (elements of an array) counts once for each.
    """
    templates = sorted(templates, key=lambda t: t.asset)
    spark = bronze.sparkSession
    if not templates:
        return spark.createDataFrame([], "templateName string, path string, type string, messages bigint")
    kinds = {v.simpleString(): k for k, v in schemas.TELEMETRY_TYPES.items()}
    fits = [
        (t.asset, [f"{name}={kind}" for name, _, column in t.columns for kind in FITS[kinds[column.simpleString()]]])
        for t in templates
    ]
    known = spark.createDataFrame(fits, "templateName string, fits array<string>")
    named = bronze.where(F.col("templateName").isin([t.asset for t in templates]))
    found = readings(named, depth).where("type <> 'null'").join(F.broadcast(known), "templateName")
    odd = found.where(~F.array_contains("fits", F.concat("path", F.lit("="), F.col("type"))))
    return odd.groupBy("templateName", "path", "type").agg(F.count(F.lit(1)).alias("messages"))


def propose(drift: DataFrame, templates: Iterable[Template], least: int = 1) -> dict[str, list[dict]]:
    """Template files that also take the new fields of ``typed_drift`` found ``least`` times.

    Only fields at the top whose readings have one type, or are whole and broken numbers, can become
    columns; fields of a template stay as they are.  The rows are one per field.
    """
    kinds = {v.simpleString(): k for k, v in schemas.TELEMETRY_TYPES.items()}
    fields = {t.asset: {name: kinds[kind.simpleString()] for name, _, kind in t.columns} for t in templates}
    top = drift.where(~F.contains("path", F.lit(".")) & (F.col("path") != "[]"))
    seen = top.groupBy("templateName", "path").agg(F.collect_set("type").alias("types"), F.sum("messages").alias("messages"))
    for row in seen.where(F.col("messages") >= least).collect():
        own, types = fields[row.templateName], set(row.types)
        taken = {name.lower() for name in own}
        if row.path.lower() in taken or not (types <= {"integer", "double"} or types == {"boolean"}):
            continue
        own[row.path] = "double" if "double" in types else types.pop()
    return {
        asset: [{"contents": [{"name": name, "schema": kind} for name, kind in sorted(own.items())]}]
        for asset, own in fields.items()
    }


MONTH = ("templateName", "yearDevice", "monthDevice")


def _layer(df: DataFrame, name: str, times: Column | None = None) -> DataFrame:
    """The rows of one layer as hashes; ``times`` is how often each counts."""
    times = F.lit(1) if times is None else times
    return df.select(*MONTH, F.lit(name).alias("layer"), times.cast("long").alias("n"), F.xxhash64("rowhash").alias("h"))


def fingerprint(df: DataFrame) -> DataFrame:
    """Per template and month: ``rows``, and the sum and the xor of 64-bit hashes of the messages.

    Two sets of messages with one fingerprint are the same but for a chance of 2**-64;
    order, files and copies of the layer do not matter.
    """
    return _layer(df, "").groupBy(*MONTH).agg(*_totals("layer", {"": 1}, "rows"))


def _totals(layer: str, signs: dict[str, int], rows: str) -> list[Column]:
    sign = F.coalesce(*[F.when(F.col(layer) == name, F.lit(s)) for name, s in signs.items()])
    hashes = sign * F.col("n").cast("decimal(19,0)") * F.col("h").cast("decimal(19,0)")
    odd = F.when(sign.isNotNull() & (F.col("n") % 2 == 1), F.col("h")).otherwise(0)
    return [
        F.sum(sign * F.col("n")).alias(rows),
        F.coalesce(F.sum(hashes.cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)")).alias("hash_sum"),
        F.bit_xor(odd).alias("hash_xor"),
    ]


def balance(whole: DataFrame, **parts: DataFrame) -> DataFrame:
    """Whether every message of ``whole`` is in exactly one of ``parts``, per template and month.

    One row each with the number of rows everywhere, and the differences of rows, hash
    sums and hash xors between the whole and its parts: all zero if nothing was lost,
    doubled or changed.  Only hashes are read, and they are added up before they are
    shuffled.  A frame may have a column ``times`` that says how often its row counts.
    """
    frames = {"whole": whole, **parts}
    union = None
    for name, df in frames.items():
        layer = _layer(df, name, F.col("times") if "times" in df.columns else None)
        union = layer if union is None else union.unionByName(layer)
    signs = {name: 1 if name == "whole" else -1 for name in frames}
    counts = [F.coalesce(F.sum(F.when(F.col("layer") == name, F.col("n"))), F.lit(0)).alias(name) for name in frames]
    totals = _totals("layer", signs, "rows_left")
    return union.groupBy(*MONTH).agg(*counts, *totals).withColumnsRenamed({"hash_sum": "sum_left", "hash_xor": "xor_left"})


def received_balance(received: DataFrame, bronze: DataFrame) -> DataFrame:
    """Everything received is in bronze, a copy of what is there, or without a body.

    ``received`` are the rows before the merge.  Copies are counted per hash of a message.
    """
    by = [*MONTH, "rowhash"]
    deliveries = received.where(F.col("rowhash").isNotNull()).groupBy(*by).agg(F.count(F.lit(1)).alias("deliveries"))
    copies = deliveries.select(*by, (F.col("deliveries") - 1).alias("times")).where("times > 0")
    return balance(received, bronze=bronze, copies=copies, bodiless=received.where(F.col("rowhash").isNull()))
