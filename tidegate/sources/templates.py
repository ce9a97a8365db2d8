"""Device templates: JSON files to typed telemetry columns.

A template file is a list of objects, each with ``contents``: a list of
``{"name": ..., "schema": ...}``.  Reading, flattening and checking are one Spark
job; only the resulting field list, which is metadata, reaches the driver.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate import schemas
from tidegate.storage import file_uri, path_exists

CONTENTS = "array<struct<contents: array<struct<name: string, schema: string>>>>"


@dataclass(frozen=True)
class Template:
    """Telemetry columns of one asset: ``(JSON name, column name, type)``, by name."""

    asset: str
    columns: tuple[tuple[str, str, T.DataType], ...]

    def json_schema(self) -> T.StructType:
        return T.StructType([T.StructField(name, kind) for name, _, kind in self.columns])

    def silver_schema(self) -> T.StructType:
        return schemas.silver_schema(
            T.StructType([T.StructField(column, kind) for _, column, kind in self.columns])
        )


def template(asset: str, fields: Mapping[str, str]) -> Template:
    """A template from ``{name: type name}``, checked like one read from a file."""
    error = next(filter(None, (_field_error(n, t) for n, t in fields.items())), None)
    error = error or _case_error(fields)
    if error:
        raise ValueError(f"{asset}: {error}")
    return _build(asset, dict(fields))


def template_fields(spark: SparkSession, files: Mapping[str, str], folder: str = "") -> DataFrame:
    """Rows ``(asset, name, type, error)``, one per telemetry field of each asset.

    ``files`` maps an asset to its file, relative to ``folder``.  Of fields with
    one name, the last in file order wins.  A file that cannot be read as a
    template gives a row with a null name and the reason in ``error``.
    """
    base = folder.rstrip("/") + "/" if folder else ""
    paths = {asset: base + file for asset, file in files.items()}
    found = sorted({path for path in paths.values() if path_exists(spark, path)})
    if found:
        texts = spark.read.option("wholetext", True).text(found)
        # Local files are reported as file:///x but qualified as file:/x.
        file = F.regexp_replace("_metadata.file_path", "^file:/+", "file:/")
        texts = texts.select(file.alias("file"), "value")
    else:
        texts = spark.createDataFrame([], "file string, value string")
    texts = texts.select("file", F.from_json("value", CONTENTS).alias("objects"))
    places = [(asset, file_uri(spark, path)) for asset, path in paths.items()]
    assets = spark.createDataFrame(places, "asset string, file string")
    # Left join: a missing or empty file has no row of its own and must still be reported.
    objects = assets.join(texts, "file", "left").select(
        "asset", "objects", F.posexplode_outer("objects").alias("object_no", "object")
    )
    contents = objects.select(
        "asset",
        "objects",
        "object_no",
        F.col("object.contents").alias("contents"),
        F.posexplode_outer("object.contents").alias("field_no", "field"),
    )
    no_list = F.col("objects").isNull() | (F.col("object_no").isNotNull() & F.col("contents").isNull())
    fields = contents.select(
        "asset",
        F.col("field.name").alias("name"),
        F.col("field.schema").alias("type"),
        F.struct("object_no", "field_no").alias("at"),
        F.when(no_list, "missing contents")
        .when(F.col("field_no").isNotNull() & F.col("field.name").isNull(), "missing name")
        .alias("error"),
        F.col("field_no").isNotNull().alias("is_field"),
    )
    last = (
        fields.where(F.col("is_field") | F.col("error").isNotNull())
        .groupBy("asset", "name", "error")
        .agg(F.max_by("type", "at").alias("type"))
    )
    known = F.col("type").isin(list(schemas.TELEMETRY_TYPES))
    unknown = F.concat(F.lit("unknown type "), F.coalesce("type", F.lit("null")))
    return last.select(
        "asset",
        "name",
        "type",
        F.coalesce("error", F.when(F.col("type").isNull() | ~known, unknown)).alias("error"),
    )


def compile_templates(
    spark: SparkSession, files: Mapping[str, str], folder: str = ""
) -> tuple[dict[str, Template], dict[str, str]]:
    """``({asset: template}, {asset: error})``.

    An asset with a bad file is reported and left out; the others are compiled.
    An asset whose file lists no telemetry at all gets a template without columns.
    """
    fields: dict[str, dict[str, str]] = {asset: {} for asset in files}
    errors: dict[str, str] = {}
    for row in template_fields(spark, files, folder).collect():
        if row.error:
            errors.setdefault(row.asset, f"{row.name}: {row.error}" if row.name else row.error)
        else:
            fields[row.asset][row.name] = row.type
    for asset, found in fields.items():
        error = _case_error(found)
        if error:
            errors.setdefault(asset, error)
    return {a: _build(a, f) for a, f in fields.items() if a not in errors}, errors


def _field_error(name: str | None, kind: str | None) -> str | None:
    if name is None:
        return "missing name"
    return None if kind in schemas.TELEMETRY_TYPES else f"{name}: unknown type {kind}"


def _case_error(fields: Mapping[str, str]) -> str | None:
    """Column names are case-insensitive, so such fields cannot share one table."""
    seen: dict[str, str] = {}
    for name in sorted(fields):
        other = seen.setdefault(name.lower(), name)
        if other != name:
            return f"fields {other!r} and {name!r} differ only in case"
    return None


def _build(asset: str, fields: Mapping[str, str]) -> Template:
    """Columns sorted by name; names taken by a fixed silver column get a prefix."""
    fixed = {f.name.lower() for f in (*schemas.SILVER_HEAD, *schemas.SILVER_TAIL)}
    taken = fixed | {name.lower() for name in fields}
    columns = []
    for name in sorted(fields):
        column = name
        if name.lower() in fixed:
            column = f"telemetry_{name}"
            while column.lower() in taken:
                column = f"telemetry_{column}"
            taken.add(column.lower())
        columns.append((name, column, schemas.TELEMETRY_TYPES[fields[name]]))
    return Template(asset, tuple(columns))
