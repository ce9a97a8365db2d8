"""Run parameters and the folder/table layout of one telemetry lake."""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass

# Session settings the jobs rely on.  Year, month and dates of device times are
# taken in UTC.  Parquet keeps row-group statistics for microsecond timestamps only.
# The advisory size is that of the shuffled, compressed rows one written file holds.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.broadcastTimeout": "3600",
}


def asset_name(asset: str) -> str:
    """Name of an asset in paths and table names.

    Spaces become underscores, and so does all else that a table name cannot hold.
    """
    return re.sub(r"[^0-9A-Za-z_]", "_", asset)


def asset_names(assets: Iterable[str]) -> dict[str, str]:
    """``{asset: name}``; rejects assets that would share one table or folder.

    Table names are case-insensitive in Spark's catalog, so names are compared
    that way.
    """
    names: dict[str, str] = {}
    owner: dict[str, str] = {}
    for asset in assets:
        name = asset_name(asset)
        other = owner.setdefault(name.lower(), asset)
        if other != asset:
            raise ValueError(f"assets {other!r} and {asset!r} both map to {name!r}")
        names[asset] = name
    return names


@dataclass(frozen=True)
class Layout:
    """Where every dataset and checkpoint lives.

    ``<root>/bronze``, ``<root>/silver/<asset>``, ``<root>/checkpoints/...``.
    Checkpoints are derived from the target on purpose: two queries with
    separate checkpoints must never write the same dataset.
    ``bronze_table`` and ``silver_table`` are optional catalog names; each silver
    table is called ``<silver_table>_<asset>``.
    """

    root: str
    bronze_table: str | None = None
    silver_table: str | None = None

    def _at(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    def bronze(self) -> str:
        return self._at("bronze")

    def silver(self, asset: str | None = None) -> str:
        return self._at("silver") if asset is None else self._at("silver", asset_name(asset))

    def silver_table_of(self, asset: str) -> str | None:
        return None if self.silver_table is None else f"{self.silver_table}_{asset_name(asset)}"

    def checkpoint(self, layer: str, asset: str | None = None) -> str:
        parts = ["checkpoints", layer] + ([] if asset is None else [asset_name(asset)])
        return self._at(*parts)

    def start(self, layer: str) -> str:
        return self._at("checkpoints", f"{layer}_start")

    def quarantine(self, layer: str) -> str:
        return self._at("quarantine", layer)

    def metrics(self) -> str:
        return self._at("metrics")

    def progress(self) -> str:
        return self._at("progress")

    def summaries(self, layer: str) -> str:
        return self._at("summaries", layer)


@dataclass(frozen=True)
class RunConfig:
    """Parameters of one run, as numbers.

    ``trigger_minutes`` 0 starts the next micro-batch at once; ``job_minutes`` 0
    runs until stopped; ``lookback_minutes`` sets the start position of the very
    first run (later runs resume from the checkpoint).  A batch reads at most
    ``max_bytes_per_trigger`` of files.  With ``once`` a run takes what is there and
    ends, however long that takes.
    """

    layout: Layout
    trigger_minutes: float = 1
    job_minutes: float = 15
    lookback_minutes: float = 60
    mode: str = "strict"
    max_files_per_trigger: int | None = None
    max_bytes_per_trigger: int | None = 100_000_000_000
    once: bool = False

    def __post_init__(self) -> None:
        for name in ("trigger_minutes", "job_minutes", "lookback_minutes"):
            if getattr(self, name) < 0:
                raise ValueError(f"{name} must not be negative")
        if self.mode not in ("strict", "compat"):
            raise ValueError(f"unknown mode {self.mode!r}")
