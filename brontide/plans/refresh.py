"""Incremental refreshes of the model graph's tables: silver and grid mart by keyed merges, the
place mart by a whole new version. Partitioned tables are merged in the partitions that change, the
others by one new version."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brontide.functions.time_axes import day_floor, literal_hour
from brontide.plans import models
from brontide.sources.partitions import PartitionedTable
from brontide.sources.tables import VersionedTable

GRID_KEY = ["grid_id", "issued_at", "forecast_at", "category"]


def merge_silver(table: VersionedTable | PartitionedTable, bronze: DataFrame, manifest: DataFrame, source_id: str, run_id: str | None = None, load_date: str | None = None, historical: bool = False, lookback: int = 30):
    """Merges what is newer than the table's newest row less the look-back; a historical run is
    merged whole. Of a key the new row wins."""
    target = table.read() if table.current() else None
    rows = models.silver(bronze, manifest, source_id, run_id, load_date, target, historical, lookback)
    return table.upsert(rows, models.SILVER_KEY)


def merge_grid_mart(table: VersionedTable | PartitionedTable, silver: DataFrame, grid: DataFrame, as_of: datetime, lookback: int = 30):
    """Drops what retention no longer keeps, then merges winners of newer rows."""
    if not table.current():
        return table.upsert(models.grid_mart(silver, grid, as_of), GRID_KEY)
    old = table.read()
    newest = old.agg(F.max("collected_at")).first()[0]
    since = silver if newest is None else silver.where(F.col("collected_at") >= F.lit(str(newest - timedelta(minutes=lookback))).cast("timestamp_ntz"))
    new = models.grid_mart(since, grid, as_of).select(old.columns)
    day = day_floor(as_of, 1)
    retained = (F.col("forecast_at") >= literal_hour(day)) & (F.col("issued_at") >= literal_hour(as_of - timedelta(hours=24)))
    if isinstance(table, PartitionedTable):
        return table.retain(day.date(), retained) | table.upsert(new, GRID_KEY)
    kept = old.where(retained)
    version = table.stage(kept.join(new.select(*GRID_KEY), GRID_KEY, "left_anti").unionByName(new))
    table.swap(version)
    return version


def rebuild_place_mart(table: VersionedTable, silver: DataFrame, places: DataFrame, as_of: datetime) -> int:
    """A whole new version; readers see the old one until the pointer is added."""
    version = table.stage(models.place_mart(silver, places, as_of))
    table.swap(version)
    return version
