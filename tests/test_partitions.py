"""Merges that touch the partitions they must, and no others."""

import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from brontide.plans import feed, models, refresh
from brontide.sources import partitions
from brontide.streaming import jobs

SF = "/root/testdata/sf0.001"
START = datetime(2026, 8, 12)


def files(path):
    return {os.path.relpath(os.path.join(d, f), path): os.stat(os.path.join(d, f)).st_ino for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def by_day(found):
    out = {}
    for f, inode in found.items():
        out.setdefault(f.split("/")[0].split("=")[1], set()).add((f, inode))
    return out


def changed(before, after):
    a, b = by_day(before), by_day(after)
    return {d for d in a.keys() | b.keys() if a.get(d) != b.get(d)}


def hours(spark, *rows):
    return spark.createDataFrame([(k, None if h is None else START + timedelta(hours=h), v) for k, h, v in rows], "k int, forecast_at timestamp_ntz, v string")


def test_merge_touches_its_day_only(spark, tmp_path):
    t = partitions.PartitionedTable(spark, str(tmp_path / "t"), partitions.FORECAST)
    assert not t.current()
    t.upsert(hours(spark, (1, 0, "a"), (2, 5, "b"), (3, 30, "c"), (4, 55, "d"), (9, None, "n")), ["k", "forecast_at"])
    before = files(t.path)
    assert by_day(before).keys() == {"2026-08-12", "2026-08-13", "2026-08-14", "__HIVE_DEFAULT_PARTITION__"}
    assert t.upsert(hours(spark, (3, 30, "C"), (5, 31, "e")), ["k", "forecast_at"]) == {"2026-08-13"}
    assert changed(before, files(t.path)) == {"2026-08-13"}
    assert sorted((r.k, r.v) for r in t.read().collect()) == [(1, "a"), (2, "b"), (3, "C"), (4, "d"), (5, "e"), (9, "n")]
    assert t.read().columns == ["k", "forecast_at", "v"]
    # The plan of a merge lists the touched day alone.
    scan = t.stored().where(t._inside({"2026-08-13"}))
    assert {f.split("forecast_day=")[1].split("/")[0] for f in scan.inputFiles()} >= {"2026-08-13"}
    assert "PartitionFilters: [isnotnull(forecast_day" in scan._jdf.queryExecution().toString() or "forecast_day" in scan._jdf.queryExecution().executedPlan().toString()
    # A null day is a partition too; repeated keys are refused and leave the table alone.
    t.upsert(hours(spark, (9, None, "N")), ["k"])
    assert sorted((r.k, r.v) for r in t.read().collect())[-1] == (9, "N")
    now = files(t.path)
    with pytest.raises(ValueError):
        t.upsert(hours(spark, (7, 1, "x"), (7, 1, "y")), ["k", "forecast_at"])
    assert files(t.path) == now
    assert t.upsert(hours(spark), ["k", "forecast_at"]) == set() and files(t.path) == now
    assert os.listdir(tmp_path) == ["t"]


def test_key_moves_to_another_day(spark, tmp_path):
    t = partitions.PartitionedTable(spark, str(tmp_path / "t"), partitions.FORECAST)
    t.upsert(hours(spark, (1, 0, "a"), (2, 30, "b"), (3, 55, "c")), ["k"])
    before = files(t.path)
    assert t.upsert(hours(spark, (2, 1, "moved")), ["k"]) == {"2026-08-12", "2026-08-13"}
    assert sorted((r.k, r.v) for r in t.read().collect()) == [(1, "a"), (2, "moved"), (3, "c")]
    assert by_day(files(t.path)).keys() == {"2026-08-12", "2026-08-14"}
    assert changed(before, files(t.path)) == {"2026-08-12", "2026-08-13"}
    assert [r.k for r in t.read(start="2026-08-13").collect()] == [3] and t.read(end="2026-08-12").count() == 2


def test_run_is_replaced(spark, tmp_path):
    cols = "source_id string, dag_run_id string, load_date string, v int"
    t = partitions.PartitionedTable(spark, str(tmp_path / "t"), partitions.COLLECTED)
    rows = lambda *xs: spark.createDataFrame(list(xs), cols)
    t.append(rows(("s", "r1", "2026-01-01", 1), ("s", "r1", "2026-01-02", 2), ("s", "r2", "2026-01-02", 3), ("s", "r2", "2026-01-03", 4), ("x", "r1", "2026-01-04", 5), (None, None, "2026-01-03", 6)))
    before = files(t.path)
    again = rows(("s", "r1", "2026-01-02", 20), ("s", "r1", "2026-01-05", 21))
    for _ in range(2):
        t.replace_run(again, "s", "r1")
        assert sorted(r.v for r in t.read().collect()) == [3, 4, 5, 6, 20, 21]
        assert {r.load_date for r in t.read().where("v = 21").collect()} == {"2026-01-05"}
    assert changed(before, files(t.path)) == {"2026-01-01", "2026-01-02", "2026-01-05"}
    assert "2026-01-01" not in by_day(files(t.path))


def test_window_and_retention(spark, tmp_path):
    t = partitions.PartitionedTable(spark, str(tmp_path / "t"), partitions.FORECAST)
    t.append(hours(spark, (1, 0, "a"), (2, 30, "b"), (3, 31, "c"), (4, 60, "d"), (5, 80, "e")))
    before = files(t.path)
    t.append_window(hours(spark, (8, 2, "old"), (3, 31, "C"), (6, 81, "f")), "forecast_at", START + timedelta(hours=31))
    assert sorted((r.k, r.v) for r in t.read().collect()) == [(1, "a"), (2, "b"), (3, "C"), (6, "f")]
    assert changed(before, files(t.path)) == {"2026-08-13", "2026-08-14", "2026-08-15"}
    before = files(t.path)
    t.retain("2026-08-13", F.col("v") != "b")
    assert sorted(r.k for r in t.read().collect()) == [3, 6] and changed(before, files(t.path)) == {"2026-08-12", "2026-08-13"}


def test_steps_equal_one_build(spark, tmp_path):
    bronze, manifest, grid = feed.bronze(spark, SF), feed.manifest(spark, SF), feed.grid(spark, SF)
    rows = lambda df: sorted(map(repr, df.select(sorted(df.columns)).collect()))
    silver = partitions.PartitionedTable(spark, str(tmp_path / "silver"), partitions.FORECAST)
    refresh.merge_silver(silver, bronze.where(F.col("collected_at") < F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")), manifest, feed.SOURCE)
    before = files(silver.path)
    refresh.merge_silver(silver, bronze, manifest, feed.SOURCE)
    assert rows(silver.read()) == rows(models.silver(bronze, manifest, feed.SOURCE))
    # Days that the look-back does not reach keep their files.
    kept = by_day(before).keys() - changed(before, files(silver.path))
    assert min(kept) == min(by_day(before)) and len(kept) > 5
    mart = partitions.PartitionedTable(spark, str(tmp_path / "mart"), partitions.FORECAST)
    after = feed.AS_OF + timedelta(days=1)
    for as_of in (feed.AS_OF, after):
        refresh.merge_grid_mart(mart, silver.read(), grid, as_of)
    assert rows(mart.read()) == rows(models.grid_mart(silver.read(), grid, after))


def test_stream_merges_by_partition(spark, tmp_path):
    table = partitions.PartitionedTable(spark, str(tmp_path / "t"), partitions.FORECAST)
    for rows in ([(1, 0, "a"), (2, 30, "b")], [(2, 30, "B"), (3, 31, "c")]):
        hours(spark, *rows).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(hours(spark).schema).parquet(str(tmp_path / "in"))
        jobs.merge_batches(stream, table, ["k", "forecast_at"], lambda df: df, str(tmp_path / "cp")).awaitTermination()
    assert sorted((r.k, r.v) for r in table.read().collect()) == [(1, "a"), (2, "B"), (3, "c")]
