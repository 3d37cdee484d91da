"""Refreshing by steps gives the tables that one build gives."""

from datetime import timedelta

from pyspark.sql import functions as F

from brontide.operators import core
from brontide.plans import feed, models, refresh
from brontide.sources.tables import VersionedTable

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted(map(repr, df.select(sorted(df.columns)).collect()))


def test_steps_equal_one_build(spark, tmp_path):
    bronze, manifest = feed.bronze(spark, SF).withColumn("result_code", F.lit("00")), feed.manifest(spark, SF)
    grid, places = feed.grid(spark, SF), feed.places(spark, SF)
    cut = F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    silver = VersionedTable(spark, str(tmp_path / "silver"))
    for part in (bronze.where(F.col("collected_at") < cut), bronze):
        refresh.merge_silver(silver, part, manifest, feed.SOURCE)
    assert silver.current() == 2
    assert rows(silver.read()) == rows(models.silver(bronze, manifest, feed.SOURCE))
    before, after = feed.AS_OF, feed.AS_OF + timedelta(days=1)
    mart = VersionedTable(spark, str(tmp_path / "grid_mart"))
    refresh.merge_grid_mart(mart, silver.read(1), grid, before)
    refresh.merge_grid_mart(mart, silver.read(), grid, after)
    assert rows(mart.read()) == rows(models.grid_mart(silver.read(), grid, after))
    assert mart.read(1).count() > 0
    place = VersionedTable(spark, str(tmp_path / "place_mart"))
    refresh.rebuild_place_mart(place, silver.read(), places, after)
    assert rows(place.read()) == rows(models.place_mart(silver.read(), places, after))


def test_rows_of_a_run_are_not_dealt_by_it(spark, monkeypatch):
    bronze, manifest = feed.bronze(spark, SF), feed.manifest(spark, SF)
    want = rows(models.silver(bronze, manifest, feed.SOURCE))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as where Spark cannot tell how few runs there are
    try:
        few = models.silver(bronze, manifest, feed.SOURCE)
        plan = few._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
        assert rows(few) == want
        monkeypatch.setattr(core, "BROADCAST_KEYS", 0)
        many = models.silver(bronze, manifest, feed.SOURCE)
        assert "hashpartitioning(dag_run_id" in (plan := many._jdf.queryExecution().executedPlan().toString()) and "_salt" in plan
        assert rows(many) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
