from datetime import datetime, timedelta

from pyspark.sql import functions as F

from brontide.sources.tables import VersionedTable
from brontide.streaming import jobs

START = datetime(2026, 8, 12)


def feed(spark, folder, rows, cols):
    folder.mkdir(exist_ok=True)
    spark.createDataFrame(rows, cols).coalesce(1).write.mode("append").parquet(str(folder))
    return spark.readStream.schema(spark.createDataFrame([], cols).schema).parquet(str(folder))


def test_batches_merge_once(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    cols = "k int, v string"
    for rows in ([(1, "a"), (2, "b")], [(2, "B"), (3, "c")]):
        stream = feed(spark, tmp_path / "in", rows, cols)
        jobs.merge_batches(stream, table, ["k"], lambda df: df, str(tmp_path / "cp")).awaitTermination()
    assert sorted(tuple(r) for r in table.read().collect()) == [(1, "a"), (2, "B"), (3, "c")]


def test_sessions_split_at_dry_hours(spark, tmp_path):
    hours = [0, 1, 2, 4, 7, 8]
    rows = [("p", START + timedelta(hours=h), True, float(h)) for h in hours] + [("p", START + timedelta(hours=3), False, 0.0), ("q", START + timedelta(hours=40), True, 1.0)]
    stream = feed(spark, tmp_path / "in", rows, "place_id string, forecast_at timestamp, is_precipitating boolean, precip_prob_pct double")
    query = jobs.precipitation_sessions(stream).writeStream.format("memory").queryName("sessions").outputMode("append").option("checkpointLocation", str(tmp_path / "cp")).start()
    query.processAllAvailable()
    query.stop()
    got = spark.table("sessions").where(F.col("place_id") == "p").orderBy("window_start_at").collect()
    assert [(r.window_start_at, r.window_end_at, r.precipitation_hour_count) for r in got] == [(START, START + timedelta(hours=2), 3), (START + timedelta(hours=4),) * 2 + (1,), (START + timedelta(hours=7), START + timedelta(hours=8), 2)]


def _fed(spark, folder, batches, cols, run):
    """The rows of a stream after each batch, restarted from its checkpoint between them."""
    source = folder / "in"
    source.mkdir()
    schema = spark.createDataFrame([], cols).schema
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, cols).coalesce(1).write.mode("append").parquet(str(folder / f"b{k}"))
        for f in (folder / f"b{k}").glob("*.parquet"):
            f.rename(source / f"{k}-{f.name}")
        query = run(spark.readStream.schema(schema).parquet(str(source))).writeStream.format("parquet").option("path", str(folder / "out")).option("checkpointLocation", str(folder / "cp")).outputMode("append").trigger(availableNow=True).start()
        query.awaitTermination()
        query.stop()
    return spark.read.parquet(str(folder / "out")).collect()


def test_due_slots_after_restarts(spark, tmp_path):
    """Each batch is a run of its own: deadlines and ends are state, late and repeated rows end nothing twice."""
    at = lambda h: START + timedelta(hours=h)
    cols = "expected_slot_id string, kind string, deadline_at timestamp, collection_state string, event_at timestamp"
    declared = [("s1", "declared", at(1), None, at(0)), ("s2", "declared", at(1), None, at(0)), ("s2", "declared", at(1), None, at(0))]
    batches = [
        declared,
        [("s1", "outcome", None, "observed", at(0.5)), ("s1", "outcome", None, "observed", at(0.6)), *declared],
        [("s3", "declared", at(9), None, at(5))],
        [("s2", "outcome", None, "observed", at(6)), ("s1", "outcome", None, "collection_failed", at(6)), ("s3", "outcome", None, "observed", at(6))],
        [("s4", "declared", at(30), None, at(29))],
        [("s3", "outcome", None, "observed", at(29))],
    ]
    got = sorted((r.expected_slot_id, r.collection_state, r.event_at) for r in _fed(spark, tmp_path, batches, cols, jobs.due_slots))
    assert got == [("s1", "observed", at(0.5)), ("s2", "missing_unknown", at(1)), ("s3", "observed", at(6))]


def test_bursts_keep_the_newest_run(spark, tmp_path):
    at = lambda h: START + timedelta(hours=h)
    cols = "source_id string, dag_run_id string, event_at timestamp, load_date string"
    event = lambda s, run, h: (s, run, at(h), f"{at(h + 9):%Y-%m-%d}")
    batches = [[event("a", "r1", 0), event("a", "r2", 0.2), event("b", "r1", 0), event("b", "r1", 0)], [event("a", "r3", 0.4), event("a", "r0", 0.1), ("b", "r9", at(0.5), "2026-01-01")], [event("a", "r3", 0.4)]]
    rows = _fed(spark, tmp_path, batches, cols, jobs.coalesced_runs)
    got = [(r.source_id, r.dag_run_id, r.status, r.is_publishable) for r in rows]
    assert sorted(got) == sorted([("a", "r1", "COALESCED", False), ("a", "r2", "SUCCESS", True), ("b", "r1", "SUCCESS", True), ("a", "r0", "COALESCED", False), ("a", "r2", "COALESCED", False), ("a", "r3", "SUCCESS", True)])
