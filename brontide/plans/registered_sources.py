"""Registered queries of raw files, observations, reference data, streams' batch forms and cursors,
each over the driver's whole tables, with the SQL that says the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brontide.operators import core
from brontide.plans import evaluation, feed, models
from brontide.plans.feed import AS_OF, SOURCE, SQL_ALL, SQL_BRONZE, read
from brontide.plans.registry import register
from brontide.sources import ingest, partitions, tables

_BRONZE = f"WITH {SQL_BRONZE} "
_T = f"TIMESTAMP '{AS_OF}'"
c = F.col


# Raw files: events as stored responses, some of them spoiled.
_SQL_OBJECTS = _BRONZE + """, objects AS (SELECT dag_run_id, load_date, issued_at, nx, count(*) AS n, count(*) FILTER (category = 'TMP') AS t, (nx + 3 * right(load_date, 2)::INT) % 11 AS m FROM bronze GROUP BY ALL)"""


#: Folders of raw files by session, folder and state of its files.
_RAW: dict[tuple[str, ...], str] = {}


def raw_files(spark: SparkSession, sf_dir: str) -> str:
    key = (spark.sparkContext.applicationId, sf_dir, feed.state(spark, sf_dir))
    if key not in _RAW:
        _RAW[key] = _stored(spark, sf_dir)
    return _RAW[key]


def _stored(spark: SparkSession, sf_dir: str) -> str:
    """A folder with one JSON object for each run, day, issue and cell, as a collector stores them:
    some refused by the source, some no JSON, some with a single item, none, or wrong ones."""
    b = feed.bronze(spark, sf_dir)
    parts = [c("load_date"), c("dag_run_id").alias("run_id"), "nx", "ny", "base_date", "base_time"]
    kind = (c("nx") + 3 * F.substring("load_date", -2, 2).cast("int")) % 11
    value = F.when((kind == 5) & (c("category") == "TMP"), "").otherwise(c("fcst_value"))
    item = F.struct(c("base_date").alias("baseDate"), c("base_time").alias("baseTime"), "category", c("fcst_date").alias("fcstDate"), c("fcst_time").alias("fcstTime"), value.alias("fcstValue"), F.when(kind == 6, c("nx") + 1).otherwise(c("nx")).alias("nx"), "ny")
    pages = b.withColumn("m", kind).groupBy(*parts, "m").agg(F.sort_array(F.collect_list(item)).alias("items"))
    head = F.struct(F.when(c("m") == 0, "22").when(c("m") == 1, "30").otherwise("00").alias("resultCode"), F.lit("said").alias("resultMsg"))
    about = [F.lit(1).alias("pageNo"), F.lit(1000).alias("numOfRows")]
    many = F.when(c("m") == 4, F.slice("items", 1, 0)).otherwise(c("items"))
    whole = F.to_json(F.struct(F.struct(head.alias("header"), F.struct(*about, F.size("items").alias("totalCount"), F.struct(many.alias("item")).alias("items")).alias("body")).alias("response")))
    one = F.to_json(F.struct(F.struct(head.alias("header"), F.struct(*about, F.lit(1).alias("totalCount"), F.struct(c("items")[0].alias("item")).alias("items")).alias("body")).alias("response")))
    text = F.when(c("m") == 2, "<html>busy</html>").when(c("m") == 3, one).otherwise(whole)
    path = f"{tables.session_folder(spark, 'raw')}/objects"
    pages.select(*ingest.RAW_PARTS, text.alias("value")).repartition(*ingest.RAW_PARTS[:2]).write.partitionBy(*ingest.RAW_PARTS).text(path)
    return path


@register("s01_raw_files", _SQL_OBJECTS + """SELECT reason, sum(k)::BIGINT AS n FROM (
    SELECT CASE m WHEN 0 THEN 'result_quota' WHEN 1 THEN 'result_auth' WHEN 2 THEN 'malformed_envelope' WHEN 4 THEN 'no_items' WHEN 5 THEN 'missing_fcstValue' WHEN 6 THEN 'context_mismatch' ELSE 'good' END AS reason, CASE WHEN m < 5 THEN 1 WHEN m = 5 THEN t ELSE n END AS k FROM objects
    UNION ALL SELECT 'good', n - t FROM objects WHERE m = 5) WHERE k > 0 GROUP BY 1""")
def s01_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every file of the folder: quarantined objects and items by reason, and the good items."""
    items, bad = ingest.unwrap(ingest.read_raw(spark, raw_files(spark, sf_dir)))
    reasons = items.select(F.coalesce(ingest.forecast_item_reason(), F.lit("good")).alias("reason")).unionByName(bad.select("reason"))
    return reasons.groupBy("reason").agg(F.count("*").alias("n"))


@register("s07_rows_of_a_run", _SQL_OBJECTS + """, kept AS (SELECT b.*, row_number() OVER (PARTITION BY b.dag_run_id, b.load_date, b.issued_at, b.nx ORDER BY b.category, b.forecast_at, b.fcst_value_raw) AS k, m FROM bronze b JOIN objects USING (dag_run_id, load_date, issued_at, nx))
    SELECT 'grid_' || nx || '_123' AS place_id, nx, category, strftime(forecast_at, '%Y%m%d%H%M') AS forecast, fcst_value_raw AS fcst_value FROM kept WHERE dag_run_id = 'run_1' AND (m = 3 AND k = 1 OR m = 5 AND category <> 'TMP' OR m > 6)""")
def s07(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bronze rows of one run: files of other runs are not listed."""
    items, _ = ingest.unwrap(ingest.read_raw(spark, raw_files(spark, sf_dir), run_id="run_1"))
    good = ingest.forecast_bronze(items.where(ingest.forecast_item_reason().isNull()), SOURCE)
    return good.select("place_id", "nx", "category", F.concat("fcst_date", "fcst_time").alias("forecast"), "fcst_value")


# Observations: each hour of the events, five cells and eight categories, some missing, doubled or wrong.
_KINDS = "(VALUES (0, 'PTY', 'code'), (1, 'REH', 'percent'), (2, 'RN1', 'mm'), (3, 'T1H', 'degC'), (4, 'UUU', 'm/s'), (5, 'VEC', 'degree'), (6, 'VVV', 'm/s'), (7, 'WSD', 'm/s')) k(i, category, unit)"
_SQL_OBSERVED = f"""WITH hours AS (SELECT DISTINCT date_trunc('hour', ts) AS slot, (epoch(date_trunc('hour', ts)) / 3600)::BIGINT AS h FROM events WHERE event_id IS NOT NULL AND ts IS NOT NULL AND user_id IS NOT NULL),
    told AS (SELECT slot, h, nx, i, category, unit, CASE WHEN (h + 3 * nx + i) % 61 = 0 THEN 'x' ELSE (CASE i WHEN 0 THEN h % 9 WHEN 1 THEN h * 7 % 110 WHEN 2 THEN h % 20 - 1 WHEN 3 THEN h % 50 - 10 WHEN 5 THEN (h * 13 + nx) % 400 WHEN 7 THEN h % 25 - 1 ELSE h % 30 - 15 END)::VARCHAR END AS v
        FROM hours, (SELECT unnest(range(56, 61)) AS nx) cells, {_KINDS}, LATERAL (SELECT unnest(range(CASE WHEN (h * 8 + nx + i) % 41 = 0 THEN 0 WHEN (h + nx + i) % 53 = 0 THEN 2 ELSE 1 END))) t),
    whole AS (SELECT * FROM told WHERE (h + nx) % 29 <> 0),
    judged AS (SELECT *, try_cast(v AS DOUBLE) AS x, CASE WHEN v = 'x' THEN 'not_finite' WHEN (i = 0 AND v NOT IN ('0', '1', '2', '3', '5', '6', '7')) OR (i = 1 AND v::INT > 100) OR (i = 5 AND v::INT > 360) OR (i IN (2, 7) AND v::INT < 0) THEN 'domain' END AS reason FROM whole),
    good AS (SELECT *, slot - INTERVAL 9 HOUR AS observed_at, 'kma_' || nx || '_123' AS grid_id, sha256(concat_ws(chr(31), 'observed', strftime(slot - INTERVAL 9 HOUR, '%Y-%m-%dT%H:%M:%S.%f+00:00'), 'kma_' || nx || '_123', category, 'r1')) AS idempotency_key FROM judged WHERE reason IS NULL)
"""


def observed_items(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(items of whole objects, refused objects)."""
    e = read(spark, sf_dir, "events").where("event_id IS NOT NULL AND ts IS NOT NULL AND user_id IS NOT NULL")
    hours = e.select(F.date_trunc("HOUR", "ts").alias("slot")).distinct().withColumn("h", F.floor(F.unix_seconds(c("slot").cast("timestamp")) / 3600))
    kinds = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(k).alias("category")) for i, k in enumerate(evaluation.OBSERVED)))
    rows = hours.withColumn("nx", F.explode(F.sequence(F.lit(56), F.lit(60)))).select("*", F.inline(kinds))
    h, nx, i = c("h"), c("nx"), c("i")
    times = F.when((h * 8 + nx + i) % 41 == 0, 0).when((h + nx + i) % 53 == 0, 2).otherwise(1)
    number = F.when(i == 0, h % 9).when(i == 1, h * 7 % 110).when(i == 2, h % 20 - 1).when(i == 3, h % 50 - 10).when(i == 5, (h * 13 + nx) % 400).when(i == 7, h % 25 - 1).otherwise(h % 30 - 15)
    value = F.when((h + 3 * nx + i) % 61 == 0, "x").otherwise(number.cast("string"))
    rows = rows.withColumn("value", value).withColumn("_", F.explode(F.array_repeat(F.lit(0), times)))
    base = [F.date_format("slot", "yyyyMMdd").alias("baseDate"), F.date_format("slot", "HHmm").alias("baseTime")]
    pages = rows.groupBy("slot", "h", "nx").agg(F.collect_list(F.struct(*base, "category", c("value").alias("obsrValue"), "nx", F.lit(123).alias("ny"))).alias("items"))
    body = F.struct(F.lit(1).alias("pageNo"), F.lit(10).alias("numOfRows"), (F.size("items") + F.when((h + nx) % 29 == 0, 1).otherwise(0)).alias("totalCount"), F.struct(c("items").alias("item")).alias("items"))
    content = F.encode(F.to_json(F.struct(F.struct(F.struct(F.lit("00").alias("resultCode"), F.lit("OK").alias("resultMsg")).alias("header"), body.alias("body")).alias("response"))), "UTF-8")
    raw = pages.select(F.concat_ws("/", F.lit("observed"), c("h"), c("nx")).alias("raw_object_key"), content.alias("content"), c("slot").cast("timestamp").alias("stored_at"), F.concat(F.lit("run_"), h % 4).alias("path_run_id"))
    items, _ = ingest.unwrap(raw)
    return ingest.whole_objects(items)


def observed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    items, _ = observed_items(spark, sf_dir)
    return ingest.observation_bronze(items.where(ingest.observation_reason().isNull()), "observed", "m", "r1")


def _cells(spark: SparkSession) -> DataFrame:
    return spark.range(56, 61).select(F.concat(F.lit("kma_"), "id", F.lit("_123")).alias("grid_id"))


@register("s12_refused_objects", _SQL_OBSERVED + "SELECT 'observed/' || h || '/' || nx AS raw_object_key, 'row_count' AS reason FROM told WHERE (h + nx) % 29 = 0 GROUP BY h, nx")
def s12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observed_items(spark, sf_dir)[1]


@register("s13_observed_values", _SQL_OBSERVED + "SELECT category, coalesce(reason, 'good') AS reason, count(*) AS n FROM judged GROUP BY ALL")
def s13(spark: SparkSession, sf_dir: str) -> DataFrame:
    items, _ = observed_items(spark, sf_dir)
    return items.groupBy("item.category", F.coalesce(ingest.observation_reason(), F.lit("good")).alias("reason")).agg(F.count("*").alias("n"))


_SQL_SLOTS = _SQL_OBSERVED + ", cell AS (SELECT observed_at, nx, i, count(*) AS n FROM good GROUP BY ALL), slots AS (SELECT observed_at, 40 AS expected_count, count(*) AS actual_count, 40 - count(*) AS missing, 0 AS unexpected, count(*) FILTER (n > 1) AS repeated FROM cell GROUP BY 1)"


@register("s14_slot_evidence", _SQL_SLOTS + "SELECT *, 0 AS off_base, 1 AS runs FROM slots")
def s14(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.slot_evidence(observed_rows(spark, sf_dir), _cells(spark))


@register("s14_admitted_slots", _SQL_SLOTS + "SELECT observed_at FROM slots WHERE missing = 0 AND repeated = 0")
def s14_admitted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.admitted_slots(ingest.slot_evidence(observed_rows(spark, sf_dir), _cells(spark)))


@register("s15_observation_rows", _SQL_OBSERVED + "SELECT idempotency_key, 'run_' || h % 4 AS dag_run_id, strftime(slot, '%Y-%m-%dT%H:%M:%S') AS observed_slot, observed_at, grid_id, category, x AS observed_value, unit FROM good")
def s15(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observed_rows(spark, sf_dir).select("idempotency_key", "dag_run_id", "observed_slot", "observed_at", "grid_id", "category", "observed_value", "unit")


@register("s16_row_set", _SQL_OBSERVED + f""", own AS (SELECT * FROM good WHERE slot = {_T}), cell AS (SELECT nx, i, count(*) AS n FROM own GROUP BY ALL)
    SELECT * FROM (SELECT 'row_count' AS violation, (count(*) <> 40)::BIGINT AS n FROM own UNION ALL SELECT 'slots', (count(DISTINCT slot) <> 1)::BIGINT FROM own UNION ALL SELECT 'repeated_keys', count(*) - count(DISTINCT idempotency_key) FROM own
        UNION ALL SELECT 'grid_categories', 40 - count(*) + count(*) FILTER (n > 1) FROM cell) WHERE n <> 0""")
def s16(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = observed_rows(spark, sf_dir).where(c("observed_slot") == AS_OF.strftime("%Y-%m-%dT%H:%M:%S"))
    return ingest.row_set_violations(rows, _cells(spark), 40)


@register("s17_novel_revisions", _SQL_OBSERVED + "SELECT CASE WHEN h % 2 = 1 THEN 'append' ELSE 'conflict' END AS kind, count(DISTINCT idempotency_key) AS n FROM good WHERE h % 2 = 1 OR h % 10 = 0 GROUP BY 1")
def s17(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows against a table laid out by day that has half of them already, some with another value."""
    rows = observed_rows(spark, sf_dir).dropDuplicates(["idempotency_key"])
    h = F.floor(F.unix_seconds((c("observed_at") + F.expr("INTERVAL 9 HOURS")).cast("timestamp")) / 3600)
    table = partitions.PartitionedTable(spark, f"{tables.session_folder(spark, 'observed')}/rows", partitions.OBSERVED)
    table.append(rows.where(h % 2 == 0).withColumn("observed_value", F.when(h % 10 == 0, c("observed_value") + 1).otherwise(c("observed_value"))))
    new, conflicts = ingest.novel_observations(rows, table.stored())
    return new.select(F.lit("append").alias("kind")).unionByName(conflicts.select(F.lit("conflict").alias("kind"))).groupBy("kind").agg(F.count("*").alias("n"))


@register("s18_revision_scope", _SQL_OBSERVED + "SELECT grid_id, CASE WHEN nx = 58 THEN 'r1,r2' ELSE 'r1' END AS revisions FROM good GROUP BY ALL")
def s18(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = observed_rows(spark, sf_dir)
    both = rows.unionByName(rows.where("nx = 58").withColumn("source_revision", F.lit("r2")))
    return ingest.revision_scope(both).select("grid_id", F.array_join("revisions", ",").alias("revisions"))


@register("s19_slot_check", _SQL_OBSERVED + f""", own AS (SELECT *, count(*) OVER (PARTITION BY nx) AS per FROM good WHERE slot = {_T})
    SELECT 5 AS expected_grids, count(DISTINCT nx) AS actual_grids, count(*) AS row_count, count(DISTINCT idempotency_key) AS distinct_keys, count(DISTINCT slot) AS slots, count(DISTINCT h % 4) AS runs, count(DISTINCT nx) AS raw_objects, 0 AS unexpected_rows, 5 - count(DISTINCT nx) AS missing_grids, count(DISTINCT nx) FILTER (per <> 8) AS odd_grids FROM own""")
def s19(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = observed_rows(spark, sf_dir).where(c("observed_slot") == AS_OF.strftime("%Y-%m-%dT%H:%M:%S"))
    return ingest.slot_check(_cells(spark).withColumn("source_revision", F.lit("r1")), rows)


@register("e12_observed_truth", _SQL_OBSERVED + """, snap AS (SELECT grid_id, observed_at, max(x) FILTER (i = 3) AS t, max(x) FILTER (i = 0) AS pty, max(x) FILTER (i = 2) AS rn1 FROM good GROUP BY ALL HAVING count(*) = 8 AND count(DISTINCT i) = 8)
    SELECT grid_id, observed_at, 'temperature_air_2m' AS variable, t AS value_double, NULL::BOOLEAN AS value_bool FROM snap UNION ALL SELECT grid_id, observed_at, 'precipitation_occurrence', NULL, pty <> 0 OR rn1 > 0 FROM snap""")
def e12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.observed_truth(observed_rows(spark, sf_dir)).select("grid_id", "observed_at", "variable", "value_double", "value_bool")


@register("e06_many_sources", _SQL_OBSERVED + ", snap AS (SELECT nx, grid_id, observed_at FROM good GROUP BY ALL HAVING count(*) = 8 AND count(DISTINCT i) = 8) SELECT grid_id, observed_at, variable, 2 AS n FROM snap CROSS JOIN (VALUES ('temperature_air_2m'), ('precipitation_occurrence')) t(variable) WHERE nx = 57")
def e06(spark: SparkSession, sf_dir: str) -> DataFrame:
    truth = evaluation.observed_truth(observed_rows(spark, sf_dir)).withColumn("exclusion", F.lit(None).cast("string"))
    both = truth.unionByName(truth.where("nx = 57").withColumn("truth_source", F.lit("other"))).unionByName(truth.where("nx = 58").withColumns({"truth_source": F.lit("other"), "exclusion": F.lit("rejected_truth")}))
    return evaluation.many_sources(both).select("grid_id", "observed_at", "variable", "n")


@register("s11_recorded_events", _BRONZE + "SELECT dag_run_id, status, CASE WHEN status = 'SUCCESS' THEN event_at + INTERVAL 2 HOUR ELSE event_at END AS event_at, 'stored' AS kind FROM manifest WHERE dag_run_id <> 'run_2' OR status <> 'SUCCESS' UNION ALL SELECT dag_run_id, status, event_at, 'refused' FROM manifest WHERE dag_run_id = 'run_2' AND status = 'SUCCESS'")
def s11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events told once and told again later; those of one run have unequal counts."""
    events = feed.manifest(spark, sf_dir)
    events = events.withColumn("actual_rows", F.when(c("dag_run_id") == "run_2", c("actual_rows") - 1).otherwise(c("actual_rows")))
    table = partitions.PartitionedTable(spark, f"{tables.session_folder(spark, 'events')}/rows", partitions.Layout("event_day", "event_at"))
    refused = ingest.record_events(table, events)
    again = events.where("status = 'SUCCESS'").withColumn("event_at", c("event_at") + F.expr("INTERVAL 2 HOURS"))
    ingest.record_events(table, again)
    kind = lambda df, k: df.select("dag_run_id", "status", "event_at", F.lit(k).alias("kind"))
    return kind(table.read(), "stored").unionByName(kind(refused, "refused"))


@register("s23_exact_ids", _BRONZE + ", have AS (SELECT DISTINCT nx FROM bronze WHERE nx <> 58) SELECT (SELECT count(*) FROM grid) AS expected_count, count(*) + 1 AS actual_count, (SELECT count(*) FROM grid WHERE nx NOT IN (SELECT nx FROM have)) AS missing, 1 AS unexpected, 1 AS repeated FROM have")
def s23(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells that came, one of them strange and told twice, against the grid."""
    grid_id = F.concat(F.lit("kma_"), "nx", F.lit("_123")).alias("grid_id")
    came = feed.bronze(spark, sf_dir).where("nx <> 58").select(grid_id).distinct()
    came = came.unionByName(came.limit(1).select(F.explode(F.array(F.lit("kma_x"), F.lit("kma_x"))).alias("grid_id")))
    return ingest.against_expected(feed.grid(spark, sf_dir), came, ["grid_id"], [])


@register("t04_load_dates", _BRONZE + "SELECT request_id, strftime(collected_at + INTERVAL 9 HOUR, '%Y-%m-%d') = load_date AS good FROM bronze")
def t04_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, refused = tables.dated_events(feed.bronze(spark, sf_dir).withColumn("event_at", c("collected_at")))
    return good.select("request_id", F.lit(True).alias("good")).unionByName(refused.select("request_id", F.lit(False).alias("good")))


# Reference data.
_SQL_MASTER = """WITH master AS (SELECT CASE WHEN s_suppkey % 3 = 0 THEN '20240101' ELSE '20240701' END AS revision_date, lpad((11000 + s_nationkey)::VARCHAR, 5, '0') || CASE WHEN s_suppkey % 10 = 0 THEN '00000' ELSE lpad(s_suppkey::VARCHAR, 5, '0') END AS unit_code,
    CASE WHEN s_nationkey < 13 THEN 'A' ELSE 'B' END AS city_name, 'region ' || s_nationkey AS region_name, 'unit ' || s_suppkey AS unit_name, CASE WHEN s_suppkey % 7 = 0 THEN '20240301' END AS removed_on, s_suppkey FROM supplier)"""


def _master(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, n = c("s_suppkey"), c("s_nationkey")
    code = F.concat(F.lpad((n + 11000).cast("string"), 5, "0"), F.when(k % 10 == 0, "00000").otherwise(F.lpad(k.cast("string"), 5, "0")))
    return read(spark, sf_dir, "supplier").select(
        F.when(k % 3 == 0, "20240101").otherwise("20240701").alias("revision_date"), code.alias("unit_code"), F.when(n < 13, "A").otherwise("B").alias("city_name"), F.concat(F.lit("region "), n).alias("region_name"),
        F.concat(F.lit("unit "), k).alias("unit_name"), F.when(k % 7 == 0, "20240301").alias("removed_on"), "s_suppkey",
    )


@register("m14_admin_units", _SQL_MASTER + """SELECT unit_code, left(unit_code, 5) AS region_code, region_name, unit_name, CASE WHEN s_suppkey % 2 = 0 THEN 37 + s_suppkey / 1000 END AS latitude FROM master
    WHERE revision_date = (SELECT max(revision_date) FROM master) AND city_name = 'A' AND NOT ends_with(unit_code, '00000') AND removed_on IS NULL""")
def m14(spark: SparkSession, sf_dir: str) -> DataFrame:
    master = _master(spark, sf_dir)
    centres = master.where("s_suppkey % 2 = 0 AND s_suppkey % 10 <> 0").select(c("unit_code").alias("admin_dong_code"), F.lit("d").alias("stat_dong_code"), F.lit("g").alias("stat_gu_code"), (F.lit(37.0) + c("s_suppkey") / 1000).alias("latitude"), F.lit(127.0).alias("longitude"))
    return models.admin_units(master.drop("s_suppkey"), centres, "A").select("unit_code", "region_code", "region_name", "unit_name", "latitude")


@register("m15_legal_links", "WITH links AS (SELECT l_partkey AS legal_code, l_suppkey AS unit_code, CASE WHEN l_linenumber % 2 = 0 THEN '20240101' ELSE '20240701' END AS revision_date, CASE WHEN l_tax > 0.04 THEN 'A' ELSE 'B' END AS city_name FROM lineitem) SELECT DISTINCT legal_code, unit_code, revision_date FROM links WHERE revision_date = (SELECT max(revision_date) FROM links) AND city_name = 'A'")
def m15(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "lineitem").select(c("l_partkey").alias("legal_code"), c("l_suppkey").alias("unit_code"), F.when(c("l_linenumber") % 2 == 0, "20240101").otherwise("20240701").alias("revision_date"), F.when(c("l_tax") > 0.04, "A").otherwise("B").alias("city_name"))
    return models.legal_links(rows, "A")


_SQL_SIDES = """WITH a AS (SELECT lpad((11000 + s_nationkey)::VARCHAR, 5, '0') || lpad(s_suppkey::VARCHAR, 5, '0') AS code, 'region' || s_nationkey AS region, '면목' || s_suppkey || '동' AS k FROM supplier),
    b AS (SELECT 's' || lpad(s_suppkey::VARCHAR, 6, '0') AS stat_code, 'region' || s_nationkey AS region, CASE WHEN s_suppkey % 5 = 0 THEN 'x' || s_suppkey ELSE '면목' || s_suppkey || '동' END AS k FROM supplier WHERE s_suppkey % 3 <> 0)
"""


def _sides(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    s, k = read(spark, sf_dir, "supplier"), c("s_suppkey")
    code = F.concat(F.lpad((c("s_nationkey") + 11000).cast("string"), 5, "0"), F.lpad(k.cast("string"), 5, "0"))
    a = s.select(code.alias("code"), F.concat(F.lit("region "), "s_nationkey").alias("region"), F.concat(F.lit("면목제"), k, F.lit(" 동")).alias("name"))
    name = F.when(k % 5 == 0, F.concat(F.lit("x·"), k)).otherwise(F.concat(F.lit("면목"), k, F.lit("·동")))
    b = s.where("s_suppkey % 3 <> 0").select(F.concat(F.lit("s"), F.lpad(k.cast("string"), 6, "0")).alias("stat_code"), F.lit("g").alias("stat_region_code"), F.concat(F.lit("region"), "s_nationkey").alias("region"), name.alias("name"))
    return models.crosswalk(a, b)


@register("j10_crosswalk_sides", _SQL_SIDES + "SELECT coalesce(a.region, b.region) || '|' || coalesce(a.k, b.k) AS key, CASE WHEN a.k IS NULL THEN 'unmatched_b' WHEN b.k IS NULL THEN 'unmatched_a' ELSE 'matched' END AS state, code, stat_code FROM a FULL JOIN b ON a.region = b.region AND a.k = b.k")
def j10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sides(spark, sf_dir)["sides"].select("key", "state", "code", "stat_code")


@register("j11_boundaries", _SQL_SIDES + ", m AS (SELECT code, stat_code FROM a JOIN b ON a.region = b.region AND a.k = b.k) SELECT dong_code, code AS admin_dong_code, left(code, 5) AS gu_code FROM (SELECT 's' || lpad(s_suppkey::VARCHAR, 6, '0') AS dong_code FROM supplier) LEFT JOIN m ON dong_code = stat_code")
def j11(spark: SparkSession, sf_dir: str) -> DataFrame:
    shapes = read(spark, sf_dir, "supplier").select(F.concat(F.lit("s"), F.lpad(c("s_suppkey").cast("string"), 6, "0")).alias("dong_code"))
    return models.boundaries(shapes, _sides(spark, sf_dir)["matched"]).select("dong_code", "admin_dong_code", "gu_code")


# Pages bound to a publication and a query.
@register("k03_bound_pages", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 300")
def k03_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three pages, each read behind the cursor of the one before."""
    rows, order = read(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), ["o_totalprice", "o_orderkey"]
    query, cursor, pages = core.fingerprint("orders", {"order": order}), None, []
    for _ in range(3):
        page, cursor = core.bound_page(rows, order, 100, "publication-1", query, cursor)
        pages += page
        if cursor is None:
            break
    return spark.createDataFrame(pages, rows.schema)


# Values as classes, and metrics of products.
@register("a04_semantic_amounts", SQL_ALL + """SELECT place_id, forecast_at, max(value_num) FILTER (category = 'PCP') AS pcp_mm, max(value_num) FILTER (category = 'SNO') AS sno_cm, max(value_num) FILTER (category = 'TMP') AS temp_c
    FROM (SELECT *, dense_rank() OVER (PARTITION BY place_id, forecast_at ORDER BY issued_at DESC NULLS LAST) AS k FROM place_mart) WHERE k = 1 GROUP BY 1, 2""")
def a04(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly outlooks that take amounts from classified values: 2.0mm is a number here."""
    return models.place_hourly(feed.kept(spark, sf_dir).place_mart, value_source="semantic").select("place_id", "forecast_at", "pcp_mm", "sno_cm", "temp_c")
