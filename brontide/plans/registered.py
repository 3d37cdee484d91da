"""Registered queries of the models, evaluation, assertions, slots and published queries, each
over the driver's whole tables, with the SQL that says the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brontide.functions import geo, text, time_axes, values
from brontide.operators import core
from brontide.plans import assertions, evaluation, feed, models, ops, publication, published, published_sql, refresh, slots
from brontide.plans.feed import AS_OF, SOURCE, SQL_ALL, SQL_BRONZE, SQL_MARTS, SQL_SILVER, read
from brontide.plans.registry import register
from brontide.sources import ingest, partitions, tables

_T = f"TIMESTAMP '{AS_OF}'"
_BRONZE, _SILVER = f"WITH {SQL_BRONZE} ", f"WITH {SQL_BRONZE}, {SQL_SILVER} "
_VALUES = ["value_representation", "value_num", "value_lower_bound", "value_upper_bound", "qualitative_code"]
_KEY = "place_id, nx, ny, issued_at, category, forecast_at"


def _product(name: str, sql_table: str, make, exclude: tuple[str, ...] = ()):
    """Registers a product of the model graph, all its columns: made from the products before it,
    which the session has written."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return make(feed.kept(spark, sf_dir)).drop(*exclude)

    register(name, f"{SQL_ALL} SELECT * FROM {sql_table}")(run)


# Models.
@register("m01_run_states", _BRONZE + "SELECT dag_run_id, status, is_publishable, event_at, state_tie_count FROM states")
def m01(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.run_states(feed.manifest(spark, sf_dir), SOURCE).select("dag_run_id", "status", "is_publishable", "event_at", "state_tie_count")


@register("j13_never_coalesced", _BRONZE + "SELECT DISTINCT dag_run_id FROM manifest WHERE status = 'SUCCESS' AND dag_run_id NOT IN (SELECT dag_run_id FROM manifest WHERE status = 'COALESCED')")
def j13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return core.never_coalesced(feed.manifest(spark, sf_dir))


@register("m02_silver", _SILVER + f"SELECT {_KEY}, fcst_value_raw, fcst_value_num, {', '.join(_VALUES)}, forecast_lead_hours, raw_object_key, collected_at, dag_run_id FROM silver")
def m02(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed.kept(spark, sf_dir).silver.select(*_KEY.split(", "), "fcst_value_raw", "fcst_value_num", *_VALUES, "forecast_lead_hours", "raw_object_key", "collected_at", "dag_run_id")


_MART = "category, issued_at, forecast_at, fcst_value_raw, fcst_value_num, raw_object_key, collected_at, dag_run_id"


@register("m05_grid_mart", f"{SQL_ALL} SELECT grid_id, coverage_scope, nx, ny, {_MART} FROM grid_mart")
def m05(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed.kept(spark, sf_dir).grid_mart.select("grid_id", "coverage_scope", "nx", "ny", *_MART.split(", "))


@register("m06_place_mart", f"{SQL_ALL} SELECT place_id, place_name, gu, admin_dong_code, {_MART} FROM place_mart")
def m06(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed.kept(spark, sf_dir).place_mart.select("place_id", "place_name", "gu", "admin_dong_code", *_MART.split(", "))


_product("m03_coverage_grid", "grid", lambda p: p.grid)
register("m04_places", _BRONZE + "SELECT place_id, place_name, alias_names, gu, admin_dong, latitude, longitude, nx, ny, admin_dong_code, gu_code FROM places")(lambda spark, sf_dir: feed.places(spark, sf_dir).drop("mapping_method", "grid_distance_m", "source_admin_code"))
_product("m07_place_hourly_outlook", "hourly", lambda p: p.hourly)
_product("m08_grid_hourly_outlook", "grid_hourly", lambda p: p.grid_hourly)
_product("m09_place_current_outlook", "current", lambda p: p.tables["current"])
_product("m09_grid_current_outlook", "grid_current", lambda p: p.tables["grid"])
_product("m10_place_precipitation_windows", "windows", lambda p: p.tables["windows"])
_product("m10_grid_precipitation_windows", "grid_windows", lambda p: p.tables["grid_windows"])
_product("m11_risk_windows", "risk", lambda p: p.tables["risk"])
_DATED = "forecast_date::VARCHAR AS forecast_date"


def _dated(df: DataFrame) -> DataFrame:
    """Dates as text, as engines differ in how they hand dates over."""
    return df.withColumns({c: F.col(c).cast("string") for c, t in df.dtypes if t == "date"})


register("m12_forecast_change", f"{SQL_ALL} SELECT * REPLACE ({_DATED}) FROM change")(lambda spark, sf_dir: _dated(feed.kept(spark, sf_dir).tables["change"]))

_HORIZON = f"""
, src AS (SELECT place_id, forecast_at, risk_evidence_collected_at_min AS lo, risk_evidence_collected_at_max AS hi,
    risk_evidence_collected_category_count = 5 AND temp_c IS NOT NULL AND wind_ms IS NOT NULL AND pty_code IS NOT NULL AND pcp_raw IS NOT NULL AND sno_raw IS NOT NULL AS ok FROM hourly WHERE forecast_at >= {_T}),
steps AS (SELECT forecast_at, lag(forecast_at) OVER (ORDER BY forecast_at) AS b, lead(forecast_at) OVER (ORDER BY forecast_at) AS a FROM (SELECT DISTINCT forecast_at FROM src)),
horizon AS (SELECT coalesce(min(CASE WHEN forecast_at = b + INTERVAL 3 HOUR AND a = forecast_at + INTERVAL 3 HOUR THEN forecast_at END) - INTERVAL 3 HOUR, max(forecast_at)) AS h FROM steps),
slot AS (SELECT unnest(generate_series({_T}, h, INTERVAL 1 HOUR)) AS s FROM horizon WHERE h IS NOT NULL),
matrix AS (SELECT p.place_id, s, coalesce(ok, false) AS ok, lo, hi FROM places p CROSS JOIN slot LEFT JOIN src ON src.place_id = p.place_id AND forecast_at = s),
roll AS (SELECT place_id, count(*) AS n, count(*) FILTER (ok) AS good, min(s) FILTER (NOT ok) AS gap FROM matrix GROUP BY 1),
prefix AS (SELECT m.place_id, min(s) AS f, max(s) AS t, min(lo) AS lo, max(hi) AS hi FROM matrix m JOIN roll USING (place_id) WHERE ok AND (gap IS NULL OR s < gap) GROUP BY 1),
revision AS (SELECT 'places:' || sha256('[' || string_agg('["' || place_id || '","' || admin_dong || '","' || gu || '"]', ',' ORDER BY place_id) || ']') AS r FROM places)
SELECT p.place_id, r AS source_population_revision, f AS available_from_at, t AS available_to_at, lo AS forecast_collected_at_min, hi AS forecast_collected_at_max, coalesce(n, 0) AS expected_forecast_hour_count,
    coalesce(good, 0) AS observed_forecast_hour_count, {_T} AS snapshot_as_of_hour, CASE WHEN n > 0 AND good = n THEN 'complete' ELSE 'incomplete' END AS availability_status
FROM places p CROSS JOIN revision LEFT JOIN roll USING (place_id) LEFT JOIN prefix USING (place_id)
"""
register("m13_availability", SQL_ALL + _HORIZON)(lambda spark, sf_dir: feed.kept(spark, sf_dir).tables["availability"])


@register("m17_place_aliases", _BRONZE + "SELECT place_id, gu, replace(admin_dong, ' ', '') AS alias_key FROM places")
def m17(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.place_reference(feed.places(spark, sf_dir), "places:", "^place_[0-9]+$")["aliases"]


@register("j21_resolve_place", _BRONZE + "SELECT asked, place_id FROM (SELECT 'unit  ' || n_nationkey % 30 AS asked FROM nation) LEFT JOIN places ON replace(asked, ' ', '') = replace(admin_dong, ' ', '')")
def j21(spark: SparkSession, sf_dir: str) -> DataFrame:
    aliases = models.place_reference(feed.places(spark, sf_dir), "places:", "^place_[0-9]+$")["aliases"]
    asked = read(spark, sf_dir, "nation").select(F.concat(F.lit("unit  "), F.col("n_nationkey") % 30).alias("asked"))
    return models.resolve_place(asked, aliases, "asked").select("asked", F.explode_outer("place_ids").alias("place_id"))


# Scalar functions.
@register("p01_value_semantics", _SILVER + f"SELECT category, fcst_value_raw, {', '.join(_VALUES)}, count(*) AS row_count FROM silver GROUP BY ALL")
def p01(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed.kept(spark, sf_dir).silver.groupBy("category", "fcst_value_raw", *_VALUES).agg(F.count("*").alias("row_count"))


@register("p03_time_axes", """SELECT event_id, date_trunc('minute', ts) AS from_parts, date_trunc('second', ts) AS from_text, ts + INTERVAL 9 HOUR AS local_at, date_sub('hour', ts, TIMESTAMP '2024-02-01 00:30:00') AS lead_hours,
    date_trunc('hour', ts - INTERVAL 20 MINUTE) - to_hours(CAST((hour(ts - INTERVAL 20 MINUTE) + 1) % 3 AS INT)) AS issue_at, date_trunc('hour', ts - INTERVAL 10 MINUTE) AS slot_at FROM events""")
def p03(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("ts").cast("timestamp_ntz")
    return read(spark, sf_dir, "events").select(
        "event_id",
        time_axes.wall_clock_from_parts(F.date_format(t, "yyyyMMdd"), F.date_format(t, "HHmm")).alias("from_parts"),
        time_axes.wall_clock(F.date_format(t, "yyyy-MM-dd HH:mm:ss")).alias("from_text"),
        time_axes.utc_to_local(t).alias("local_at"),
        time_axes.lead_hours(t, F.lit("2024-02-01 00:30:00").cast("timestamp_ntz")).alias("lead_hours"),
        time_axes.latest_issue(t).alias("issue_at"),
        time_axes.published_slot(t).alias("slot_at"),
    )


_SP = "[[:space:]]"
#: The shapes of secrets as RE2 has them: it has no look-around, so what it would look at is kept.
_SHAPES = (
    (r"(https?://openapi\.seoul\.go\.kr(?::\d+)?/)[^/\s?#]+(/)", r"\1***REDACTED***\2", "gi"),
    (r"""([/\s"''=:])[A-Za-z0-9%._\-]{6,}(/(?:json|xml)/)""", r"\1***REDACTED***\2", "gi"),
    (r"(authorization\s*[:=]\s*)(?:bearer\s+)?\S+", r"\1***REDACTED***", "gi"),
    (r"\bAKIA[0-9A-Z]{16}\b", "***REDACTED***", "g"),
    (r"(://)[^/@\s]{1,256}(@)", r"\1***REDACTED***\2", "g"),
    (r"""((?:service[_-]?key|api[_-]?key|access[_-]?key[_-]?id|secret[_-]?access[_-]?key|access[_-]?key|credential|signature|password|passwd|secret|token|pwd)\s*[=:]\s*["'']?)[^\s"''&;]+""", r"\1***REDACTED***", "gi"),
)


def _sql_masked(text_sql: str) -> str:
    for shape, left, flags in _SHAPES:
        text_sql = f"regexp_replace({text_sql}, '{shape}', '{left}', '{flags}')"
    return text_sql


@register("p16_masked_texts", f"SELECT doc_id, {_sql_masked('text')} AS masked FROM documents")
def p16(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").select("doc_id", text.masked(F.col("text")).alias("masked"))


@register("p16_masked_all_texts", f"SELECT doc_id, md5({_sql_masked('text')}) AS masked_md5, contains({_sql_masked('text')}, '***REDACTED***') AS found FROM documents")
def p16_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What masking makes of every document, as digest, and whether it found anything."""
    masked = text.masked(F.col("text"))
    return read(spark, sf_dir, "documents").select("doc_id", F.md5(masked.cast("binary")).alias("masked_md5"), F.contains(masked, F.lit(text.MASK)).alias("found"))


def _sql_neutral(text_sql: str) -> str:
    for code, shown in ((92, r"\\"), (13, r"\r"), (10, r"\n"), (9, r"\t"), *((c, f"\\u{c:04x}") for c in text.CONTROLS if c)):
        text_sql = f"replace({text_sql}, chr({code}), '{shown}')"
    return text_sql


@register("p17_neutral_logs", f"SELECT conv_id, turn, CASE WHEN length(t) > 200 THEN left(t, 200) || '…(+' || (length(t) - 200) || ')' ELSE t END AS neutral FROM (SELECT conv_id, turn, {_sql_neutral('text || chr(27) || chr(133) || chr(8232)')} AS t FROM conversations)")
def p17(spark: SparkSession, sf_dir: str) -> DataFrame:
    logged = F.concat("text", F.lit("\x1b\x85\u2028"))
    return read(spark, sf_dir, "conversations").select("conv_id", "turn", text.neutral(logged, 200).alias("neutral"))


_UNIT = "' 면목제' || p_partkey % 9 || '.' || p_size || '  동'"


@register("p18_alias_keys", f"""SELECT DISTINCT p_partkey, alias_key FROM (SELECT p_partkey, unnest([k, j, replace(k, '.', '·'), replace(k, '.', ''), replace(j, '.', '·'), replace(j, '.', '')]) AS alias_key
    FROM (SELECT p_partkey, replace({_UNIT}, ' ', '') AS k, regexp_replace(replace({_UNIT}, ' ', ''), '제([0-9])', '\\1', 'g') AS j FROM part))""".replace("\\\\", "\\"))
def p18(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.concat(F.lit(" 면목제"), F.col("p_partkey") % 9, F.lit("."), F.col("p_size"), F.lit("  동"))
    return read(spark, sf_dir, "part").select("p_partkey", F.explode(text.alias_keys(name)).alias("alias_key"))


@register("p19_unit_names", f"SELECT p_partkey, replace(replace(regexp_replace({_UNIT}, '제([0-9])', '\\1', 'g'), ' ', ''), '.', '') AS stripped, replace(replace({_UNIT} || '·-', ' ', ''), '.', '')[:-3] || '-' AS plain FROM part".replace("\\\\", "\\"))
def p19(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.concat(F.lit(" 면목제"), F.col("p_partkey") % 9, F.lit("."), F.col("p_size"), F.lit("  동"))
    return read(spark, sf_dir, "part").select("p_partkey", text.unit_name(name, True).alias("stripped"), text.unit_name(F.concat(name, F.lit("·-"))).alias("plain"))


_ITEM = "strftime(issued_at, '%Y%m%d') || '\",\"V:' || strftime(issued_at, '%H%M') || '\",\"V:' || nx || '\",\"V:' || ny || '\",\"V:' || category || '\",\"V:' || strftime(forecast_at, '%Y%m%d') || '\",\"V:' || strftime(forecast_at, '%H%M') || '\",\"V:' || fcst_value_raw"


@register("p07_item_signature", _BRONZE + f"SELECT raw_object_key, sha256('[\"V:' || {_ITEM} || '\"]') AS signature FROM bronze")
def p07(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed.bronze(spark, sf_dir).select("raw_object_key", values.item_signature({k: F.col(k) for k in values.ITEM_FIELDS}).alias("signature"))


@register("p20_record_identity", """SELECT o_orderkey, sha256('{"key":' || o_orderkey || ',"none":null,"status":"' || o_orderstatus || '"}') AS record_id, CASE WHEN s < 0 THEN '-' ELSE '' END || printf('%02d:%02d:%02d', abs(s) // 3600, abs(s) % 3600 // 60, abs(s) % 60) AS duration
    FROM (SELECT *, o_orderkey % 500000 - 3600 AS s FROM orders)""")
def p20(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    return read(spark, sf_dir, "orders").select("o_orderkey", text.identity(status=F.col("o_orderstatus"), key=key, none=F.lit(None).cast("string")).alias("record_id"), text.clock(key % 500000 - 3600).alias("duration"))


@register("p24_canonical_texts", "SELECT o_orderkey, o_orderkey::VARCHAR AS as_integer, format('{:.17g}', o_totalprice / 3) AS as_real, nfc_normalize(o_orderstatus || 'e' || chr(769)) AS as_text FROM orders")
def p24(spark: SparkSession, sf_dir: str) -> DataFrame:
    third = F.col("o_totalprice").cast("double") / 3
    return read(spark, sf_dir, "orders").select("o_orderkey", text.canonical(F.col("o_orderkey"), "INTEGER", "bigint").alias("as_integer"), text.canonical(third, "REAL").alias("as_real"), text.canonical(F.concat("o_orderstatus", F.lit("e\u0301")), "TEXT", "string").alias("as_text"))


# Joins, windows and upserts.
@register("j09_points_in_polygons", "SELECT s_suppkey, n_nationkey FROM supplier JOIN nation ON s_suppkey % 100 / 10.0 >= n_nationkey % 5 AND s_suppkey % 100 / 10.0 < n_nationkey % 5 + 1.25 AND s_suppkey % 37 / 10.0 >= n_nationkey // 5 AND s_suppkey % 37 / 10.0 < n_nationkey // 5 + 1.25")
def j09(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("n_nationkey")
    x, y = k % 5, F.floor(k / 5)
    corner = lambda dx, dy: F.concat_ws(" ", (x + dx).cast("double"), (y + dy).cast("double"))
    wkt = F.concat(F.lit("POLYGON (("), F.concat_ws(", ", corner(0, 0), corner(1.25, 0), corner(1.25, 1.25), corner(0, 1.25), corner(0, 0)), F.lit("))"))
    shapes = read(spark, sf_dir, "nation").select("n_nationkey", geo.ring_of(wkt).alias("ring"))
    points = read(spark, sf_dir, "supplier").select("s_suppkey", (F.col("s_suppkey") % 100 / 10.0).alias("x"), (F.col("s_suppkey") % 37 / 10.0).alias("y"))
    return geo.points_in_polygons(points, shapes, "x", "y", "ring", 0.5).select("s_suppkey", "n_nationkey")


@register("p11_geographic")
def p11(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "customer").select("c_custkey", (F.lit(190_000.0) + F.col("c_custkey") % 20_000).alias("x"), (F.lit(440_000.0) + F.col("c_custkey") % 20_000).alias("y"))
    return geo.with_geographic(rows, "x", "y")


@register("w03_newest_two_issues", _SILVER + f"SELECT {_KEY} FROM (SELECT *, dense_rank() OVER (PARTITION BY nx, ny, forecast_at ORDER BY issued_at DESC) AS k FROM silver) WHERE k <= 2")
def w03(spark: SparkSession, sf_dir: str) -> DataFrame:
    return core.newest_issues(feed.kept(spark, sf_dir).silver, ["nx", "ny", "forecast_at"], "issued_at", 2).select(*_KEY.split(", "))


@register("w10_daily_admission", "SELECT event_id, ts::DATE::VARCHAR AS day, row_number() OVER (PARTITION BY ts::DATE ORDER BY ts, event_id) <= 200 AS admitted FROM events")
def w10(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "events").select("event_id", F.to_date("ts").alias("day"), "ts", "event_type")
    return _dated(core.admitted(rows, "event_id", "day", "ts", 200).select("event_id", "day", "admitted"))


@register("w06_order_islands", """SELECT o_custkey, w AS window_number, count(*) AS n, min(o_orderdate) AS start_at, max(o_orderdate) AS end_at FROM (
    SELECT *, sum(f) OVER (PARTITION BY o_custkey ORDER BY o_orderdate ROWS UNBOUNDED PRECEDING) AS w FROM (
        SELECT *, CASE WHEN coalesce(date_sub('hour', lag(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate), o_orderdate), 9999) > 720 THEN 1 ELSE 0 END AS f FROM (SELECT DISTINCT o_custkey, o_orderdate FROM orders)))
    GROUP BY 1, 2""")
def w06(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "orders").select("o_custkey", "o_orderdate").distinct()
    return core.islands(rows, ["o_custkey"], "o_orderdate", 720).groupBy("o_custkey", "window_number").agg(F.count("*").alias("n"), F.min("o_orderdate").alias("start_at"), F.max("o_orderdate").alias("end_at"))


@register("a07_winner", "SELECT l_partkey, max_by(l_orderkey, struct_pack(d := l_shipdate, o := l_orderkey, l := l_linenumber)) AS l_orderkey FROM lineitem GROUP BY 1")
def a07(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "lineitem").select("l_partkey", "l_orderkey", "l_shipdate", "l_linenumber")
    return core.winner(rows, ["l_partkey"], ["l_shipdate", "l_orderkey", "l_linenumber"]).select("l_partkey", "l_orderkey")


@register("j17_asof_vintages", _SILVER + """, want AS (SELECT DISTINCT nx, category, forecast_at, label, h FROM silver CROSS JOIN (VALUES ('D-1', 24), ('H-18', 18)) v(label, h)),
    fit AS (SELECT s.*, label FROM silver s JOIN (VALUES ('D-1', 24), ('H-18', 18)) v(label, h) ON s.issued_at <= s.forecast_at - to_hours(h) AND s.issued_at >= s.forecast_at - to_hours(h + 3))
    SELECT w.nx, w.category, w.forecast_at AS valid_at, w.label AS vintage_label, max(f.issued_at) AS issued_at FROM want w LEFT JOIN fit f ON w.nx = f.nx AND w.category = f.category AND w.forecast_at = f.forecast_at AND w.label = f.label GROUP BY ALL""")
def j17(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = feed.kept(spark, sf_dir).silver.select("nx", "category", F.col("forecast_at").alias("valid_at"), "issued_at", "raw_object_key")
    return core.asof_windows(rows, rows, ["nx", "category"], "valid_at", "issued_at", {"D-1": 24, "H-18": 18}, 3, ["issued_at", "raw_object_key"]).drop("raw_object_key")


@register("t00_upsert", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey % 3 <> 0 UNION ALL SELECT o_orderkey, o_totalprice * 2 FROM orders WHERE o_orderkey % 3 = 0")
def t00(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = read(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice").where("o_orderkey % 6 <> 0")
    new = read(spark, sf_dir, "orders").where("o_orderkey % 3 = 0").select("o_orderkey", (F.col("o_totalprice") * 2).alias("o_totalprice"))
    return tables.upserted(old, new, ["o_orderkey"])


@register("t04_coalesced_runs", _BRONZE + "SELECT dag_run_id, CASE WHEN rn = 1 THEN 'SUCCESS' ELSE 'COALESCED' END AS status, rn = 1 AS is_publishable FROM (SELECT *, row_number() OVER (ORDER BY event_at DESC, dag_run_id DESC) AS rn FROM manifest WHERE status = 'SUCCESS')")
def t04(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.coalesced(feed.manifest(spark, sf_dir).where("status = 'SUCCESS'")).select("dag_run_id", "status", "is_publishable")


@register("t01_watermark", _SILVER + "SELECT request_id FROM bronze WHERE collected_at >= (SELECT max(collected_at) - INTERVAL 30 MINUTE FROM silver)")
def t01(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = feed.kept(spark, sf_dir)
    return core.after_watermark(p.bronze, p.silver, "collected_at").select("request_id")


def _table(spark: SparkSession, name: str, layout: partitions.Layout) -> partitions.PartitionedTable:
    return partitions.PartitionedTable(spark, f"{tables.session_folder(spark, name)}/rows", layout)


@register("s08_replaced_run", _BRONZE + "SELECT request_id, load_date, dag_run_id, fcst_value_raw AS fcst_value FROM bronze")
def s08(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run that was loaded in part, a day off and with other values, is loaded again."""
    rows = feed.bronze(spark, sf_dir).select("source_id", "request_id", "load_date", "dag_run_id", "fcst_value")
    mine = F.col("dag_run_id") == "run_1"
    off = F.date_format(F.date_add(F.to_date("load_date"), 1), "yyyy-MM-dd")
    table = _table(spark, "replaced-run", partitions.COLLECTED)
    table.append(rows.where(~mine | F.col("request_id").endswith("1")).withColumns({"load_date": F.when(mine, off).otherwise(F.col("load_date")), "fcst_value": F.when(mine, "old").otherwise(F.col("fcst_value"))}))
    table.replace_run(rows.where(mine), SOURCE, "run_1")
    return table.read().select("request_id", "load_date", "dag_run_id", "fcst_value")


_MERGED_AT = AS_OF.replace(day=16)


@register("t01_silver_merge", _SILVER + f"SELECT {_KEY}, fcst_value_raw, value_representation, value_num, raw_object_key, collected_at FROM silver")
def t01_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver merged in two steps, the second behind the look-back watermark, by days of forecasts."""
    table, rows, states = _table(spark, "silver", partitions.FORECAST), feed.bronze(spark, sf_dir), feed.manifest(spark, sf_dir)
    for part in (rows.where(F.col("collected_at") < time_axes.literal_hour(_MERGED_AT)), rows):
        refresh.merge_silver(table, part, states, SOURCE)
    return table.read().select(*_KEY.split(", "), "fcst_value_raw", "value_representation", "value_num", "raw_object_key", "collected_at")


@register("t02_grid_mart_merge", f"WITH {SQL_BRONZE}, {SQL_SILVER}, {SQL_MARTS.replace(str(AS_OF), str(_MERGED_AT))} SELECT grid_id, coverage_scope, nx, ny, {_MART} FROM grid_mart")
def t02(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The grid mart of one day, refreshed on the next: old partitions go, new winners are merged."""
    table, p = _table(spark, "grid-mart", partitions.FORECAST), feed.kept(spark, sf_dir)
    for as_of in (AS_OF, _MERGED_AT):
        refresh.merge_grid_mart(table, p.silver, p.grid, as_of)
    return table.read().select("grid_id", "coverage_scope", "nx", "ny", *_MART.split(", "))


@register("t05_append_window", _BRONZE + "SELECT request_id, load_date, CASE WHEN collected_at >= TIMESTAMP '2024-01-14 12:00:00' THEN fcst_value_raw ELSE 'old' END AS fcst_value FROM bronze")
def t05(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows from a cutoff on are published anew, whatever stood there before."""
    rows = feed.bronze(spark, sf_dir).select("request_id", "load_date", "collected_at", "fcst_value")
    table = _table(spark, "window", partitions.COLLECTED)
    table.append(rows.withColumn("fcst_value", F.lit("old")))
    table.append_window(rows, "collected_at", AS_OF.replace(day=14, hour=12))
    return table.read().select("request_id", "load_date", "fcst_value")


@register("s28_forecast_days", _SILVER + "SELECT forecast_at::DATE::VARCHAR AS forecast_day, count(*) AS row_count, min(forecast_at) AS first_at, max(forecast_at) AS last_at FROM silver WHERE forecast_at::DATE BETWEEN DATE '2024-01-10' AND DATE '2024-01-20' GROUP BY 1")
def s28(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some days of silver laid out by day: other folders are not listed."""
    table = _table(spark, "forecast-days", partitions.FORECAST)
    table.append(feed.kept(spark, sf_dir).silver)
    rows = table.stored().where(F.col("forecast_day").between(F.lit("2024-01-10").cast("date"), F.lit("2024-01-20").cast("date")))
    return _dated(rows.groupBy("forecast_day").agg(F.count("*").alias("row_count"), F.min("forecast_at").alias("first_at"), F.max("forecast_at").alias("last_at")))


@register("k03_keyset_page", "SELECT o_orderkey, o_totalprice FROM orders WHERE (o_totalprice, o_orderkey) > (250000.0, 10) ORDER BY o_totalprice, o_orderkey LIMIT 101")
def k03(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return core.keyset_page(rows, ["o_totalprice", "o_orderkey"], (250000.0, 10), 100)


# Raw responses: events as response pages, unwrapped again.
@register("s01_unwrapped_items", _BRONZE + "SELECT strftime(issued_at, '%Y%m%d') AS base_date, nx, category, strftime(forecast_at, '%Y%m%d') AS fcst_date, strftime(forecast_at, '%H%M') AS fcst_time, fcst_value_raw AS fcst_value, dag_run_id FROM bronze")
def s01(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = feed.bronze(spark, sf_dir)
    item = F.struct(F.col("base_date").alias("baseDate"), F.col("base_time").alias("baseTime"), "category", F.col("fcst_date").alias("fcstDate"), F.col("fcst_time").alias("fcstTime"), F.col("fcst_value").alias("fcstValue"), "nx", "ny")
    # One raw object for each cell, issue, run and hour of the day: some dozens of items.
    pages = b.groupBy("dag_run_id", "load_date", "base_date", "base_time", "nx", "ny").agg(F.sort_array(F.collect_list(item)).alias("items"))
    body = F.struct(F.lit(1).alias("pageNo"), F.lit(1000).alias("numOfRows"), F.size("items").alias("totalCount"), F.struct(F.col("items").alias("item")).alias("items"))
    content = F.to_json(F.struct(F.struct(F.struct(F.lit("00").alias("resultCode"), F.lit("OK").alias("resultMsg")).alias("header"), body.alias("body")).alias("response")))
    raw = pages.select(F.concat_ws("/", "dag_run_id", "load_date", "base_date", "base_time", "nx", "ny").alias("raw_object_key"), F.encode(content, "UTF-8").alias("content"), F.lit("2024-01-31 00:00:00").cast("timestamp").alias("stored_at"), F.col("load_date").alias("path_load_date"), F.col("dag_run_id").alias("path_run_id"), F.col("nx").cast("string").alias("path_nx"), F.col("ny").cast("string").alias("path_ny"), F.col("base_date").alias("path_base_date"), F.col("base_time").alias("path_base_time"))
    items, _ = ingest.unwrap(raw)
    good = items.where(ingest.forecast_item_reason().isNull())
    return ingest.forecast_bronze(good, SOURCE).select("base_date", "nx", "category", "fcst_date", "fcst_time", "fcst_value", "dag_run_id")


@register("s10_load_check", _BRONZE + "SELECT count(*) AS row_count, count(DISTINCT raw_object_key) AS raw_objects, max(collected_at) AS last_collected_at FROM bronze WHERE dag_run_id = 'run_1'")
def s10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.load_check(feed.bronze(spark, sf_dir), "run_1")


# Evaluation.
@register("a11_continuous_metrics", "SELECT l_returnflag, count(*) AS sample_count, round(avg(abs(l_quantity - l_extendedprice / 1500)), 12) AS mae, round(sqrt(avg((l_quantity - l_extendedprice / 1500) ^ 2)), 12) AS rmse, round(avg(l_quantity - l_extendedprice / 1500), 12) AS bias FROM lineitem GROUP BY 1")
def a11(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "lineitem").withColumn("seen", F.col("l_extendedprice") / 1500)
    out = evaluation.continuous_metrics(rows, ["l_returnflag"], "l_quantity", "seen")
    return out


_PAIRS = "(SELECT l_linestatus AS g, least(l_discount * 8, 1.0) AS p, (l_returnflag = 'R')::INT AS y, least(floor(least(l_discount * 8, 1.0) * 10), 9)::INT AS b FROM lineitem)"


def _probabilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "lineitem").select(F.col("l_linestatus").alias("g"), F.least(F.col("l_discount") * 8, F.lit(1.0)).alias("p"), (F.col("l_returnflag") == "R").alias("y"), "l_quantity", "l_tax")


@register("a12_calibration_bins", f"""SELECT g, i AS bin_index, i / 10.0::DOUBLE AS lower_bound, (i + 1) / 10.0::DOUBLE AS upper_bound, coalesce(n, 0) AS sample_count, round(mp, 12) AS mean_forecast_probability, round(my, 12) AS observed_frequency,
    coalesce(round(abs(round(mp, 12) - round(my, 12)) * n / total, 12), 0.0) AS weighted_absolute_calibration_gap
    FROM (SELECT g, count(*) AS total, unnest(range(10)) AS i FROM {_PAIRS} GROUP BY g) LEFT JOIN (SELECT g, b AS i, count(*) AS n, avg(p) AS mp, avg(y) AS my FROM {_PAIRS} GROUP BY ALL) USING (g, i)""")
def a12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.calibration_bins(_probabilities(spark, sf_dir), ["g"], "p", "y")


@register("a12_probability_metrics", f"SELECT g, sum(n)::BIGINT AS sample_count, round(sum(s) / sum(n), 12) AS brier_score, round(sum(abs(sp - sy)) / sum(n), 12) AS expected_calibration_error FROM (SELECT g, b, count(*) AS n, sum((p - y) ^ 2) AS s, sum(p) AS sp, sum(y) AS sy FROM {_PAIRS} GROUP BY ALL) GROUP BY g")
def a12m(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.probability_metrics(_probabilities(spark, sf_dir), ["g"], "p", "y")


@register("a13_confusion_metrics", """SELECT *, 2 * precision * recall / nullif(precision + recall, 0) AS f1 FROM (SELECT *, true_positive / nullif(true_positive + false_positive, 0) AS precision, true_positive / nullif(true_positive + false_negative, 0) AS recall,
    (true_positive + true_negative) / sample_count AS accuracy, (true_positive + false_negative) / sample_count AS positive_prevalence FROM (
    SELECT l_linestatus AS g, count(*) AS sample_count, count(*) FILTER (l_quantity > 25 AND l_tax > 0.04) AS true_positive, count(*) FILTER (l_quantity > 25 AND NOT l_tax > 0.04) AS false_positive,
    count(*) FILTER (NOT l_quantity > 25 AND NOT l_tax > 0.04) AS true_negative, count(*) FILTER (NOT l_quantity > 25 AND l_tax > 0.04) AS false_negative FROM lineitem GROUP BY 1))""")
def a13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.confusion_metrics(_probabilities(spark, sf_dir), ["g"], F.col("l_quantity") > 25, F.col("l_tax") > 0.04)


_VARIABLES = {"TMP": ("temperature_air_2m", "degC"), "WSD": ("wind_speed", "m/s"), "REH": ("relative_humidity", "percent"), "POP": ("precipitation_probability", "1")}
_INSTANT = lambda c: F.col(c).cast("timestamp")


def _forecasts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Numbers of silver as vintages of four variables, one of them a probability, and truth of
    several revisions, qualities and instants for two hours in three."""
    s = feed.kept(spark, sf_dir).silver.where(F.col("category").isin(*_VARIABLES) & F.col("value_num").isNotNull())
    pick = lambda i: F.try_element_at(F.create_map(*(F.lit(x) for k, v in _VARIABLES.items() for x in (k, v[i]))), "category")
    grid = F.concat_ws("_", F.lit("kma"), "nx", "ny")
    none = [F.lit(None).cast("boolean").alias("value_bool"), F.lit(None).cast("string").alias("value_text")]
    chance = F.col("category") == "POP"
    s = s.withColumns({"variable": pick(0), "unit": pick(1), "kind": F.when(chance, "probability").otherwise("continuous"), "value_double": F.when(chance, F.col("value_num") / 128).otherwise(F.col("value_num"))})
    v = s.select(F.lit("short").alias("product_family"), grid.alias("grid_id"), "nx", "ny", "variable", F.col("kind").alias("value_kind"), "value_double", *none, "unit", _INSTANT("issued_at").alias("issued_at"), _INSTANT("forecast_at").alias("valid_at"), "source_id", F.col("raw_object_key").alias("source_revision"))
    one = s.where(F.hour("forecast_at") % 3 != 0).groupBy(grid.alias("grid_id"), "nx", "ny", "variable", "unit", "kind", _INSTANT("forecast_at").alias("observed_at")).agg(F.max("value_double").alias("y"))
    day, hour, binary = F.dayofmonth("observed_at"), F.hour("observed_at"), F.col("kind") == "probability"
    quality = F.when(day % 7 == 3, "rejected").when(day % 7 == 4, "provisional").otherwise("final")
    revisions = F.explode(F.array(F.struct(F.lit("r1").alias("r"), F.lit(1).alias("late"), F.lit(0).alias("more")), F.struct(F.lit("r2").alias("r"), F.when(hour == 4, 1).otherwise(30).alias("late"), F.when(day % 5 == 0, 2).otherwise(0).alias("more"))))
    t = one.withColumns({"x": revisions, "quality": quality}).withColumn("truth_as_of", F.col("observed_at") + F.make_dt_interval(hours=F.col("x.late")))
    collected = F.col("truth_as_of") + F.make_dt_interval(hours=F.col("nx") % 3 * 20)
    unit = F.when((F.col("nx") == 58) & ~binary, "other").otherwise(F.col("unit"))
    y = F.col("y") + F.col("x.more")
    t = t.select("grid_id", "nx", "ny", "variable", F.when(binary, "binary").otherwise("continuous").alias("value_kind"), F.when(~binary, y).alias("value_double"), F.when(binary, y >= 0.5).alias("value_bool"), none[1], unit.alias("unit"), "observed_at", F.lit("station").alias("truth_source"), F.col("x.r").alias("truth_revision"), "truth_as_of", collected.alias("collected_at"), "quality")
    return v, t


_EVALUATED_AT = AS_OF.replace(day=20)
_E = f"TIMESTAMP '{_EVALUATED_AT}'"
_SQL_TRUTH = _SILVER + f""", num AS (SELECT nx, CASE category {' '.join(f"WHEN '{k}' THEN '{v}'" for k, (v, _) in _VARIABLES.items())} END AS variable, CASE category {' '.join(f"WHEN '{k}' THEN '{u}'" for k, (_, u) in _VARIABLES.items())} END AS unit,
        category = 'POP' AS chance, CASE WHEN category = 'POP' THEN value_num / 128 ELSE value_num END AS x, issued_at, forecast_at, raw_object_key FROM silver WHERE category IN ('TMP', 'WSD', 'REH', 'POP') AND value_num IS NOT NULL),
    one AS (SELECT nx, variable, unit, chance, forecast_at AS o, max(x) AS y FROM num WHERE hour(forecast_at) % 3 <> 0 GROUP BY ALL),
    revised AS (SELECT one.*, r, y + CASE WHEN r = 'r2' AND day(o) % 5 = 0 THEN 2 ELSE 0 END AS v, o + to_hours(CASE WHEN r = 'r1' OR hour(o) = 4 THEN 1 ELSE 30 END) AS as_of, CASE day(o) % 7 WHEN 3 THEN 'rejected' WHEN 4 THEN 'provisional' ELSE 'final' END AS quality FROM one CROSS JOIN (VALUES ('r1'), ('r2')) t(r)),
    truth AS (SELECT *, as_of + to_hours(nx % 3 * 20) AS collected, CASE WHEN nx = 58 AND NOT chance THEN 'other' ELSE unit END AS truth_unit FROM revised),
    early AS (SELECT *, CASE WHEN as_of > {_E} THEN 'future_truth_revision' WHEN collected > {_E} THEN 'future_collection' END AS e FROM truth),
    seen AS (SELECT *, rank() OVER (PARTITION BY nx, variable, o ORDER BY as_of DESC) AS k, row_number() OVER (PARTITION BY nx, variable, o ORDER BY as_of DESC, r DESC) AS n FROM early WHERE e IS NULL),
    conflict AS (SELECT nx, variable, o, count(DISTINCT CASE WHEN chance THEN (v >= 0.5)::VARCHAR ELSE v::VARCHAR END) > 1 AS bad FROM seen WHERE k = 1 GROUP BY ALL),
    resolved AS (SELECT nx, variable, chance, o, r, v, truth_unit, quality, CASE WHEN bad THEN 'conflicting_revisions' WHEN quality = 'rejected' THEN 'rejected_truth' WHEN quality = 'provisional' AND o + INTERVAL 6 HOUR < {_E} THEN 'stale_provisional_truth' END AS e
        FROM seen JOIN conflict USING (nx, variable, o) WHERE n = 1 UNION ALL SELECT nx, variable, chance, o, r, v, truth_unit, quality, e FROM early WHERE e IS NOT NULL)
"""


@register("e05_truth_resolution", _SQL_TRUTH + "SELECT 'kma_' || nx || '_123' AS grid_id, variable, o AS observed_at, r AS truth_revision, CASE WHEN NOT chance THEN v END AS value_double, CASE WHEN chance THEN v >= 0.5 END AS value_bool, e AS exclusion FROM resolved")
def e05(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, t = _forecasts(spark, sf_dir)
    return evaluation.resolve_truth(t, _EVALUATED_AT).select("grid_id", "variable", F.col("observed_at").cast("timestamp_ntz").alias("observed_at"), "truth_revision", "value_double", "value_bool", "exclusion")


_SQL_MATCHED = _SQL_TRUTH + """, labels AS (SELECT * FROM (VALUES ('D-3', 72), ('D-2', 48), ('D-1', 24)) t(label, h)),
    fit AS (SELECT nx, variable, unit, chance, forecast_at AS o, label, max_by(x, struct_pack(a := issued_at, b := raw_object_key)) AS x FROM num JOIN labels ON issued_at <= forecast_at - to_hours(h) AND issued_at >= forecast_at - to_hours(h + 3) GROUP BY ALL),
    matched AS (SELECT fit.*, t.v, t.r, CASE WHEN t.o IS NULL THEN 'missing_or_ineligible_truth' WHEN t.truth_unit <> fit.unit THEN 'incompatible_unit' END AS reason FROM fit LEFT JOIN (SELECT * FROM resolved WHERE e IS NULL) t ON t.nx = fit.nx AND t.variable = fit.variable AND t.o = fit.o)
"""


def _matched(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    v, t = _forecasts(spark, sf_dir)
    picked, resolved = evaluation.select_vintages(v), evaluation.resolve_truth(t, _EVALUATED_AT)
    return picked, resolved, evaluation.match(picked, resolved)


@register("e07_matches", _SQL_MATCHED + "SELECT variable, label AS vintage_label, coalesce(reason, 'matched') AS reason, count(*) AS n FROM matched GROUP BY ALL")
def e07(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, _, rows = _matched(spark, sf_dir)
    return rows.groupBy("variable", "vintage_label", F.coalesce("match_reason", F.lit("matched")).alias("reason")).agg(F.count("*").alias("n"))


_FAMILY = "CASE WHEN chance THEN 'probabilistic' ELSE 'continuous' END"
_SQL_COHORTS = _SQL_MATCHED + f""", cohort AS (SELECT substr(sha256('["short","' || variable || '","' || label || '","' || strftime(o, '%Y-%m-%d %H:%M:%S+00:00') || '","' || {_FAMILY} || '","' || unit || '"]'), 1, 24) AS cohort_id, variable, label AS vintage_label, {_FAMILY} AS metric_family, unit, chance,
        count(*) FILTER (reason IS NULL) AS sample_count, count(*) FILTER (reason = 'missing_or_ineligible_truth') AS missing_truth, count(*) FILTER (reason = 'incompatible_unit') AS incompatible_unit,
        round(avg(round(abs(x - v), 12)) FILTER (reason IS NULL AND NOT chance), 12) AS mae, round(avg(round(x - v, 12)) FILTER (reason IS NULL AND NOT chance), 12) AS bias, round(avg(round((x - (v >= 0.5)::INT) ^ 2, 12)) FILTER (reason IS NULL AND chance), 12) AS brier_score,
        CASE WHEN chance AND count(*) FILTER (reason IS NULL) > 0 THEN count(*) FILTER (reason IS NULL AND x >= 0.5 AND v >= 0.5) END AS true_positive
        FROM matched GROUP BY variable, label, o, unit, chance)
"""


@register("e08_cohorts", _SQL_COHORTS + "SELECT * EXCLUDE (chance), sample_count / 5 AS matched_coverage, CASE WHEN sample_count < 30 OR sample_count / 5 < 0.8 THEN 'insufficient_evidence' ELSE 'sufficient' END AS evidence_state FROM cohort")
def e08(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, _, rows = _matched(spark, sf_dir)
    out = evaluation.cohorts(rows, 5)
    n = lambda k: F.coalesce(F.try_element_at("excluded_counts", F.lit(k)), F.lit(0))
    return out.select("cohort_id", "variable", "vintage_label", "metric_family", "unit", "sample_count", n("missing_or_ineligible_truth").alias("missing_truth"), n("incompatible_unit").alias("incompatible_unit"), "mae", "bias", "brier_score", "true_positive", "matched_coverage", "evidence_state")


@register("e10_exclusion_counts", _SQL_MATCHED + """, series AS (SELECT DISTINCT nx, variable, forecast_at AS o FROM num)
    SELECT 'vintage_gap' AS kind, label AS name, count(*) FILTER (fit.o IS NULL) AS n FROM series CROSS JOIN labels LEFT JOIN fit USING (nx, variable, o, label) GROUP BY label
    UNION ALL SELECT 'truth_excluded', e, count(*) FROM resolved WHERE e IS NOT NULL GROUP BY e""")
def e10(spark: SparkSession, sf_dir: str) -> DataFrame:
    picked, resolved, _ = _matched(spark, sf_dir)
    return evaluation.exclusion_counts(picked, resolved)


@register("e11_claims", _SQL_COHORTS + """SELECT metric_family, metric_name, metric_unit, refusal, count(*) AS n FROM (
    SELECT 'continuous' AS metric_family, m AS metric_name, unit AS metric_unit, 'insufficient_evidence' AS refusal FROM cohort CROSS JOIN (VALUES ('mae'), ('rmse'), ('bias')) t(m) WHERE NOT chance AND sample_count > 0
    UNION ALL SELECT f, m, u, 'insufficient_evidence' FROM cohort CROSS JOIN (VALUES ('probabilistic', 'brier_score', 'probability_squared'), ('probabilistic', 'expected_calibration_error', 'ratio'), ('categorical', 'true_positive', 'count'), ('categorical', 'false_positive', 'count'),
        ('categorical', 'true_negative', 'count'), ('categorical', 'false_negative', 'count'), ('categorical', 'precision', 'ratio'), ('categorical', 'recall', 'ratio'), ('categorical', 'f1', 'ratio'), ('categorical', 'accuracy', 'ratio'), ('categorical', 'positive_prevalence', 'ratio')) t(f, m, u) WHERE chance AND sample_count > 0) GROUP BY ALL""")
def e11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """At five cells every cohort is below the evidence gate, so every claim is refused."""
    _, _, rows = _matched(spark, sf_dir)
    return evaluation.claims(evaluation.cohorts(rows, 5)).groupBy("metric_family", "metric_name", "metric_unit", "refusal").agg(F.count("*").alias("n"))


# Assertions, each over rows spoiled on purpose: how many break it.
def _spoiled(df: DataFrame, column: str, value, where: str) -> DataFrame:
    return df.withColumn(column, F.when(F.expr(where), value).otherwise(F.col(column)))


#: Which rows are spoiled: by the end of a key that both engines have.
_ROW, _PLACE = "raw_object_key LIKE '%77'", "place_id LIKE '%4'"


def _bad(table: str, column: str, value: str, where: str = _ROW) -> str:
    return f"(SELECT * REPLACE (CASE WHEN {where} THEN {value} ELSE {column} END AS {column}) FROM {table})"


_D2 = "right(raw_object_key, 2)"
_NUMERIC = "('" + "', '".join(assertions.NUMERIC) + "')"
#: Silver with rows spoiled in every way that its rules look at, by the end of their key.
_SQL_SPOILED = f""", spoiled AS (
    SELECT * REPLACE (CASE WHEN {_D2} = '77' THEN NULL ELSE fcst_value_raw END AS fcst_value_raw, CASE WHEN {_D2} = '22' THEN lower(category) ELSE category END AS category, CASE WHEN {_D2} = '33' THEN NULL ELSE value_num END AS value_num,
        CASE WHEN {_D2} = '44' THEN NULL ELSE value_lower_bound END AS value_lower_bound, CASE WHEN {_D2} = '55' THEN '9' WHEN {_D2} IN ('56', '57', '58') AND category = 'PTY' THEN '0' ELSE qualitative_code END AS qualitative_code,
        CASE WHEN {_D2} = '66' THEN 'unparseable' ELSE value_representation END AS value_representation, CASE WHEN {_D2} = '88' THEN 'run_x' ELSE dag_run_id END AS dag_run_id),
        CASE WHEN {_D2} = '11' THEN forecast_at + INTERVAL 1 HOUR ELSE forecast_at END AS event_at
    FROM (SELECT * FROM silver UNION ALL SELECT * FROM silver WHERE {_D2} = '99'))"""
_AMOUNT = "(value_representation IN ('quantitative_exact', 'bare_numeric') AND value_num IS NULL) OR (value_representation = 'quantitative_range' AND (value_lower_bound IS NULL OR value_num IS NOT NULL)) OR (value_representation = 'explicit_none' AND (value_num IS NOT NULL OR value_lower_bound IS NOT NULL)) OR value_lower_bound > value_upper_bound"
_WET = f"(SELECT place_id, count(*) AS n FROM hourly WHERE forecast_at >= {_T} AND is_precipitating GROUP BY 1)"
_D_SQL = {
    "D01_not_null": "SELECT count(*) FROM spoiled WHERE fcst_value_raw IS NULL",
    "D01_unique": "SELECT count(*) FROM (SELECT o_custkey FROM orders GROUP BY 1 HAVING count(*) > 1)",
    "D01_accepted": "SELECT count(DISTINCT o_orderstatus) FROM orders WHERE o_orderstatus NOT IN ('F', 'O')",
    "D02": f"SELECT count(*) FROM (SELECT 1 FROM spoiled GROUP BY {_KEY} HAVING count(*) > 1)",
    "D03": f"SELECT count(*) FROM {_bad('places', 'longitude', '10.0', _PLACE)} WHERE longitude IS NOT NULL AND NOT (longitude BETWEEN 124 AND 132 AND latitude BETWEEN 33 AND 43)",
    "D04": f"SELECT (count(*) FILTER (NOT ({_PLACE})) / count(*) < 0.95)::INT FROM places",
    "D05": "SELECT count(DISTINCT dag_run_id) FROM spoiled WHERE dag_run_id NOT IN (SELECT dag_run_id FROM runs)",
    "D06": "SELECT count(*) FROM spoiled WHERE event_at IS DISTINCT FROM forecast_at",
    "D07": f"SELECT count(DISTINCT category) FROM spoiled WHERE category NOT IN ('{"', '".join(assertions.CATEGORIES)}')",
    "D08": f"SELECT count(DISTINCT category) FROM spoiled WHERE category IN {_NUMERIC} AND fcst_value_raw IS NOT NULL AND value_num IS NULL",
    "D09": f"SELECT count(*) FROM spoiled WHERE category IN ('PCP', 'SNO') AND ({_AMOUNT})",
    "D10": "SELECT count(*) FROM (SELECT max(qualitative_code) FILTER (category = 'PTY') AS pty, coalesce(max(value_num) FILTER (category = 'PCP'), max(value_lower_bound) FILTER (category = 'PCP'), 0) AS amount FROM spoiled WHERE category IN ('PTY', 'PCP') GROUP BY place_id, nx, ny, issued_at, forecast_at) WHERE pty = '0' AND amount > 0",
    "D11": "SELECT count(*) FROM (SELECT DISTINCT category, qualitative_code FROM spoiled WHERE (category = 'PTY' AND qualitative_code NOT IN ('0', '1', '2', '3', '4')) OR (category = 'SKY' AND qualitative_code NOT IN ('1', '3', '4')))",
    "D12": "SELECT count(*) FROM (SELECT DISTINCT category, fcst_value_raw FROM spoiled WHERE value_representation = 'unparseable')",
    "D13": "SELECT 1 + (SELECT count(*) FROM grid WHERE nx = 57) + (SELECT count(*) FROM grid WHERE nx = 58)",
    "D14": f"SELECT count(*) FROM {_bad('places', 'gu_code', "'x'", _PLACE)} WHERE gu_code <> left(admin_dong_code, 5) OR admin_dong_code IS NULL",
    "D15_issues": f"SELECT count(*) FROM (SELECT place_id, forecast_at FROM (SELECT place_id, forecast_at, issued_at FROM place_mart UNION SELECT place_id, forecast_at, issued_at - INTERVAL 1 HOUR FROM place_mart WHERE {_PLACE}) GROUP BY ALL HAVING count(*) > 2)",
    "D15_retention": f"SELECT count(*) FROM place_mart WHERE {_PLACE} AND issued_at - INTERVAL 9 DAY < {_T} - INTERVAL 24 HOUR",
    "D16": "SELECT count(*) FROM grid WHERE nx = 57 OR grid_id NOT IN (SELECT grid_id FROM grid_current)",
    "D17": f"SELECT count(*) FROM (SELECT *, lag(e) OVER (PARTITION BY place_id ORDER BY window_start_at) AS before FROM (SELECT *, CASE WHEN {_PLACE} THEN window_end_at + INTERVAL 2 HOUR ELSE window_end_at END AS e FROM windows)) WHERE date_sub('hour', before, window_start_at) <= 1 OR precipitation_hour_count <> date_sub('hour', window_start_at, e) + 1",
    "D18": f"SELECT count(*) FROM {_WET} w FULL JOIN (SELECT place_id, sum(precipitation_hour_count + CASE WHEN {_PLACE} THEN 1 ELSE 0 END) AS m FROM windows WHERE place_id <> 'place_7' GROUP BY 1) x USING (place_id) WHERE n IS DISTINCT FROM m",
    "D19": f"""WITH have AS (SELECT * REPLACE (CASE WHEN {_PLACE} THEN forecast_at + INTERVAL 1 HOUR ELSE forecast_at END AS forecast_at) FROM current),
        want AS (SELECT place_id, min(forecast_at) AS want_at, arg_min(forecast_issued_at_max, forecast_at) AS want_issue FROM hourly WHERE forecast_at >= {_T} GROUP BY 1), both_sides AS (SELECT have.*, want.* FROM have FULL JOIN want ON have.place_id = want.place_id)
        SELECT (SELECT count(*) FROM (SELECT 1 FROM have GROUP BY place_id HAVING count(*) > 1)) + (SELECT count(*) FROM have WHERE place_id IS NULL OR forecast_at IS NULL) + (SELECT count(*) FROM have WHERE forecast_at < {_T})
            + (SELECT count(*) FROM both_sides WHERE forecast_at IS NOT NULL AND forecast_at IS DISTINCT FROM want_at) + (SELECT count(*) FROM both_sides WHERE forecast_at IS NULL) + (SELECT count(*) FROM both_sides WHERE forecast_issued_at_max < want_issue)
            + (SELECT count(*) FROM have WHERE place_id NOT IN (SELECT place_id FROM places)) + (SELECT count(*) FROM have WHERE snapshot_as_of_hour <> {_T})""",
    "D20": f"SELECT count(*) FROM (SELECT * FROM {_bad('change', 'max_temp_change_c', 'max_temp_change_c + 1', _PLACE)} EXCEPT SELECT * FROM change)",
    "D21": f"SELECT count(*) FROM {_bad('hourly', 'forecast_issued_at_min', 'forecast_issued_at_min - INTERVAL 1 HOUR', _PLACE)} WHERE forecast_issued_at_min IS DISTINCT FROM forecast_issued_at_max",
    "D22": f"SELECT 2 * count(*) FROM places WHERE {_PLACE}",
    "D23": f"SELECT count(*) FROM {_bad('risk', 'forecast_at', 'forecast_at - INTERVAL 90 DAY', _PLACE)} WHERE forecast_at < {_T}",
    "D24": "SELECT count(*) FROM (SELECT l_partkey, l_suppkey FROM lineitem GROUP BY ALL HAVING count(*) > 1)",
    "D25": f"SELECT (max(collected_at) IS NULL OR date_sub('minute', max(collected_at), {_T}) > 360)::INT FROM bronze WHERE collected_at < TIMESTAMP '2024-01-14 12:00:00'",
}


def _spoiled_silver(silver: DataFrame) -> DataFrame:
    end, c = F.substring("raw_object_key", -2, 2), F.col
    rows = silver.unionByName(silver.where(end == "99"))
    put = lambda name, value, *ends: F.when(end.isin(*ends), value).otherwise(c(name))
    code = F.when(end == "55", "9").when(end.isin("56", "57", "58") & (c("category") == "PTY"), "0").otherwise(c("qualitative_code"))
    none = F.lit(None)
    return rows.withColumns({
        "fcst_value_raw": put("fcst_value_raw", none, "77"), "event_at": put("event_at", c("event_at") + F.expr("INTERVAL 1 HOUR"), "11"), "category": put("category", F.lower("category"), "22"), "value_num": put("value_num", none, "33"),
        "value_lower_bound": put("value_lower_bound", none, "44"), "qualitative_code": code, "value_representation": put("value_representation", F.lit("unparseable"), "66"), "dag_run_id": put("dag_run_id", F.lit("run_x"), "88"),
    })


@register("d_assertions", SQL_ALL + _SQL_SPOILED + " UNION ALL ".join(f" SELECT '{k}' AS assertion, ({q})::BIGINT AS violations" for k, q in _D_SQL.items()))
def d_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, t = feed.kept(spark, sf_dir), feed.gold(spark, sf_dir)
    runs = core.publishable_runs(models.run_states(p.manifest, SOURCE))
    silver, orders = p.silver, read(spark, sf_dir, "orders")
    hour = lambda n: F.expr(f"INTERVAL {n} HOUR")
    mart = p.place_mart
    older = mart.where(_PLACE).withColumn("issued_at", F.col("issued_at") - hour(1))
    grid = p.grid.unionByName(p.grid.where("nx = 58").withColumns({"grid_id": F.lit("kma_x"), "nx": F.lit(0), "ny": F.lit(0)}))
    spoiled_grid = _spoiled(grid, "coverage_scope", F.lit(None), "nx = 57")
    late = F.col("forecast_at") + hour(1)
    found = {
        "D01_unique": assertions.unique(orders, "o_custkey"),
        "D01_accepted": assertions.accepted_values(orders, "o_orderstatus", ["F", "O"]),
        "D03": assertions.coordinates_in_box(_spoiled(p.places, "longitude", F.lit(10.0), _PLACE), "longitude", "latitude"),
        "D04": assertions.coverage(_spoiled(p.places, "longitude", F.lit(None), _PLACE), "longitude", 0.95),
        "D13": assertions.canonical_grid(spoiled_grid),
        "D14": assertions.admin_axis(_spoiled(p.places, "gu_code", F.lit("x"), _PLACE)),
        "D15_issues": assertions.issue_window(mart.unionByName(older)),
        "D15_retention": assertions.retention_window(_spoiled(mart, "issued_at", F.col("issued_at") - F.expr("INTERVAL 9 DAYS"), _PLACE), AS_OF),
        "D16": assertions.grid_covered(t["grid"].where("nx <> 57"), p.grid),
        "D17": assertions.windows_apart(_spoiled(t["windows"], "window_end_at", F.col("window_end_at") + hour(2), _PLACE), "place_id"),
        "D18": assertions.windows_reconcile(_spoiled(t["windows"].where("place_id <> 'place_7'"), "precipitation_hour_count", F.col("precipitation_hour_count") + 1, _PLACE), p.hourly, AS_OF, "place_id"),
        "D19": assertions.current_ready(_spoiled(t["current"], "forecast_at", late, _PLACE), p.hourly, p.places, AS_OF),
        "D20": assertions.change_recomputes(_spoiled(t["change"], "max_temp_change_c", F.col("max_temp_change_c") + 1, _PLACE), mart, AS_OF),
        "D21": assertions.single_issue(_spoiled(p.hourly, "forecast_issued_at_min", F.col("forecast_issued_at_min") - hour(1), _PLACE)),
        "D22": assertions.availability_holds(_spoiled(t["availability"], "availability_status", F.lit("maybe"), _PLACE), p.hourly, p.places, AS_OF, 25),
        "D23": assertions.future_only(_spoiled(t["risk"], "forecast_at", F.col("forecast_at") - F.expr("INTERVAL 90 DAYS"), _PLACE), AS_OF),
        "D24": assertions.unique(read(spark, sf_dir, "lineitem"), "l_partkey", "l_suppkey"),
        "D25": assertions.freshness(p.bronze.where(F.col("collected_at") < F.lit("2024-01-14 12:00:00").cast("timestamp_ntz")), "collected_at", AS_OF).where("freshness_state = 'error'"),
    }
    # All rules over rows of silver come from one scan of it, those over its keys from another.
    spoiled = _spoiled_silver(silver)
    profile = assertions.profile(spoiled, assertions.SILVER_RULES, ["dag_run_id"])
    profile.write.parquet(path := f"{tables.session_folder(spark, 'profile')}/silver")
    profile = spark.read.parquet(path)
    out = assertions.profile_violations(profile, assertions.SILVER_RULES).unionByName(assertions.key_violations(spoiled))
    found["D05"] = profile.select("dag_run_id").distinct().join(runs, "dag_run_id", "left_anti")
    for name, rows in found.items():
        one = rows.agg(F.count("*").alias("violations")).select(F.lit(name).alias("assertion"), "violations")
        out = out.unionByName(one)
    return out


# Records of operations and the first build.
_OPS = """SELECT event_id AS i, ['runs', 'metrics', 'control', 'oddity'][1 + event_id % 11 % 4] AS category, CASE WHEN event_id % 13 = 0 THEN '' ELSE 'weather' END AS domain, 'gold' AS layer, ['airflow_task', 'dbt_node', 'publication', 'product_transition'][1 + event_id % 4] AS grain, CASE WHEN event_id % 17 = 0 THEN 'ok' ELSE 'success' END AS status,
    'task' AS task_id, CASE WHEN event_id % 19 <> 0 THEN 'dag' END AS dag_id, 'run_' || user_id AS run_id, CASE WHEN event_id % 23 <> 0 THEN 'pub' END AS publication_id, ts AS started_at, ts + to_seconds(CAST(event_id % 7200 AS INT)) AS ended_at,
    CASE WHEN event_id % 5 <> 0 THEN event_id % 100 - CASE WHEN event_id % 29 = 0 THEN 100 ELSE 0 END END AS row_count, CASE WHEN event_id % 10 = 0 THEN 'not_observed' ELSE 'count_query' END AS rows_source, CASE WHEN event_id % 31 = 0 THEN 'https://a/b' ELSE 'seoul.citydata' END AS api_name FROM events"""
_OPS_REASON = """CASE WHEN category = 'control' THEN 'state_category' WHEN category = 'oddity' THEN 'category' WHEN domain = '' THEN 'domain' WHEN status = 'ok' THEN 'status' WHEN grain IN ('airflow_task', 'product_transition') AND dag_id IS NULL THEN 'missing_dag_id' WHEN grain = 'publication' AND publication_id IS NULL THEN 'missing_publication_id'
    WHEN row_count IS NULL AND rows_source <> 'not_observed' THEN 'count_missing' WHEN row_count < 0 THEN 'count_negative' WHEN row_count IS NOT NULL AND rows_source = 'not_observed' THEN 'count_without_source' WHEN contains(api_name, '://') THEN 'holds_address' END"""
_JSON = "'{\"dag_id\":' || coalesce('\"' || dag_id || '\"', 'null') || ',\"domain\":\"weather\",\"grain\":\"' || grain || '\",\"layer\":\"gold\",\"product_id\":\"a|b\",\"publication_id\":' || coalesce('\"' || publication_id || '\"', 'null') || ',\"run_id\":\"' || run_id || '\",\"task_id\":\"task\",\"try_number\":1}'"


def _ops_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("event_id")
    pick = lambda n, *xs: F.get(F.array(*map(F.lit, xs)), n.cast("int"))
    at = F.col("ts").cast("timestamp")
    count = F.when(i % 5 != 0, i % 100 - F.when(i % 29 == 0, 100).otherwise(0))
    return read(spark, sf_dir, "events").select(
        i.alias("i"), pick(i % 11 % 4, "runs", "metrics", "control", "oddity").alias("category"), F.when(i % 13 == 0, "").otherwise("weather").alias("domain"), F.lit("gold").alias("layer"), pick(i % 4, "airflow_task", "dbt_node", "publication", "product_transition").alias("grain"), F.when(i % 17 == 0, "ok").otherwise("success").alias("status"), F.lit("prod").alias("environment"),
        F.lit("task").alias("task_id"), F.when(i % 19 != 0, "dag").alias("dag_id"), F.concat(F.lit("run_"), "user_id").alias("run_id"), F.lit(1).alias("try_number"), F.when(i % 23 != 0, "pub").alias("publication_id"), F.lit(None).cast("timestamp").alias("observed_at"), at.alias("started_at"), (at + F.make_dt_interval(secs=i % 7200)).alias("ended_at"),
        count.alias("row_count"), F.when(i % 10 == 0, "not_observed").otherwise("count_query").alias("rows_source"), F.when(i % 31 == 0, "https://a/b").otherwise("seoul.citydata").alias("api_name"), F.lit(None).cast("string").alias("sink_type"), F.array(F.lit("b"), F.lit("a"), F.lit("b")).alias("product_ids"),
    )


@register("g12_ops_records", f"SELECT i, sha256({_JSON}) AS event_id, (i % 7200)::DOUBLE AS duration_s, printf('%02d:%02d:%02d', i % 7200 // 3600, i % 3600 // 60, i % 60) AS duration_hms, strftime(ended_at + INTERVAL 9 HOUR, '%Y-%m-%d') AS observed_date_kst FROM ({_OPS}) WHERE {_OPS_REASON} IS NULL")
def g12(spark: SparkSession, sf_dir: str) -> DataFrame:
    records, _ = ops.ops_records(_ops_rows(spark, sf_dir))
    return _dated(records.select("i", "event_id", "duration_s", "duration_hms", "observed_date_kst"))


@register("g12_refused_records", f"SELECT {_OPS_REASON} AS reason, count(*) AS n FROM ({_OPS}) WHERE {_OPS_REASON} IS NOT NULL GROUP BY 1")
def g12_refused(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, refused = ops.ops_records(_ops_rows(spark, sf_dir))
    return refused.groupBy("reason").agg(F.count("*").alias("n"))


@register("a14_bootstrap_evidence", _BRONZE + """SELECT run AS dag_run_id, (SELECT count(*) FROM states WHERE dag_run_id = run) AS manifest_count, (SELECT count(*) FROM states WHERE dag_run_id = run AND NOT (status = 'SUCCESS' AND is_publishable)) AS invalid_manifest_count,
    (SELECT count(*) FROM bronze WHERE dag_run_id = run) AS bronze_row_count, run = 'run_1' AS admitted FROM (VALUES ('run_1'), ('run_3'), ('run_9')) t(run)""")
def a14(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A good run, one that was merged away, and one that never was."""
    states, rows, out = models.run_states(feed.manifest(spark, sf_dir), SOURCE), feed.bronze(spark, sf_dir), None
    for run in ("run_1", "run_3", "run_9"):
        one = ops.bootstrap_evidence(rows, states, SOURCE, run).select(F.lit(run).alias("dag_run_id"), "manifest_count", "invalid_manifest_count", "bronze_row_count", "admitted")
        out = one if out is None else out.unionByName(one)
    return out


# Publication and slots.
@register("g03_key_stats", "SELECT count(*) AS row_count, count(DISTINCT (l_orderkey, l_linenumber)) AS distinct_keys, count(*) FILTER (l_orderkey IS NULL OR l_linenumber IS NULL) AS null_keys, count(DISTINCT l_suppkey) AS distinct_l_suppkey FROM lineitem")
def g03(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publication.key_stats(read(spark, sf_dir, "lineitem"), ("l_orderkey", "l_linenumber"), {"l_suppkey": (100, 0.5)})


@register("g06_content_digest")
def g06(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publication.content_digest(read(spark, sf_dir, "orders"), ("o_orderkey",), {"o_orderkey": "INTEGER", "o_totalprice": "REAL", "o_orderstatus": "TEXT"}, "orders")


@register("g01_gate", """SELECT s_nationkey, n, last_good, CASE WHEN n = 0 THEN 'skip_retain' WHEN last_good > 0 AND n < last_good * 0.5 THEN 'skip_retain' ELSE 'publish' END AS decision FROM (
    SELECT s_nationkey, count(*) FILTER (s_suppkey % 3 = 0) AS n, count(*) AS last_good FROM supplier GROUP BY 1)""")
def g01(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "supplier").groupBy("s_nationkey").agg(F.count_if(F.col("s_suppkey") % 3 == 0).alias("n"), F.count("*").alias("last_good"))
    return rows.withColumn("decision", publication.gate_column(F.col("n"), F.col("last_good"), "retain_last_good", 0.5))


@register("g02_reliable", "SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY 1 HAVING count(*) >= 600")
def g02(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = publication.reliable(read(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.count("*").alias("n")), "n", 600, "suppress_row")
    return rows


@register("g10_publication_delay", "SELECT l_orderkey, l_linenumber, CASE WHEN l_shipdate >= o_orderdate THEN date_sub('minute', o_orderdate, l_shipdate) END AS delay_minutes, CASE WHEN l_shipdate < o_orderdate AND date_sub('minute', o_orderdate, l_shipdate) < 0 THEN 'clock_skew' END AS null_meaning FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
def g10(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "lineitem").join(read(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return publication.publication_delay(rows, "o_orderdate", "l_shipdate").select("l_orderkey", "l_linenumber", "delay_minutes", "null_meaning")


def _slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    cycles = feed.bronze(spark, sf_dir).select(time_axes.wall_clock_from_parts("base_date", "base_time").alias("collection_slot_at")).distinct()
    return slots.plan(cycles, feed.grid(spark, sf_dir).withColumnRenamed("grid_id", "place_id"), AS_OF.replace(day=10))


_SLOTS = _BRONZE + """, s AS (SELECT DISTINCT issued_at AS collection_slot_at, grid_id AS place_id, grid.nx, grid.ny FROM bronze CROSS JOIN grid),
    came AS (SELECT issued_at AS collection_slot_at, nx, ny, count(*) AS row_count, count(DISTINCT category) AS categories FROM bronze GROUP BY ALL),
    cycle AS (SELECT collection_slot_at, sum(row_count)::BIGINT AS verified, count(*) AS cells FROM came GROUP BY 1)
"""


@register("l01_planned_slots", _SLOTS + """SELECT collection_slot_at, place_id, collection_slot_at + INTERVAL 60 MINUTE AS deadline_at,
    sha256('{"collection_contract_id":"weather.vilage_fcst.v1","collection_slot_at":"' || strftime(collection_slot_at - INTERVAL 9 HOUR, '%Y-%m-%dT%H:%M:%S+00:00') || '","contract_version":"v1","grain":{"nx":' || nx || ',"ny":' || ny || ',"place_id":"' || place_id || '"},"source_id":"kma_vilage_fcst"}') AS expected_slot_id FROM s""")
def l01(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _slots(spark, sf_dir).select("collection_slot_at", "place_id", "deadline_at", "expected_slot_id")


@register("l02_outcomes", _SLOTS + """SELECT collection_slot_at, place_id, row_count, state AS collection_state, CASE WHEN state = 'observed' THEN 'not_required' WHEN again OR archive THEN 'pending' ELSE 'unrecoverable' END AS recovery_state,
    CASE WHEN state = 'observed' THEN 'none' WHEN again THEN 'raw_replay' WHEN archive THEN 'historical_query' ELSE 'none' END AS recovery_class, CASE WHEN state <> 'observed' THEN state END AS gap_reason_code
    FROM (SELECT s.*, row_count, hour(collection_slot_at) = 12 AS again, collection_slot_at >= TIMESTAMP '2024-01-10' AS archive, CASE WHEN cells = 5 AND day(collection_slot_at) % 3 <> 0 THEN 'observed' ELSE 'collection_failed' END AS state
        FROM s JOIN cycle USING (collection_slot_at) LEFT JOIN came USING (collection_slot_at, nx, ny))""")
def l02(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every bronze row as a raw object of one row; on every third day loading counted one less."""
    b = feed.bronze(spark, sf_dir)
    at = time_axes.wall_clock_from_parts("base_date", "base_time").alias("collection_slot_at")
    raw = b.select(F.concat_ws("_", F.lit("kma"), "nx", "ny").alias("place_id"), "nx", "ny", at, "raw_object_key", F.lit(1).alias("row_count"))
    verified = raw.groupBy("collection_slot_at").agg((F.count("*") - F.when(F.dayofmonth("collection_slot_at") % 3 == 0, 1).otherwise(0)).alias("verified_rows"))
    found = slots.outcomes(_slots(spark, sf_dir), raw, verified).withColumn("raw_manifest_verified", F.hour("collection_slot_at") == 12)
    return slots.recovery(found).select("collection_slot_at", "place_id", "row_count", "collection_state", "recovery_state", "recovery_class", "gap_reason_code")


@register("l04_outcome_rules", """SELECT reason, count(*) AS n FROM (SELECT CASE WHEN state = 'lost' THEN 'collection_state' WHEN again = 'unknown' THEN 'recovery_state' WHEN (state = 'collection_failed' OR again = 'unrecoverable') AND gap IS NULL THEN 'gap_reason_missing'
    WHEN state = 'observed' AND (again <> 'not_required' OR kind <> 'none') THEN 'recovery_of_ended_slot' WHEN again = 'not_required' AND kind <> 'none' THEN 'class_without_recovery' WHEN again = 'recovered' AND kind = 'none' THEN 'recovered_without_class' WHEN again = 'recovered' THEN 'recovered_without_run' END AS reason
    FROM (SELECT ['observed', 'collection_failed', 'lost'][1 + event_id % 3] AS state, ['not_required', 'pending', 'recovered', 'unrecoverable', 'unknown'][1 + event_id % 5] AS again, ['none', 'raw_replay'][1 + event_id % 2] AS kind, CASE WHEN event_id % 7 < 4 THEN 'gap' END AS gap FROM events)) WHERE reason IS NOT NULL GROUP BY 1""")
def l04(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("event_id")
    pick = lambda n, *xs: F.get(F.array(*map(F.lit, xs)), (i % n).cast("int"))
    rows = read(spark, sf_dir, "events").select("event_id", pick(3, "observed", "collection_failed", "lost").alias("collection_state"), pick(5, "not_required", "pending", "recovered", "unrecoverable", "unknown").alias("recovery_state"), pick(2, "none", "raw_replay").alias("recovery_class"), F.when(i % 7 < 4, "gap").alias("gap_reason_code"), F.lit(None).cast("string").alias("recovery_run_id"), F.lit(None).cast("timestamp").alias("recovered_at"))
    return slots.outcome_violations(rows).groupBy("reason").agg(F.count("*").alias("n"))


@register("t07_due_slots", _SLOTS + f"SELECT collection_slot_at, place_id, 'missing_unknown' AS collection_state, CASE WHEN collection_slot_at >= TIMESTAMP '2024-01-10' THEN 'historical_query' ELSE 'none' END AS recovery_class FROM s LEFT JOIN came USING (collection_slot_at, nx, ny) WHERE collection_slot_at + INTERVAL 60 MINUTE <= {_T} AND coalesce(categories, 0) < 9")
def t07(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A slot has come when all nine categories of its cell have."""
    planned = _slots(spark, sf_dir)
    came = feed.bronze(spark, sf_dir).groupBy(time_axes.wall_clock_from_parts("base_date", "base_time").alias("collection_slot_at"), "nx", "ny").agg(F.countDistinct("category").alias("n")).where("n = 9")
    events = planned.join(came, ["collection_slot_at", "nx", "ny"], "left_semi").select("expected_slot_id")
    return slots.finalise(planned, events, time_axes.literal_hour(AS_OF)).join(planned.select("expected_slot_id", "place_id"), "expected_slot_id").select("collection_slot_at", "place_id", "collection_state", "recovery_class")


@register("a21_daily_volumes", _SLOTS + "SELECT call_date, source_id, count(*) AS calls FROM (SELECT collection_slot_at::DATE::VARCHAR AS call_date, unnest(['kma_vilage_fcst', 'combined']) AS source_id FROM s) GROUP BY ALL")
def a21(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dated(slots.daily_volumes(_slots(spark, sf_dir)))


# Published queries.
def _call(name: str, params: dict):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _dated(published.query(name)(feed.gold(spark, sf_dir), as_of=AS_OF, **params))

    return run


for _name, (_params, _sql) in published_sql.CALLS.items():
    _has_date = "forecast_date" in _sql.split(" FROM ")[0]
    register(f"q_{_name}", f"{SQL_ALL} SELECT * REPLACE ({_DATED}) FROM ({_sql})" if _has_date else f"{SQL_ALL} {_sql}")(_call(_name, _params))


_CTES, _SELECT = _HORIZON[: _HORIZON.rindex("SELECT p.place_id")], _HORIZON[_HORIZON.rindex("SELECT p.place_id") :]


@register("g14_covered_range", f"""{SQL_ALL} {_CTES}, asked AS (SELECT *, coalesce(availability_status = 'complete' AND available_from_at <= {_T} AND available_to_at >= {_T}, false) AS covered FROM ({_SELECT}) WHERE place_id = 'place_3')
    SELECT DISTINCT a.place_id, covered, available_from_at, available_to_at, CASE WHEN covered THEN r.forecast_at END AS forecast_at, CASE WHEN covered THEN r.product_row_id END AS product_row_id, CASE WHEN covered THEN r.risk_labels END AS risk_labels,
        CASE WHEN NOT covered THEN 'range_not_covered' WHEN r.forecast_at IS NULL THEN 'no_risk_in_range' END AS zero_result_reason FROM asked a LEFT JOIN (SELECT * FROM risk WHERE forecast_at = {_T}) r ON r.place_id = a.place_id""")
def g14(spark: SparkSession, sf_dir: str) -> DataFrame:
    return published.covered_range(feed.gold(spark, sf_dir), "place_3", AS_OF, AS_OF)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _call("windows_overlapping_visit_window", {"n": None})(spark, sf_dir)
