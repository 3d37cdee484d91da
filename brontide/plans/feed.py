"""The driver's tables as a forecast feed: bronze rows by plain arithmetic on events, a manifest
of their runs, nations as places and grid cells. SQL says the same, for comparison."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brontide.functions.time_axes import NTZ, as_of_hour
from brontide.plans import models
from brontide.sources.tables import session_folder

SOURCE = "forecast"
AS_OF: datetime = as_of_hour("2024-01-15 00:00:00")
#: Fixed values of the feed.
CATEGORIES = ("TMP", "POP", "PTY", "PCP", "SNO", "WSD", "REH", "SKY", "VEC")
PCP_TEXTS = ("강수없음", "1mm 미만", "2.0mm", "30.0~50.0mm", "50.0mm 이상", "20")
SNO_TEXTS = ("적설없음", "1cm 미만", "2.0cm", "1")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(values: tuple[str, ...], index):
    return F.get(F.array(*map(F.lit, values)), index.cast("int"))


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events").where("event_id IS NOT NULL AND ts IS NOT NULL AND user_id IS NOT NULL")
    i, ts = F.col("event_id"), F.col("ts").cast(NTZ)
    ninth = F.floor(i / 9)
    day = F.date_trunc("DAY", ts).cast(NTZ)
    issued = day + F.make_dt_interval(hours=(F.hour(ts) - F.hour(ts) % 12))
    target = day + F.make_dt_interval(hours=(F.lit(24) + ninth % 8).cast("int"))
    k = i % 9
    value = (
        F.when(k == 0, (40 - i % 60).cast("string"))
        .when(k == 1, (i * 7 % 101).cast("string"))
        .when(k == 2, (i % 5).cast("string"))
        .when(k == 3, _pick(PCP_TEXTS, ninth % 6))
        .when(k == 4, _pick(SNO_TEXTS, ninth % 4))
        .when(k == 5, (i % 25).cast("string"))
        .when(k == 6, (i * 3 % 101).cast("string"))
        .when(k == 7, _pick(("1", "3", "4"), ninth % 3))
        .otherwise((i % 361).cast("string"))
    )
    nx = (56 + F.col("user_id") % 5).cast("int")
    return e.select(
        F.concat(F.lit("req_"), i).alias("request_id"),
        F.lit(SOURCE).alias("source_id"),
        F.concat(F.lit('{"event":'), i, F.lit("}")).alias("request_params_json"),
        F.concat(F.lit("grid_"), nx, F.lit("_123")).alias("place_id"),
        F.date_format(issued, "yyyyMMdd").alias("base_date"),
        F.date_format(issued, "HHmm").alias("base_time"),
        nx.alias("nx"),
        F.lit(123).alias("ny"),
        _pick(CATEGORIES, k).alias("category"),
        F.date_format(target, "yyyyMMdd").alias("fcst_date"),
        F.date_format(target, "HHmm").alias("fcst_time"),
        value.alias("fcst_value"),
        F.concat(F.lit("raw/"), F.lpad(i.cast("string"), 12, "0")).alias("raw_object_key"),
        F.sha2(i.cast("string"), 256).alias("payload_hash"),
        F.lit(200).alias("http_status"),
        F.lit("00").alias("result_code"),
        F.lit("OK").alias("result_msg"),
        F.lit(1).alias("total_count"),
        F.lit(1).alias("item_count"),
        ts.alias("collected_at"),
        F.date_format(ts, "yyyy-MM-dd").alias("load_date"),
        F.concat(F.lit("run_"), i % 4).alias("dag_run_id"),
        F.lit(1).alias("page_no"),
    )


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A success for each run; run_3 is merged away an hour later."""
    e = read(spark, sf_dir, "events").where("event_id IS NOT NULL AND ts IS NOT NULL AND user_id IS NOT NULL")
    runs = e.groupBy(F.concat(F.lit("run_"), F.col("event_id") % 4).alias("dag_run_id")).agg(F.max("ts").cast(NTZ).alias("event_at"), F.count("*").cast("int").alias("n"))
    row = lambda df, status, good: df.select(F.lit(SOURCE).alias("source_id"), F.lit("collect").alias("dag_id"), "dag_run_id", F.lit(status).alias("status"), F.lit(good).alias("is_publishable"), "event_at", F.col("n").alias("expected_rows"), F.col("n").alias("actual_rows"), F.col("n").alias("expected_raw_objects"), F.col("n").alias("actual_raw_objects"), F.lit(None).cast("string").alias("failure_reason"))
    merged = runs.where("dag_run_id = 'run_3'").withColumn("event_at", F.col("event_at") + F.expr("INTERVAL 1 HOUR"))
    return row(runs, "SUCCESS", True).unionByName(row(merged, "COALESCED", False))


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as places, regions as districts."""
    n, r = read(spark, sf_dir, "nation"), read(spark, sf_dir, "region")
    j = n.join(r, n.n_regionkey == r.r_regionkey)
    code = F.format_string("%05d%05d", F.col("r_regionkey") + 11000, F.col("n_nationkey"))
    seed = j.select(
        F.concat(F.lit("place_"), F.col("n_nationkey")).alias("place_id"),
        F.col("n_name").alias("place_name"),
        F.lower("n_name").alias("alias_names"),
        F.col("r_name").alias("gu"),
        F.concat(F.lit("unit "), F.col("n_nationkey")).alias("admin_dong"),
        (37.0 + F.col("n_nationkey") / 100).alias("latitude"),
        (127.0 - F.col("n_nationkey") / 50).alias("longitude"),
        (56 + F.col("n_nationkey") % 5).cast("int").alias("nx"),
        F.lit(123).alias("ny"),
        F.lit("nearest").alias("mapping_method"),
        F.lit(0.0).alias("grid_distance_m"),
        code.alias("source_admin_code"),
    )
    return models.places(seed)


def grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = read(spark, sf_dir, "nation").select((56 + F.col("n_nationkey") % 5).cast("int").alias("nx"), F.lit(123).alias("ny")).distinct()
    scope = F.when(F.col("nx") < 58, "core").otherwise("edge")
    return models.coverage_grid(n.withColumns({"grid_id": F.concat_ws("_", F.lit("kma"), "nx", "ny"), "coverage_scope": scope}))


class Products:
    """The model graph over the feed. As it is, each product is planned when it is asked for;
    with a keeper, silver, marts and hourly outlooks are written once and read from then on."""

    def __init__(self, spark: SparkSession, sf_dir: str, keep: Callable[[str, DataFrame], DataFrame] = lambda _, df: df):
        self.spark, self.sf_dir, self.keep = spark, sf_dir, keep
        self.manifest, self.bronze = manifest(spark, sf_dir), bronze(spark, sf_dir)
        self.places, self.grid = keep("places", places(spark, sf_dir)), keep("grid", grid(spark, sf_dir))
        self.silver = keep("silver", models.silver(self.bronze, self.manifest, SOURCE))
        self.place_mart = keep("place_mart", models.place_mart(self.silver, self.places, AS_OF))
        self.grid_mart = keep("grid_mart", models.grid_mart(self.silver, self.grid, AS_OF))
        self.hourly = keep("hourly", models.place_hourly(self.place_mart))
        self.grid_hourly = keep("grid_hourly", models.grid_hourly(self.grid_mart))

    @property
    def tables(self) -> dict[str, DataFrame]:
        return {
            "risk": models.risk_windows(self.hourly, AS_OF),
            "windows": models.precipitation_windows(self.hourly, AS_OF),
            "current": models.current_outlook(self.hourly, AS_OF),
            "change": models.forecast_change(self.place_mart, AS_OF),
            "grid": models.current_outlook(self.grid_hourly, AS_OF, "grid_id"),
            "grid_windows": models.precipitation_windows(self.grid_hourly, AS_OF, "grid_id"),
            "availability": models.availability(self.hourly, self.places, AS_OF),
        }


#: Products of each session, folder and state of its files.
_GOLD: dict[tuple[str, ...], Products] = {}


def state(spark: SparkSession, sf_dir: str) -> str:
    """The files of the tables that the feed reads, with their sizes and times."""
    found = []
    for name in ("events", "nation", "region"):
        p = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{name}.parquet")
        files = p.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(p)
        found += [f"{f.getPath()}:{f.getLen()}:{f.getModificationTime()}" for f in files]
    return "|".join(sorted(found))


def kept(spark: SparkSession, sf_dir: str) -> Products:
    """The model graph, written once in a session; all readers of silver, marts and gold share it.
    What is written goes when the session's JVM ends; other files in the folder make other products."""
    key = (spark.sparkContext.applicationId, sf_dir, state(spark, sf_dir))
    if key not in _GOLD:
        root = session_folder(spark, "products")

        def keep(name: str, df: DataFrame) -> DataFrame:
            df.write.parquet(f"{root}/{name}")
            return spark.read.parquet(f"{root}/{name}")

        _GOLD[key] = Products(spark, sf_dir, keep)
    return _GOLD[key]


def gold(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The gold products as tables; each is written the first time that it is asked for."""
    products = kept(spark, sf_dir)
    return _Gold(products)


class _Gold(dict):
    def __init__(self, products: Products):
        super().__init__()
        self._products = products
        products.gold = getattr(products, "gold", {})

    def __missing__(self, name: str) -> DataFrame:
        if name not in self._products.gold:
            self._products.gold[name] = self._products.keep(f"gold_{name}", self._products.tables[name])
        return self._products.gold[name]


_E = "events WHERE event_id IS NOT NULL AND ts IS NOT NULL AND user_id IS NOT NULL"
_LIST = lambda xs: "[" + ", ".join(f"'{x}'" for x in xs) + "]"
#: SQL of the same, as common table expressions.
SQL_BRONZE = f"""
bronze AS (
    SELECT 'req_' || event_id AS request_id, 'grid_' || (56 + user_id % 5) || '_123' AS place_id, (56 + user_id % 5)::INT AS nx, 123 AS ny,
        ({_LIST(CATEGORIES)})[1 + event_id % 9] AS category,
        date_trunc('day', ts) + to_hours(CAST(hour(ts) // 12 * 12 AS INT)) AS issued_at,
        date_trunc('day', ts) + to_hours(CAST(24 + (event_id // 9) % 8 AS INT)) AS forecast_at,
        CASE event_id % 9 WHEN 0 THEN (40 - event_id % 60)::VARCHAR WHEN 1 THEN (event_id * 7 % 101)::VARCHAR WHEN 2 THEN (event_id % 5)::VARCHAR
            WHEN 3 THEN ({_LIST(PCP_TEXTS)})[1 + (event_id // 9) % 6] WHEN 4 THEN ({_LIST(SNO_TEXTS)})[1 + (event_id // 9) % 4]
            WHEN 5 THEN (event_id % 25)::VARCHAR WHEN 6 THEN (event_id * 3 % 101)::VARCHAR WHEN 7 THEN (['1', '3', '4'])[1 + (event_id // 9) % 3]
            ELSE (event_id % 361)::VARCHAR END AS fcst_value_raw,
        'raw/' || lpad(event_id::VARCHAR, 12, '0') AS raw_object_key, sha256(event_id::VARCHAR) AS payload_hash, ts AS collected_at,
        strftime(ts, '%Y-%m-%d') AS load_date, 'run_' || event_id % 4 AS dag_run_id
    FROM {_E}
),
manifest AS (
    SELECT 'run_' || event_id % 4 AS dag_run_id, 'SUCCESS' AS status, true AS is_publishable, max(ts) AS event_at, count(*) AS n FROM {_E} GROUP BY 1
    UNION ALL SELECT 'run_3', 'COALESCED', false, max(ts) + INTERVAL 1 HOUR, count(*) FROM {_E} AND event_id % 4 = 3 HAVING count(*) > 0
),
states AS (
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY dag_run_id ORDER BY event_at DESC) AS rn, count(*) OVER (PARTITION BY dag_run_id, event_at) AS state_tie_count FROM manifest)
    WHERE rn = 1 AND state_tie_count = 1
),
runs AS (SELECT dag_run_id FROM states WHERE status = 'SUCCESS' AND is_publishable),
places AS (
    SELECT 'place_' || n_nationkey AS place_id, n_name AS place_name, lower(n_name) AS alias_names, r_name AS gu, 'unit ' || n_nationkey AS admin_dong,
        37.0::DOUBLE + n_nationkey / 100 AS latitude, 127.0::DOUBLE - n_nationkey / 50 AS longitude, (56 + n_nationkey % 5)::INT AS nx, 123 AS ny,
        lpad((r_regionkey + 11000)::VARCHAR, 5, '0') || lpad(n_nationkey::VARCHAR, 5, '0') AS admin_dong_code, lpad((r_regionkey + 11000)::VARCHAR, 5, '0') AS gu_code
    FROM nation JOIN region ON n_regionkey = r_regionkey
),
grid AS (SELECT DISTINCT 'kma_' || (56 + n_nationkey % 5) || '_123' AS grid_id, (56 + n_nationkey % 5)::INT AS nx, 123 AS ny, CASE WHEN n_nationkey % 5 < 2 THEN 'core' ELSE 'edge' END AS coverage_scope FROM nation)
"""
_NUM = r"^[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?$"
_N = r"[0-9]+(?:\.[0-9]+)?"
_U = "(?:mm|cm)"
_V = "trim(fcst_value_raw)"
SQL_SILVER = f"""
silver AS (
    SELECT *, date_sub('hour', issued_at, forecast_at) AS forecast_lead_hours,
        CASE WHEN regexp_matches({_V}, '{_NUM}') THEN {_V}::DOUBLE END AS fcst_value_num,
        CASE WHEN fcst_value_raw IS NULL OR {_V} IN ('', '-') THEN 'missing'
            WHEN category IN ('PTY', 'SKY') THEN CASE WHEN regexp_matches({_V}, '^[0-9]+$') THEN 'qualitative_code' ELSE 'unparseable' END
            WHEN category IN ('PCP', 'SNO') THEN CASE WHEN {_V} IN ('강수없음', '강수 없음', '적설없음', '적설 없음', '눈날림') THEN 'explicit_none'
                WHEN regexp_matches({_V}, '^{_N}{_U} ?(미만|이상)$') OR regexp_matches({_V}, '^{_N}~{_N}{_U}$') THEN 'quantitative_range'
                WHEN regexp_matches({_V}, '^{_N}{_U}$') THEN 'quantitative_exact' WHEN regexp_matches({_V}, '^{_N}$') THEN 'bare_numeric' ELSE 'unparseable' END
            WHEN regexp_matches({_V}, '{_NUM}') THEN 'quantitative_exact' ELSE 'unparseable' END AS value_representation,
        CASE WHEN category IN ('PTY', 'SKY') THEN NULL
            WHEN category IN ('PCP', 'SNO') THEN CASE WHEN regexp_matches({_V}, '^{_N}{_U}?$') THEN regexp_extract({_V}, '^({_N})', 1)::DOUBLE END
            WHEN regexp_matches({_V}, '{_NUM}') THEN {_V}::DOUBLE END AS value_num,
        CASE WHEN category IN ('PCP', 'SNO') THEN CASE WHEN regexp_matches({_V}, '^{_N}{_U} ?미만$') THEN 0.0::DOUBLE
            WHEN regexp_matches({_V}, '^{_N}{_U} ?이상$') OR regexp_matches({_V}, '^{_N}~{_N}{_U}$') THEN regexp_extract({_V}, '^({_N})', 1)::DOUBLE END END AS value_lower_bound,
        CASE WHEN category IN ('PCP', 'SNO') THEN CASE WHEN regexp_matches({_V}, '^{_N}{_U} ?미만$') THEN regexp_extract({_V}, '^({_N})', 1)::DOUBLE
            WHEN regexp_matches({_V}, '^{_N}~{_N}{_U}$') THEN regexp_extract({_V}, '~({_N})', 1)::DOUBLE END END AS value_upper_bound,
        CASE WHEN category IN ('PTY', 'SKY') AND regexp_matches({_V}, '^[0-9]+$') THEN {_V} END AS qualitative_code
    FROM (
        SELECT *, row_number() OVER (PARTITION BY place_id, nx, ny, issued_at, category, forecast_at ORDER BY collected_at DESC, raw_object_key DESC, request_id DESC) AS rn
        FROM bronze WHERE dag_run_id IN (SELECT dag_run_id FROM runs)
    ) WHERE rn = 1
)
"""
_T = f"TIMESTAMP '{AS_OF}'"
SQL_MARTS = f"""
retained AS (SELECT * FROM silver WHERE forecast_at >= {_T} - INTERVAL 1 DAY AND issued_at >= {_T} - INTERVAL 24 HOUR),
place_mart AS (
    SELECT r.* EXCLUDE (place_id, rn, rk), p.* EXCLUDE (nx, ny)
    FROM (SELECT *, dense_rank() OVER (PARTITION BY nx, ny, forecast_at ORDER BY issued_at DESC NULLS LAST) AS rk FROM retained) r JOIN places p ON r.nx = p.nx AND r.ny = p.ny
    WHERE rk <= 2
),
grid_mart AS (SELECT r.* EXCLUDE (rn), g.grid_id, g.coverage_scope FROM retained r JOIN grid g ON r.nx = g.nx AND r.ny = g.ny)
"""
_WIDE = ", ".join(
    [f"max(fcst_value_num) FILTER (category = '{k}') AS {n}" for k, n in (("TMP", "temp_c"), ("REH", "humidity_pct"), ("WSD", "wind_ms"), ("VEC", "wind_dir_deg"), ("POP", "precip_prob_pct"), ("PCP", "pcp_mm"), ("SNO", "sno_cm"))]
    + [f"max(fcst_value_raw) FILTER (category = '{k}') AS {n}" for k, n in (("SKY", "sky_code"), ("PTY", "pty_code"), ("PCP", "pcp_raw"), ("SNO", "sno_raw"))]
)
_COMMON = "count(DISTINCT category) AS forecast_category_count, min(issued_at) AS forecast_issued_at_min, max(issued_at) AS forecast_issued_at_max, max(collected_at + INTERVAL 9 HOUR) AS forecast_collected_at_max"
_SEEN = "(category IN ('TMP', 'WSD') AND fcst_value_num IS NOT NULL) OR (category IN ('PTY', 'PCP', 'SNO') AND trim(fcst_value_raw) <> '')"
_LABELS = "CASE sky_code WHEN '1' THEN '맑음' WHEN '3' THEN '구름많음' WHEN '4' THEN '흐림' END AS sky_label, CASE pty_code WHEN '0' THEN '없음' WHEN '1' THEN '비' WHEN '2' THEN '비/눈' WHEN '3' THEN '눈' WHEN '4' THEN '소나기' END AS pty_label, pty_code IS NOT NULL AND pty_code <> '0' AS is_precipitating, date_sub('hour', forecast_issued_at_max, forecast_at) AS forecast_lead_hours"
_ISO = "strftime({}, '%Y-%m-%dT%H:%M:%S.%f')"
SQL_HOURLY = f"""
hourly AS (
    SELECT *, place_id || '|' || {_ISO.format("forecast_at")} AS product_row_id, {_LABELS} FROM (
        SELECT place_id, forecast_at, {_COMMON}, max(place_name) AS place_name, max(alias_names) AS alias_names, max(admin_dong_code) AS admin_dong_code, max(admin_dong) AS admin_dong,
            max(gu_code) AS gu_code, max(gu) AS gu, max(latitude) AS latitude, max(longitude) AS longitude,
            count(DISTINCT CASE WHEN {_SEEN} THEN category END) AS risk_evidence_collected_category_count,
            min(CASE WHEN {_SEEN} THEN collected_at + INTERVAL 9 HOUR END) AS risk_evidence_collected_at_min, max(CASE WHEN {_SEEN} THEN collected_at + INTERVAL 9 HOUR END) AS risk_evidence_collected_at_max,
            max(raw_object_key) AS representative_raw_object_key, max(payload_hash) AS representative_payload_hash, max(dag_run_id) AS representative_dag_run_id, {_WIDE}
        FROM (SELECT *, dense_rank() OVER (PARTITION BY place_id, forecast_at ORDER BY issued_at DESC NULLS LAST) AS k FROM place_mart) WHERE k = 1 GROUP BY place_id, forecast_at
    )
),
grid_hourly AS (
    SELECT *, grid_id || '|' || {_ISO.format("forecast_at")} AS product_row_id, {_LABELS}
    FROM (SELECT grid_id, nx, ny, coverage_scope, forecast_at, {_COMMON}, {_WIDE} FROM grid_mart GROUP BY ALL)
),
current AS (
    SELECT * EXCLUDE (n, product_row_id), place_id AS product_row_id, {_T} AS snapshot_as_of_hour
    FROM (SELECT *, row_number() OVER (PARTITION BY place_id ORDER BY forecast_at, forecast_issued_at_max DESC) AS n FROM hourly WHERE forecast_at >= {_T}) WHERE n = 1
),
grid_current AS (
    SELECT * EXCLUDE (n, product_row_id), grid_id AS product_row_id, {_T} AS snapshot_as_of_hour
    FROM (SELECT *, row_number() OVER (PARTITION BY grid_id ORDER BY forecast_at, forecast_issued_at_max DESC) AS n FROM grid_hourly WHERE forecast_at >= {_T}) WHERE n = 1
)
"""


def _islands(source: str, key: str, about: str) -> str:
    return f"""(
    SELECT {key} || '|' || {_ISO.format("min(forecast_at)")} AS product_row_id, {key}, {about}, min(forecast_at) AS window_start_at, max(forecast_at) AS window_end_at, count(*) AS precipitation_hour_count,
        max(precip_prob_pct) AS precip_prob_max_pct, max(pcp_mm) AS pcp_max_mm, max(sno_cm) AS sno_max_cm, min(forecast_issued_at_min) AS forecast_issued_at_min,
        max(forecast_issued_at_max) AS forecast_issued_at_max, max(forecast_collected_at_max) AS forecast_collected_at_max
    FROM (
        SELECT *, sum(fresh) OVER (PARTITION BY {key} ORDER BY forecast_at ROWS UNBOUNDED PRECEDING) AS w FROM (
            SELECT *, CASE WHEN coalesce(date_sub('hour', lag(forecast_at) OVER (PARTITION BY {key} ORDER BY forecast_at), forecast_at), 99) > 1 THEN 1 ELSE 0 END AS fresh
            FROM {source} WHERE forecast_at >= {_T} AND is_precipitating))
    GROUP BY {key}, w)"""


SQL_GOLD = f"""
windows AS {_islands("hourly", "place_id", "max(place_name) AS place_name, max(admin_dong_code) AS admin_dong_code, max(admin_dong) AS admin_dong, max(gu_code) AS gu_code, max(gu) AS gu")},
grid_windows AS {_islands("grid_hourly", "grid_id", "max(nx) AS nx, max(ny) AS ny, max(coverage_scope) AS coverage_scope")},
risk AS (
    SELECT product_row_id, place_id, place_name, admin_dong_code, admin_dong, gu_code, gu, forecast_at, temp_c, wind_ms, precip_prob_pct, pty_code, pcp_mm, sno_cm, heat_risk, cold_risk, heavy_rain_risk, snow_risk, wind_risk,
        (heat_risk OR cold_risk OR heavy_rain_risk OR snow_risk OR wind_risk) AS any_risk,
        concat_ws(', ', CASE WHEN heat_risk THEN '폭염후보' END, CASE WHEN cold_risk THEN '한파후보' END, CASE WHEN heavy_rain_risk THEN '호우후보' END, CASE WHEN snow_risk THEN '대설후보' END, CASE WHEN wind_risk THEN '강풍후보' END) AS risk_labels,
        forecast_issued_at_min, forecast_issued_at_max, forecast_collected_at_max
    FROM (SELECT *, temp_c >= 33 AS heat_risk, temp_c <= -12 AS cold_risk, pty_code IN ('1', '4', '5') AND coalesce(pcp_mm, 0) >= 15 AS heavy_rain_risk, coalesce(sno_cm, 0) >= 1 AS snow_risk, wind_ms >= 14 AS wind_risk FROM hourly WHERE forecast_at >= {_T})
    WHERE heat_risk OR cold_risk OR heavy_rain_risk OR snow_risk OR wind_risk
),
daily AS (
    SELECT place_id, forecast_at::DATE AS forecast_date, issued_at, max(place_name) AS place_name, max(admin_dong_code) AS admin_dong_code, max(admin_dong) AS admin_dong, max(gu_code) AS gu_code, max(gu) AS gu,
        count(DISTINCT category) AS category_count, count(DISTINCT forecast_at) AS forecast_hour_count,
        coalesce(max(fcst_value_num) FILTER (category = 'TMN'), min(fcst_value_num) FILTER (category = 'TMP')) AS min_temp_c, coalesce(max(fcst_value_num) FILTER (category = 'TMX'), max(fcst_value_num) FILTER (category = 'TMP')) AS max_temp_c,
        max(fcst_value_num) FILTER (category = 'POP') AS max_precip_prob_pct, min(forecast_at) FILTER (category = 'PTY' AND fcst_value_raw <> '0') AS first_precipitation_at, max(collected_at + INTERVAL 9 HOUR) AS collected_at_max
    FROM place_mart WHERE forecast_at >= date_trunc('day', {_T}) GROUP BY 1, 2, 3
),
ranked AS (SELECT *, dense_rank() OVER (PARTITION BY place_id, forecast_date ORDER BY issued_at DESC) AS k FROM daily),
change AS (
    SELECT l.place_id || '|' || l.forecast_date::VARCHAR AS product_row_id, l.place_id, l.place_name, l.admin_dong_code, l.admin_dong, l.gu_code, l.gu, l.forecast_date,
        {", ".join(f"l.{c} AS latest_{c}, p.{c} AS previous_{c}" for c in ("issued_at", "category_count", "forecast_hour_count", "min_temp_c", "max_temp_c", "max_precip_prob_pct", "first_precipitation_at", "collected_at_max"))},
        date_sub('hour', p.issued_at, l.issued_at) AS issue_gap_hours, l.min_temp_c - p.min_temp_c AS min_temp_change_c, l.max_temp_c - p.max_temp_c AS max_temp_change_c, l.max_precip_prob_pct - p.max_precip_prob_pct AS max_precip_prob_change_pct,
        CASE WHEN p.issued_at IS NULL THEN 'no_previous_issue'
            WHEN l.min_temp_c IS NULL OR p.min_temp_c IS NULL OR l.max_temp_c IS NULL OR p.max_temp_c IS NULL OR l.max_precip_prob_pct IS NULL OR p.max_precip_prob_pct IS NULL THEN 'partial_comparison'
            WHEN l.min_temp_c IS DISTINCT FROM p.min_temp_c OR l.max_temp_c IS DISTINCT FROM p.max_temp_c OR l.max_precip_prob_pct IS DISTINCT FROM p.max_precip_prob_pct OR l.first_precipitation_at IS DISTINCT FROM p.first_precipitation_at THEN 'changed'
            ELSE 'unchanged' END AS change_state
    FROM (SELECT * FROM ranked WHERE k = 1) l LEFT JOIN (SELECT * FROM ranked WHERE k = 2) p ON l.place_id = p.place_id AND l.forecast_date = p.forecast_date
)
"""
SQL_ALL = "WITH " + ",".join((SQL_BRONZE, SQL_SILVER, SQL_MARTS, SQL_HOURLY, SQL_GOLD))
