"""The model graph: bronze rows to silver, marts and gold products. Every model is a function
of DataFrames and a frozen hour; Spark plans it, writers decide what is kept."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brontide.functions import text, values
from brontide.functions.time_axes import NTZ, day_floor, lead_hours, literal_hour, row_id, utc_to_local, wall_clock_from_parts
from brontide.operators import core

SILVER_KEY = ["place_id", "nx", "ny", "issued_at", "category", "forecast_at"]
WINNER_ORDER = ["collected_at", "raw_object_key", "request_id"]
#: Categories whose evidence a risk verdict needs, by number and by raw text.
EVIDENCE_NUMBERS, EVIDENCE_TEXTS = ("TMP", "WSD"), ("PTY", "PCP", "SNO")


def run_states(manifest: DataFrame, source_id: str) -> DataFrame:
    return core.latest_state(manifest.where(F.col("source_id") == source_id), ["source_id", "dag_run_id"], "event_at", "state_tie_count", "dag_id")


def silver(bronze: DataFrame, manifest: DataFrame, source_id: str, run_id: str | None = None, load_date: str | None = None, target: DataFrame | None = None, historical: bool = False, lookback: int = 30) -> DataFrame:
    """Typed, deduplicated forecasts of publishable runs with classified values.

    run_id and load_date pin one run and its partition; target turns on the watermark.
    """
    runs = core.publishable_runs(run_states(manifest, source_id))
    if run_id is not None:
        runs, bronze = runs.where(F.col("dag_run_id") == run_id), bronze.where(F.col("dag_run_id") == run_id)
    if load_date is not None:
        bronze = bronze.where(F.col("load_date") == load_date)
    if target is not None and not historical:
        bronze = core.after_watermark(bronze, target, "collected_at", lookback)
    rows = core.among(bronze, runs, "dag_run_id", WINNER_ORDER).where(F.col("result_code") == "00")
    rows = rows.withColumns({"issued_at": wall_clock_from_parts("base_date", "base_time"), "forecast_at": wall_clock_from_parts("fcst_date", "fcst_time")})
    rows = rows.where(F.col("issued_at").isNotNull() & F.col("forecast_at").isNotNull())
    rows = core.winner(rows.withColumnRenamed("fcst_value", "fcst_value_raw"), SILVER_KEY, WINNER_ORDER)
    new = {
        "event_at": F.col("forecast_at"),
        "time_bucket": F.date_trunc("HOUR", "forecast_at").cast(NTZ),
        "fcst_value_num": values.number(F.col("fcst_value_raw")),
        "forecast_lead_hours": lead_hours("issued_at", "forecast_at"),
        **values.value_semantics(F.col("category"), F.col("fcst_value_raw")),
    }
    return rows.withColumns(new).drop("base_date", "base_time", "fcst_date", "fcst_time", "http_status", "result_code", "result_msg", "page_no")


def coverage_grid(seed: DataFrame) -> DataFrame:
    blank = lambda c: F.nullif(F.trim(F.col(c).cast("string")), F.lit(""))
    out = seed.select(blank("grid_id").alias("grid_id"), F.col("nx").try_cast("int").alias("nx"), F.col("ny").try_cast("int").alias("ny"), blank("coverage_scope").alias("coverage_scope"))
    return out.dropna(subset=["grid_id", "nx", "ny"])


def places(seed: DataFrame) -> DataFrame:
    blank = lambda c: F.nullif(F.trim(F.col(c).cast("string")), F.lit(""))
    texts = ["place_id", "place_name", "alias_names", "gu", "admin_dong", "mapping_method", "source_admin_code"]
    numbers = {"latitude": "double", "longitude": "double", "nx": "int", "ny": "int", "grid_distance_m": "double"}
    out = seed.select(*(blank(c).alias(c) for c in texts), *(F.col(c).try_cast(t).alias(c) for c, t in numbers.items()))
    out = out.dropna(subset=["place_id", "place_name", "gu", "admin_dong", "nx", "ny", "source_admin_code"])
    return out.withColumns({"admin_dong_code": F.col("source_admin_code"), "gu_code": F.substring("source_admin_code", 1, 5)})


def _retained(rows: DataFrame, as_of: datetime) -> DataFrame:
    day = literal_hour(day_floor(as_of, 1))
    return rows.where((F.col("forecast_at") >= day) & (F.col("issued_at") >= literal_hour(as_of - timedelta(hours=24))))


def grid_mart(silver_rows: DataFrame, grid: DataFrame, as_of: datetime) -> DataFrame:
    """Grid working set: retained rows, one winner per key, joined to the coverage grid."""
    rows = _retained(silver_rows, as_of).withColumnRenamed("place_id", "source_grid_place_id")
    best = core.winner(rows, ["nx", "ny", "category", "issued_at", "forecast_at"], WINNER_ORDER)
    return best.join(F.broadcast(grid), ["nx", "ny"])  # a fixed set of cells


def place_mart(silver_rows: DataFrame, place_dim: DataFrame, as_of: datetime) -> DataFrame:
    """Place working set: winners and the newest two issues of a grid hour, then the fan-out."""
    rows = _retained(silver_rows, as_of).withColumnRenamed("place_id", "source_grid_place_id")
    best = core.winner(rows, ["nx", "ny", "category", "issued_at", "forecast_at"], WINNER_ORDER)
    two = core.newest_issues(best, ["nx", "ny", "forecast_at"], "issued_at", 2)
    return two.join(F.broadcast(place_dim), ["nx", "ny"])  # some hundreds of places


PLACE_COLUMNS = ("place_name", "alias_names", "admin_dong_code", "admin_dong", "gu_code", "gu", "latitude", "longitude")


def _outlook(key: list[str], rows: DataFrame, extra: list[Column], value: str) -> DataFrame:
    wide = rows.groupBy(*key, "forecast_at").agg(
        F.countDistinct("category").alias("forecast_category_count"),
        F.min("issued_at").alias("forecast_issued_at_min"),
        F.max("issued_at").alias("forecast_issued_at_max"),
        F.max(utc_to_local("collected_at")).alias("forecast_collected_at_max"),
        *extra,
        *values.wide_measures(value, "fcst_value_raw"),
    )
    return wide.withColumns(
        {
            "product_row_id": row_id(key[0], "forecast_at"),
            "sky_label": values.sky_label(F.col("sky_code")),
            "pty_label": values.pty_label(F.col("pty_code")),
            "is_precipitating": F.col("pty_code").isNotNull() & (F.col("pty_code") != "0"),
            "forecast_lead_hours": lead_hours("forecast_issued_at_max", "forecast_at"),
        }
    )


def place_hourly(mart: DataFrame, value_source: str = "number") -> DataFrame:
    """One wide row per place and hour, of the newest issue only.

    value_source="semantic" takes amounts from classified values instead of plain numbers.
    """
    rows = core.newest_issues(mart.withColumn("category", F.upper("category")), ["place_id", "forecast_at"], "issued_at", 1)
    number = F.col("category").isin(*EVIDENCE_NUMBERS) & F.col("fcst_value_num").isNotNull()
    worded = F.col("category").isin(*EVIDENCE_TEXTS) & (F.trim("fcst_value_raw") != "")
    counts = F.col("collected_at").isNotNull() & (number | F.coalesce(worded, F.lit(False)))
    seen = F.when(counts, utc_to_local("collected_at"))
    extra = [
        *(F.max(c).alias(c) for c in PLACE_COLUMNS),
        F.countDistinct(F.when(counts, F.col("category"))).alias("risk_evidence_collected_category_count"),
        F.min(seen).alias("risk_evidence_collected_at_min"),
        F.max(seen).alias("risk_evidence_collected_at_max"),
        F.max("raw_object_key").alias("representative_raw_object_key"),
        F.max("payload_hash").alias("representative_payload_hash"),
        F.max("dag_run_id").alias("representative_dag_run_id"),
    ]
    return _outlook(["place_id"], rows, extra, "value_num" if value_source == "semantic" else "fcst_value_num")


def grid_hourly(mart: DataFrame) -> DataFrame:
    """One wide row per grid cell and hour; all retained issues take part in each maximum."""
    return _outlook(["grid_id", "nx", "ny", "coverage_scope"], mart.withColumn("category", F.upper("category")), [], "fcst_value_num")


def current_outlook(hourly: DataFrame, as_of: datetime, key: str = "place_id") -> DataFrame:
    near = core.nearest_from(hourly, [key], "forecast_at", "forecast_issued_at_max", literal_hour(as_of))
    return near.withColumns({"product_row_id": F.col(key), "snapshot_as_of_hour": literal_hour(as_of)})


def precipitation_windows(hourly: DataFrame, as_of: datetime, key: str = "place_id") -> DataFrame:
    """Runs of consecutive hours with precipitation."""
    wet = hourly.where((F.col("forecast_at") >= literal_hour(as_of)) & F.col("is_precipitating"))
    about = ("place_name", "admin_dong_code", "admin_dong", "gu_code", "gu") if key == "place_id" else ("nx", "ny", "coverage_scope")
    out = core.islands(wet, [key], "forecast_at").groupBy(key, "window_number")
    out = out.agg(
        *(F.max(c).alias(c) for c in about),
        F.min("forecast_at").alias("window_start_at"),
        F.max("forecast_at").alias("window_end_at"),
        F.count("*").alias("precipitation_hour_count"),
        F.max("precip_prob_pct").alias("precip_prob_max_pct"),
        F.max("pcp_mm").alias("pcp_max_mm"),
        F.max("sno_cm").alias("sno_max_cm"),
        F.min("forecast_issued_at_min").alias("forecast_issued_at_min"),
        F.max("forecast_issued_at_max").alias("forecast_issued_at_max"),
        F.max("forecast_collected_at_max").alias("forecast_collected_at_max"),
    )
    return out.withColumn("product_row_id", row_id(key, "window_start_at")).drop("window_number")


RISK_COLUMNS = ("place_id", "place_name", "admin_dong_code", "admin_dong", "gu_code", "gu", "forecast_at", "temp_c", "wind_ms", "precip_prob_pct", "pty_code", "pcp_mm", "sno_cm")


def risk_windows(hourly: DataFrame, as_of: datetime) -> DataFrame:
    flagged = hourly.where(F.col("forecast_at") >= literal_hour(as_of)).withColumns(values.risk_flags()).where(values.any_risk())
    last = ("forecast_issued_at_min", "forecast_issued_at_max", "forecast_collected_at_max")
    return flagged.select(row_id("place_id", "forecast_at").alias("product_row_id"), *RISK_COLUMNS, *values.RISKS, values.any_risk().alias("any_risk"), values.risk_labels().alias("risk_labels"), *last)


def forecast_change(mart: DataFrame, as_of: datetime) -> DataFrame:
    """Newest issue against the one before, by place and day. Both ranks come from one pass: the
    daily summaries are ranked, and a conditional aggregate sets them side by side."""
    category = F.upper("category")
    of = lambda c, v: F.when(category == c, F.col(v))
    wet = (category == "PTY") & F.col("fcst_value_raw").isNotNull() & (F.col("fcst_value_raw") != "0")
    rows = mart.where(F.col("forecast_at") >= literal_hour(day_floor(as_of, 0))).withColumn("forecast_date", F.to_date("forecast_at"))
    daily = rows.groupBy("place_id", "forecast_date", "issued_at").agg(
        *(F.max(c).alias(c) for c in ("place_name", "admin_dong_code", "admin_dong", "gu_code", "gu")),
        F.countDistinct("category").alias("category_count"),
        F.countDistinct("forecast_at").alias("forecast_hour_count"),
        F.coalesce(F.max(of("TMN", "fcst_value_num")), F.min(of("TMP", "fcst_value_num"))).alias("min_temp_c"),
        F.coalesce(F.max(of("TMX", "fcst_value_num")), F.max(of("TMP", "fcst_value_num"))).alias("max_temp_c"),
        F.max(of("POP", "fcst_value_num")).alias("max_precip_prob_pct"),
        F.min(F.when(wet, F.col("forecast_at"))).alias("first_precipitation_at"),
        F.max(utc_to_local("collected_at")).alias("collected_at_max"),
    )
    two = core.newest_issues(daily, ["place_id", "forecast_date"], "issued_at", 2)
    rank = F.dense_rank().over(Window.partitionBy("place_id", "forecast_date").orderBy(F.desc("issued_at")))
    compared = ("issued_at", "category_count", "forecast_hour_count", "min_temp_c", "max_temp_c", "max_precip_prob_pct", "first_precipitation_at", "collected_at_max")
    side = two.withColumn("_r", rank).groupBy("place_id", "forecast_date")
    first = lambda c, r: F.max(F.when(F.col("_r") == r, F.col(c)))
    out = side.agg(*(first(c, 1).alias(c) for c in ("place_name", "admin_dong_code", "admin_dong", "gu_code", "gu")), *(first(c, r).alias(f"{n}_{c}") for c in compared for r, n in ((1, "latest"), (2, "previous"))))
    c = F.col
    known = ("min_temp_c", "max_temp_c", "max_precip_prob_pct")
    partial = F.lit(False)
    for k in known:
        partial = partial | c(f"latest_{k}").isNull() | c(f"previous_{k}").isNull()
    differs = F.lit(False)
    for k in (*known, "first_precipitation_at"):
        differs = differs | ~c(f"latest_{k}").eqNullSafe(c(f"previous_{k}"))
    state = F.when(c("previous_issued_at").isNull(), "no_previous_issue").when(partial, "partial_comparison").when(differs, "changed").otherwise("unchanged")
    return out.withColumns(
        {
            "product_row_id": F.concat("place_id", F.lit("|"), F.date_format("forecast_date", "yyyy-MM-dd")),
            "issue_gap_hours": lead_hours("previous_issued_at", "latest_issued_at"),
            "min_temp_change_c": c("latest_min_temp_c") - c("previous_min_temp_c"),
            "max_temp_change_c": c("latest_max_temp_c") - c("previous_max_temp_c"),
            "max_precip_prob_change_pct": c("latest_max_precip_prob_pct") - c("previous_max_precip_prob_pct"),
            "change_state": state,
        }
    )


def population_revision(place_dim: DataFrame, prefix: str) -> DataFrame:
    """One row: prefix and the SHA-256 of the places' JSON rows in order. The dimension is a
    fixed set of some hundreds of places."""
    rows = F.array_sort(F.collect_list(F.struct("place_id", "admin_dong", "gu")))
    lines = F.transform(rows, lambda r: F.to_json(F.array(r["place_id"], r["admin_dong"], r["gu"])))
    digest = F.sha2(F.concat(F.lit("["), F.array_join(lines, ","), F.lit("]")), 256)
    return place_dim.agg(F.concat(F.lit(prefix), digest).alias("source_population_revision"))


def availability(hourly: DataFrame, place_dim: DataFrame, as_of: datetime, prefix: str = "places:") -> DataFrame:
    """Which hours of each place can be asked for: expected and observed hours up to the common
    horizon, and the complete prefix."""
    start = literal_hour(as_of)
    c = F.col
    complete = (c("risk_evidence_collected_category_count") == 5) & c("temp_c").isNotNull() & c("wind_ms").isNotNull() & c("pty_code").isNotNull() & c("pcp_raw").isNotNull() & c("sno_raw").isNotNull()
    source = hourly.where(c("forecast_at") >= start).select("place_id", c("forecast_at").alias("slot_at"), complete.alias("slot_complete"), "risk_evidence_collected_at_min", "risk_evidence_collected_at_max")
    # Distinct hours of a forecast are about a hundred, so one window over all of them is small.
    w = Window.orderBy("slot_at")
    three = F.expr("INTERVAL 3 HOURS")
    steps = source.select("slot_at").distinct().withColumns({"before": F.lag("slot_at").over(w), "after": F.lead("slot_at").over(w)})
    tail = (c("slot_at") == c("before") + three) & (c("after") == c("slot_at") + three)
    horizon = steps.agg(F.coalesce(F.min(F.when(tail, c("slot_at"))) - three, F.max("slot_at")).alias("horizon_at"))
    # One row with the horizon: an equi-join on a constant, as it is a scalar.
    base = place_dim.select("place_id").join(F.broadcast(horizon.join(F.broadcast(population_revision(place_dim, prefix)), F.lit(True))), F.lit(True))
    slots = base.withColumn("slot_at", F.explode_outer(core.hour_sequence(start, c("horizon_at"))))
    matrix = slots.join(source, ["place_id", "slot_at"], "left").withColumn("slot_complete", F.coalesce("slot_complete", F.lit(False)))
    first_gap = F.min(F.when(~c("slot_complete"), c("slot_at"))).over(Window.partitionBy("place_id"))
    matrix = matrix.withColumn("gap_at", first_gap)
    prefix_row = c("slot_at").isNotNull() & c("slot_complete") & (c("gap_at").isNull() | (c("slot_at") < c("gap_at")))
    inside = lambda x: F.when(prefix_row, c(x))
    out = matrix.groupBy("place_id", "source_population_revision").agg(
        F.min(inside("slot_at")).alias("available_from_at"),
        F.max(inside("slot_at")).alias("available_to_at"),
        F.min(inside("risk_evidence_collected_at_min")).alias("forecast_collected_at_min"),
        F.max(inside("risk_evidence_collected_at_max")).alias("forecast_collected_at_max"),
        F.count("slot_at").alias("expected_forecast_hour_count"),
        F.count_if(c("slot_complete")).alias("observed_forecast_hour_count"),
        F.min("gap_at").alias("_gap"),
    )
    whole = (c("expected_forecast_hour_count") > 0) & (c("expected_forecast_hour_count") == c("observed_forecast_hour_count")) & c("_gap").isNull()
    return out.withColumns({"snapshot_as_of_hour": start, "availability_status": F.when(whole, "complete").otherwise("incomplete")}).drop("_gap")


def admin_units(master: DataFrame, crosswalk: DataFrame, city: str, revision: str | None = None) -> DataFrame:
    """Units of one city in the newest (or a pinned) revision, without rows that sum a region,
    with their centre from the crosswalk where it has one."""
    revision = revision or master.agg(F.max("revision_date")).first()[0]
    rows = master.where((F.col("revision_date") == revision) & (F.col("city_name") == city) & ~F.col("unit_code").endswith("00000") & (F.trim(F.coalesce("removed_on", F.lit(""))) == ""))
    units = rows.select("unit_code", F.substring("unit_code", 1, 5).alias("region_code"), "region_name", "unit_name", "revision_date").distinct()
    centre = crosswalk.select(F.col("admin_dong_code").alias("unit_code"), "stat_dong_code", "stat_gu_code", "latitude", "longitude")
    return units.join(centre, "unit_code", "left")


def legal_links(links: DataFrame, city: str) -> DataFrame:
    """Distinct pairs of legal and administrative units of the newest revision."""
    revision = links.agg(F.max("revision_date")).first()[0]
    return links.where((F.col("revision_date") == revision) & (F.col("city_name") == city)).select("legal_code", "unit_code", "revision_date").distinct()


def crosswalk(a: DataFrame, b: DataFrame) -> dict[str, DataFrame]:
    """Units of two sources matched by region and normalised name. a: code, region, name (and
    more columns); b: stat_code, stat_region_code, region, name. The ordinal mark goes on side a
    only. Of several units of b with one key the first by code counts and the key is reported;
    a region of several code prefixes is a conflict."""
    key = lambda strip: F.concat_ws("|", text.region_name(F.col("region")), text.unit_name(F.col("name"), strip))
    left, right = a.withColumn("_k", key(True)), b.withColumn("_k", key(False)).select("_k", "stat_code", "stat_region_code")
    one = right.groupBy("_k").agg(F.min(F.struct("stat_code", "stat_region_code")).alias("_b"), F.count("*").alias("_n"))
    prefixes = a.groupBy(text.region_name(F.col("region")).alias("region")).agg(F.array_sort(F.collect_set(F.substring(F.trim("code"), 1, 5))).alias("codes"))
    # One pass over both sides: what has no partner is left over on its side.
    both = left.withColumn("_a", F.lit(True)).join(one, "_k", "full_outer")
    own = [F.col(c) for c in a.columns]
    return {
        "matched": both.where("_a AND _n IS NOT NULL").select(*own, F.col("_b.stat_code").alias("stat_code"), F.col("_b.stat_region_code").alias("stat_region_code")),
        "unmatched_a": both.where("_n IS NULL").select(*own),
        "unmatched_b": right.join(both.where("_a IS NULL").select("_k"), "_k", "left_semi").drop("_k"),
        "duplicates": one.where("_n > 1").select(F.col("_k").alias("key"), F.col("_n").alias("n")),
        "conflicts": prefixes.where(F.size("codes") > 1),
        "sides": both.select(F.col("_k").alias("key"), F.when(F.col("_a").isNull(), "unmatched_b").when(F.col("_n").isNull(), "unmatched_a").otherwise("matched").alias("state"), *own, F.col("_b.stat_code").alias("stat_code")),
    }


def boundaries(shapes: DataFrame, units: DataFrame) -> DataFrame:
    """Boundary rows with the unit and region codes of the crosswalk."""
    return shapes.join(units.select(F.col("stat_code").alias("dong_code"), F.col("code").alias("admin_dong_code"), F.substring("code", 1, 5).alias("gu_code")), "dong_code", "left")


def place_reference(place_dim: DataFrame, prefix: str, pattern: str) -> dict[str, DataFrame]:
    """The place table for lookups: rows with normalised names, violations, alias keys of the
    units' names and the population's revision."""
    c = F.col
    rows = place_dim.select(*(text.place_name(c(k)).alias(k) for k in ("place_id", "admin_dong", "gu")))
    empty = F.coalesce(c("place_id") == "", F.lit(True)) | F.coalesce(c("admin_dong") == "", F.lit(True)) | F.coalesce(c("gu") == "", F.lit(True))
    reason = F.when(empty, "empty_field").when(~c("place_id").rlike(pattern), "id_form")
    bad = rows.select(reason.alias("violation"), "place_id").where("violation IS NOT NULL")
    by_id, by_unit = (rows.groupBy(*k).count().where("count > 1") for k in (["place_id"], ["admin_dong", "gu"]))
    bad = bad.unionByName(by_id.select(F.lit("duplicate_id").alias("violation"), "place_id"))
    bad = bad.unionByName(by_unit.select(F.lit("duplicate_unit").alias("violation"), F.concat_ws("/", "gu", "admin_dong").alias("place_id")))
    none = place_dim.agg(F.count("*").alias("n")).where("n = 0").select(F.lit("no_places").alias("violation"), F.lit(None).cast("string").alias("place_id"))
    keys = rows.select("place_id", "gu", F.explode(text.alias_keys(c("admin_dong"))).alias("alias_key"))
    return {"rows": rows, "violations": bad.unionByName(none), "aliases": keys, "revision": population_revision(rows, prefix)}


def resolve_place(questions: DataFrame, aliases: DataFrame, col: str) -> DataFrame:
    """Free-text locations with the places they may mean: any spelling of the text that is an
    alias of the place."""
    asked = questions.withColumn("alias_key", F.explode_outer(text.alias_keys(F.col(col))))
    found = asked.join(aliases, "alias_key").groupBy(*questions.columns).agg(F.array_sort(F.collect_set("place_id")).alias("place_ids"))
    return questions.join(found, questions.columns, "left")
