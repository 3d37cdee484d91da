"""Scans of raw responses and receipts, admission by manifest, and bronze rows. What a strict
loader would refuse becomes a quarantine row with its reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brontide.functions.text import joined_identity
from brontide.functions.time_axes import NTZ, slot_instant, wall_clock_from_parts
from brontide.operators.core import winner
from brontide.schemas import BRONZE_FORECAST, BRONZE_OBSERVATION, require_schema
from brontide.sources.partitions import PartitionedTable

#: Observation categories with units, and reasons of result codes.
UNITS = {"PTY": "code", "REH": "percent", "RN1": "mm", "T1H": "degC", "UUU": "m/s", "VEC": "degree", "VVV": "m/s", "WSD": "m/s"}
RESULT_CLASSES = {"00": "ok", "22": "quota", "23": "throttle", "20": "auth", "30": "auth", "31": "auth", "32": "auth"}
OBSERVED_TYPES = (0, 1, 2, 3, 5, 6, 7)

#: Partition columns of raw objects, all texts: a time like 0200 is no number.
RAW_PARTS = ("load_date", "run_id", "nx", "ny", "base_date", "base_time")
_ITEM = {**dict.fromkeys(("baseDate", "baseTime", "category", "fcstDate", "fcstTime", "fcstValue", "obsrValue"), "string"), "nx": "int", "ny": "int"}


def read_raw(spark: SparkSession, path: str, run_id: str | None = None, load_date: str | None = None) -> DataFrame:
    """Raw objects: their key, bytes, and what the folders of their key say. A run or load date
    that is asked for keeps other folders from being listed."""
    files = T.StructType().add("path", "string").add("modificationTime", "timestamp").add("length", "long").add("content", "binary")
    raw = spark.read.format("binaryFile").schema(T.StructType([*files, *(T.StructField(n, T.StringType()) for n in RAW_PARTS)])).load(path)
    for name, value in (("run_id", run_id), ("load_date", load_date)):
        if value is not None:
            raw = raw.where(F.col(name) == value)
    return raw.select(F.col("path").alias("raw_object_key"), "content", F.col("modificationTime").alias("stored_at"), *(F.col(n).alias(f"path_{n}") for n in RAW_PARTS))


def unwrap(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(items, quarantine) of raw objects, whose text is read once, as a variant: an item may be a
    list or a single object, and a field that does not fit its type is null, not its list."""
    get = lambda v, path, kind: F.try_variant_get(v, path, kind)
    of = lambda path, kind: get(F.col("_v"), f"$.response.{path}", kind)
    item = lambda v: F.struct(*(get(v, f"$.{n}", k).alias(n) for n, k in _ITEM.items()))
    rows = raw.withColumns({"_v": F.try_parse_json(F.decode("content", "UTF-8")), "payload_hash": F.sha2("content", 256)})
    kind = F.schema_of_variant(F.try_variant_get(F.col("_v"), "$.response.body.items.item", "variant"))
    many = F.filter(F.transform(of("body.items.item", "array<variant>"), item), lambda x: x["category"].isNotNull() | x["baseDate"].isNotNull())
    one = F.when(kind.startswith("OBJECT"), F.array(item(of("body.items.item", "variant"))))
    rows = rows.withColumns({"result_code": of("header.resultCode", "string"), "result_msg": of("header.resultMsg", "string"), "total_count": of("body.totalCount", "int"), "page_no": of("body.pageNo", "int"), "num_of_rows": of("body.numOfRows", "int"), "_items": F.coalesce(many, one, F.array())})
    reason = F.when(F.col("result_code").isNull(), "malformed_envelope").when(F.col("result_code") != "00", F.concat(F.lit("result_"), F.coalesce(result_class(F.col("result_code")), F.lit("other")))).when(F.col("total_count").isNull() | (F.size("_items") == 0), "no_items")
    rows = rows.withColumn("reason", reason).drop("_v", "content")
    bad = rows.where("reason IS NOT NULL").select("raw_object_key", "result_code", "reason")
    good = rows.where("reason IS NULL").withColumn("item_count", F.size("_items")).withColumn("item", F.explode("_items")).drop("_items", "reason")
    return good, bad


def whole_objects(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(items, refused objects): an observation is one page, so its totalCount is its number of rows."""
    bad = items.where(F.col("item_count") != F.col("total_count")).select("raw_object_key", F.lit("row_count").alias("reason")).distinct()
    return items.where(F.col("item_count") == F.col("total_count")), bad


def against_expected(expected: DataFrame, actual: DataFrame, key: list[str], group: list[str]) -> DataFrame:
    """One row for each group of either side: how many keys were expected and are there, and how
    many are missing, unexpected or there more than once. One symmetric difference serves ids, slots and revisions."""
    want = expected.select(*group, *key).distinct().withColumn("_want", F.lit(True))
    have = actual.groupBy(*group, *key).agg(F.count("*").alias("_have"))
    both = want.join(have, [*group, *key], "full_outer")
    c = F.col
    return both.groupBy(*group).agg(
        F.count("_want").alias("expected_count"),
        F.count("_have").alias("actual_count"),
        F.count_if(c("_have").isNull()).alias("missing"),
        F.count_if(c("_want").isNull()).alias("unexpected"),
        F.count_if(c("_have") > 1).alias("repeated"),
    )


def exact(differences: DataFrame) -> DataFrame:
    """Of differences the groups that are just what was expected."""
    return differences.where("missing = 0 AND unexpected = 0 AND repeated = 0 AND expected_count > 0")


def result_class(code: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in RESULT_CLASSES.items() for x in kv]), code)


def forecast_item_reason() -> Column:
    """Why an item is no forecast row; null if it is."""
    i = lambda n: F.col(f"item.{n}")
    blank = lambda n: F.trim(F.coalesce(i(n), F.lit(""))) == ""
    out = F.lit(None).cast("string")
    for n in ("fcstValue", "category", "fcstTime", "fcstDate", "baseTime", "baseDate"):
        out = F.when(blank(n), f"missing_{n}").otherwise(out)
    times = wall_clock_from_parts(i("baseDate"), i("baseTime")).isNull() | wall_clock_from_parts(i("fcstDate"), i("fcstTime")).isNull()
    cell = F.coalesce((i("nx") <= 0) | (i("ny") <= 0), F.lit(True))
    other = (i("baseDate") != F.col("path_base_date")) | (i("baseTime") != F.col("path_base_time")) | (i("nx") != F.col("path_nx").try_cast("int")) | (i("ny") != F.col("path_ny").try_cast("int"))
    return F.coalesce(out, F.when(times, "time_form").when(cell, "grid_cell").when(other, "context_mismatch"))


def incomplete_pages(items: DataFrame, key: list[str]) -> DataFrame:
    """Groups whose pages are not all there: missing or doubled pages, or too few rows."""
    pages = items.groupBy(*key, "raw_object_key").agg(F.max("page_no").alias("page_no"), F.max("total_count").alias("total"), F.max("num_of_rows").alias("rows"), F.count("*").alias("n"))
    out = pages.groupBy(*key).agg(F.collect_set("page_no").alias("pages"), F.count("page_no").alias("objects"), F.max("total").alias("total"), F.max("rows").alias("rows"), F.sum("n").alias("parsed"))
    last = F.greatest(F.ceil(F.col("total") / F.col("rows")).cast("int"), F.lit(1))
    out = out.withColumn("missing_pages", F.array_except(F.sequence(F.lit(1), last), "pages"))
    reason = F.when(F.size("missing_pages") > 0, "missing_page").when(F.col("objects") > F.size("pages"), "duplicate_page").when(F.col("parsed") < F.col("total"), "too_few_rows")
    return out.withColumn("reason", reason).where("reason IS NOT NULL")


def hash_mismatches(raw: DataFrame, expected: DataFrame) -> DataFrame:
    """Objects whose bytes have another SHA-256 than their receipt (raw_object_key, payload_hash)."""
    return raw.select("raw_object_key", F.sha2("content", 256).alias("found")).join(expected, "raw_object_key").where(F.col("found") != F.col("payload_hash"))


def admitted_manifests(manifests: DataFrame, objects: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(admitted, refused) manifests: complete, with equal counts, and naming exactly the stored
    keys of their run. objects: run_id and raw_object_key."""
    listed = manifests.select("run_id", F.explode("object_keys").alias("raw_object_key"))
    differs = listed.withColumn("l", F.lit(1)).join(objects.select("run_id", "raw_object_key").withColumn("o", F.lit(1)), ["run_id", "raw_object_key"], "full_outer").where("l IS NULL OR o IS NULL").select("run_id").distinct().withColumn("_differs", F.lit(True))
    rows = manifests.join(differs, "run_id", "left")
    reason = F.when(~F.col("status").isin("complete", "SUCCESS"), "status").when(F.col("expected_count") != F.col("actual_count"), "counts").when(F.size("object_keys") != F.col("actual_count"), "key_count").when(F.col("_differs"), "keys")
    rows = rows.withColumn("reason", reason).drop("_differs")
    return rows.where("reason IS NULL").drop("reason"), rows.where("reason IS NOT NULL")


def forecast_bronze(items: DataFrame, source_id: str, collected_at: str = "stored_at") -> DataFrame:
    """Items as bronze rows: collection in UTC without zone, load date on the local axis."""
    utc = F.to_utc_timestamp(F.col(collected_at), F.current_timezone()).cast(NTZ)
    i = lambda n: F.col(f"item.{n}")
    values = {
        "request_id": F.sha2(F.col("raw_object_key"), 256),
        "source_id": F.lit(source_id),
        "request_params_json": F.to_json(F.struct(i("baseDate").alias("base_date"), i("baseTime").alias("base_time"), i("nx").alias("nx"), i("ny").alias("ny"), F.col("page_no"))),
        "place_id": F.concat_ws("_", F.lit("grid"), i("nx"), i("ny")),
        "base_date": i("baseDate"),
        "base_time": i("baseTime"),
        "nx": i("nx"),
        "ny": i("ny"),
        "category": i("category"),
        "fcst_date": i("fcstDate"),
        "fcst_time": i("fcstTime"),
        "fcst_value": i("fcstValue"),
        "http_status": F.lit(200),
        "collected_at": utc,
        "load_date": F.date_format(utc + F.expr("INTERVAL 9 HOURS"), "yyyy-MM-dd"),
        "dag_run_id": F.col("path_run_id"),
    }
    return items.withColumns(values).select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in BRONZE_FORECAST))


def replay(raw: DataFrame, keys: list[str], cells: DataFrame, source_id: str) -> dict[str, DataFrame]:
    """A subset of raw objects as bronze rows again; publishable only if missing_cells is empty."""
    items, bad = unwrap(raw.where(F.col("raw_object_key").isin(keys)))
    items = items.withColumn("reason", forecast_item_reason())
    good = items.where("reason IS NULL")
    seen = good.select(F.col("item.nx").alias("nx"), F.col("item.ny").alias("ny")).distinct()
    return {"rows": forecast_bronze(good, source_id), "quarantine": bad.select("raw_object_key", "reason").unionByName(items.where("reason IS NOT NULL").select("raw_object_key", "reason")), "missing_cells": cells.select("nx", "ny").join(seen, ["nx", "ny"], "left_anti"), "pages": incomplete_pages(good.withColumns({"nx": F.col("item.nx"), "ny": F.col("item.ny")}), ["nx", "ny"])}


def load_check(bronze: DataFrame, run_id: str) -> DataFrame:
    """One row: what a run has in bronze."""
    return bronze.where(F.col("dag_run_id") == run_id).agg(F.count("*").alias("row_count"), F.countDistinct("raw_object_key").alias("raw_objects"), F.max("collected_at").alias("last_collected_at"))


def manifest_events(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(events to store, refused): a publishable run must have equal counts."""
    unequal = F.col("is_publishable") & ~(F.col("expected_rows").eqNullSafe(F.col("actual_rows")) & F.col("expected_raw_objects").eqNullSafe(F.col("actual_raw_objects")))
    return events.where(~F.coalesce(unequal, F.lit(False))), events.where(unequal)


MANIFEST_KEY = ["source_id", "dag_run_id", "status"]


def record_events(table: PartitionedTable, events: DataFrame) -> DataFrame:
    """Stores run events, one row for each (source, run, status), the newest told; gives those
    refused. table: partitioned by the day of event_at."""
    good, refused = manifest_events(events)
    table.upsert(winner(good, MANIFEST_KEY, ["event_at", "dag_id"]), MANIFEST_KEY)
    return refused


def observation_reason() -> Column:
    """Why an observed value is refused; null if it is good."""
    v, c = F.col("item.obsrValue").try_cast("double"), F.col("item.category")
    finite = v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))
    domain = (
        ((c == "PTY") & ~v.isin(*map(float, OBSERVED_TYPES)))
        | ((c == "REH") & ~v.between(0, 100))
        | ((c == "VEC") & ~v.between(0, 360))
        | (c.isin("RN1", "WSD") & (v < 0))
    )
    return F.when(~F.coalesce(c.isin(*UNITS), F.lit(False)), "category").when(~finite, "not_finite").when(domain, "domain")


def observation_bronze(items: DataFrame, source_id: str, manifest_key: str, revision: str, quality: str = "provisional") -> DataFrame:
    """Observed items as bronze rows with their idempotency key."""
    i = lambda n: F.col(f"item.{n}")
    local = wall_clock_from_parts(i("baseDate"), i("baseTime"))
    at = slot_instant(i("baseDate"), i("baseTime"))  # slots are local, instants UTC
    instant = F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
    slot, grid = F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss"), F.concat_ws("_", F.lit("kma"), i("nx"), i("ny"))
    units = F.try_element_at(F.create_map(*[F.lit(x) for kv in UNITS.items() for x in kv]), i("category"))
    values = {
        "idempotency_key": joined_identity(F.lit(source_id), instant, grid, i("category"), F.lit(revision)),
        "request_id": F.sha2(F.col("raw_object_key"), 256),
        "source_id": F.lit(source_id),
        "dag_run_id": F.col("path_run_id"),
        "manifest_key": F.lit(manifest_key),
        "observed_slot": slot,
        "observed_at": at,
        "base_date": i("baseDate"),
        "base_time": i("baseTime"),
        "grid_id": grid,
        "nx": i("nx"),
        "ny": i("ny"),
        "category": i("category"),
        "observed_value": i("obsrValue").try_cast("double"),
        "unit": units,
        "quality_status": F.lit(quality),
        "payload_sha256": F.col("payload_hash"),
        "source_revision": F.lit(revision),
        "http_status": F.lit(200),
        "collected_at": F.col("stored_at").cast(NTZ),
    }
    return items.withColumns(values).select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in BRONZE_OBSERVATION))


def slot_evidence(rows: DataFrame, grids: DataFrame) -> DataFrame:
    """What each slot of observed rows has against every category of every grid (grid_id): the
    counts of against_expected, rows whose slot is not their base time, and the number of runs."""
    slots = rows.select("observed_at").distinct()
    # Grids and categories are fixed sets of some dozens: they go as an array, not a join.
    cells = [r[0] for r in grids.select("grid_id").distinct().orderBy("grid_id").collect()]
    pairs = F.array(*(F.struct(F.lit(g).alias("grid_id"), F.lit(k).alias("category")) for g in cells for k in UNITS))
    expected = slots.select("observed_at", F.inline(pairs))
    base = slot_instant("base_date", "base_time")
    about = rows.groupBy("observed_at").agg(F.count_if(~F.col("observed_at").eqNullSafe(base)).alias("off_base"), F.countDistinct("dag_run_id").alias("runs"))
    return against_expected(expected, rows, ["grid_id", "category"], ["observed_at"]).join(about, "observed_at")


def admitted_slots(evidence: DataFrame) -> DataFrame:
    return exact(evidence).where("off_base = 0 AND runs = 1").select("observed_at")


def row_set_violations(rows: DataFrame, grids: DataFrame, expected_rows: int) -> DataFrame:
    """Why observed rows must not be loaded as one slot of one run: kind and count. The schema is
    checked as the rows are asked for."""
    rows = require_schema(rows, BRONZE_OBSERVATION)
    c = F.col
    about = rows.agg((F.count("*") != expected_rows).cast("long").alias("row_count"), (F.countDistinct("observed_at") != 1).cast("long").alias("slots"), (F.countDistinct("dag_run_id") != 1).cast("long").alias("runs"), (F.count("*") - F.countDistinct("idempotency_key")).alias("repeated_keys"))
    sets = slot_evidence(rows, grids).agg(F.sum(c("missing") + c("unexpected") + c("repeated")).alias("grid_categories"))
    kinds = lambda df: df.select(F.inline(F.array(*(F.struct(F.lit(k).alias("violation"), c(k).alias("n")) for k in df.columns))))
    return kinds(about).unionByName(kinds(sets)).where("n <> 0")


def complete_slots(rows: DataFrame, grids: int, categories: int = 8) -> DataFrame:
    """Slots with every grid and, in each, every category once, of one run."""
    by_grid = rows.groupBy("observed_at", "grid_id").agg(F.countDistinct("category").alias("c"), F.count("*").alias("n"), F.min("dag_run_id").alias("lo"), F.max("dag_run_id").alias("hi"))
    slots = by_grid.groupBy("observed_at").agg(F.count("*").alias("grids"), F.min("c").alias("least"), F.max("n").alias("most"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    return slots.where((F.col("grids") == grids) & (F.col("least") == categories) & (F.col("most") == categories) & (F.col("lo") == F.col("hi"))).select("observed_at")


def novel_observations(new: DataFrame, stored: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows to append, conflicts): keys already stored are skipped if their content is equal."""
    content = ["observed_value", "unit", "quality_status", "payload_sha256"]
    days = [r[0] for r in new.select(F.to_date("observed_at")).distinct().collect()]
    # Of a table laid out by day the partition column keeps other days from being listed.
    near = stored.where((F.col("observed_day") if "observed_day" in stored.columns else F.to_date("observed_at")).isin(days))
    old = near.select("idempotency_key", F.struct(*content).alias("_old"))
    both = new.withColumn("_new", F.struct(*content)).join(old, "idempotency_key")
    return new.join(near.select("idempotency_key"), "idempotency_key", "left_anti"), both.where(~F.col("_new").eqNullSafe(F.col("_old"))).select("idempotency_key")


def revision_scope(rows: DataFrame) -> DataFrame:
    """The revisions of each grid; more than one is a violation."""
    return rows.groupBy("grid_id").agg(F.array_sort(F.collect_set("source_revision")).alias("revisions"))


def slot_check(expected: DataFrame, rows: DataFrame) -> DataFrame:
    """One row of counters for a slot's exact revisions (expected: grid_id, source_revision)."""
    own = rows.withColumn("_per_grid", F.count("*").over(Window.partitionBy("grid_id", "source_revision")))
    both = expected.withColumn("_e", F.lit(1)).join(own, ["grid_id", "source_revision"], "full_outer")
    c = F.col
    return both.agg(
        F.countDistinct(F.when(c("_e") == 1, c("grid_id"))).alias("expected_grids"),
        F.countDistinct(F.when(c("idempotency_key").isNotNull(), c("grid_id"))).alias("actual_grids"),
        F.count("idempotency_key").alias("row_count"),
        F.countDistinct("idempotency_key").alias("distinct_keys"),
        F.countDistinct("observed_at").alias("slots"),
        F.countDistinct("dag_run_id").alias("runs"),
        F.countDistinct("raw_object_key").alias("raw_objects"),
        F.count_if(c("_e").isNull()).alias("unexpected_rows"),
        F.countDistinct(F.when(c("idempotency_key").isNull(), c("grid_id"))).alias("missing_grids"),
        F.countDistinct(F.when(c("_per_grid") != len(UNITS), c("grid_id"))).alias("odd_grids"),
    )


def master_rows(pages: DataFrame, columns: dict[str, str], run_id: str) -> DataFrame:
    """Reference master pages (a column data: array of string maps) as text columns."""
    rows = pages.withColumn("_r", F.explode("data"))
    return rows.select(*(F.try_element_at("_r", F.lit(k)).cast("string").alias(v) for k, v in columns.items()), F.lit(run_id).alias("dag_run_id"))


def load_master(stored: DataFrame | None, rows: DataFrame, expected: int) -> DataFrame | None:
    """Rows of a reference revision to append, or None if it is stored already; a revision of
    another number of rows than told, or of several revisions, raises."""
    about = rows.agg(F.count("*").alias("n"), F.countDistinct("revision_date").alias("revisions"), F.max("revision_date").alias("revision")).first()
    if about["n"] != expected or about["revisions"] != 1:
        raise ValueError(f"{about['n']} rows of {about['revisions']} revisions instead of {expected} of one")
    if stored is not None and not stored.where(F.col("revision_date") == about["revision"]).isEmpty():
        return None
    return rows


def latest_revision(rows: DataFrame, col: str = "revision_date") -> str | None:
    return rows.agg(F.max(col)).first()[0]


def grid_universe(seed: DataFrame, expected: int) -> tuple[DataFrame, DataFrame]:
    """(cells, one row with count and revision) of a coverage seed; ids default to their cell.
    A wrong count raises: the universe is a contract."""
    cells = seed.withColumn("grid_id", F.coalesce("grid_id", F.concat_ws("_", F.lit("kma"), "nx", "ny"))).dropDuplicates(["nx", "ny"])
    about = cells.agg(F.count("*").alias("grid_count"), F.sha2(F.to_json(F.array_sort(F.collect_list(F.struct("grid_id", "nx", "ny")))), 256).alias("revision"))
    if (n := about.first()["grid_count"]) != expected:
        raise ValueError(f"{n} grid cells instead of {expected}")
    return cells, about


def receipts(rows: DataFrame, fields: list[str], id_col: str, derived: Column) -> tuple[DataFrame, DataFrame]:
    """(good, quarantine) of JSON receipts: every field there, and the id as derived again."""
    missing = F.array_compact(F.array(*(F.when(F.col(f).isNull(), F.lit(f)) for f in fields)))
    marked = rows.withColumn("reason", F.when(F.size(missing) > 0, F.concat(F.lit("missing:"), F.array_join(missing, ","))).when(F.col(id_col) != derived, "identity"))
    return marked.where("reason IS NULL").drop("reason"), marked.where("reason IS NOT NULL")


def run_metrics(results: DataFrame, domain: str, target: str | None = None) -> DataFrame:
    """Build results (columns metadata and results, as the build tool writes them) as one metric
    row for each node. Warnings are successes, and rows that are not known are null."""
    rows = results.withColumn("_r", F.explode("results"))
    said = F.lower(F.coalesce("_r.status", F.lit("")))
    status = F.when(said.isin("success", "pass", "warn"), "success").when(said == "skipped", "skipped").otherwise("failed")
    timing = lambda name: F.get(F.filter("_r.timing", lambda t: t["name"] == name), 0)
    when = lambda k: F.when(timing("execute")["started_at"].isNotNull(), timing("execute")[k]).otherwise(timing("compile")[k])
    affected = F.col("_r.adapter_response.rows_affected")
    return rows.select(
        F.lit("silver").alias("layer"),
        F.lit(domain).alias("domain"),
        F.nullif(F.element_at(F.split("_r.unique_id", r"\."), -1), F.lit("")).alias("task_id"),
        F.col("metadata.invocation_id").alias("run_id"),
        when("started_at").alias("started_at"),
        when("completed_at").alias("finished_at"),
        F.col("_r.execution_time").alias("duration_s"),
        F.when(affected >= 0, affected).alias("rows"),
        status.alias("status"),
        (said == "skipped").alias("skipped"),
        F.lit(target).alias("target"),
    )


def published_read(table: DataFrame, columns: list[str], at: str, mode: str = "full", newest=None, hours: int = 2) -> DataFrame:
    """A fixed projection: all of a table, a window behind its newest row, or what is newer."""
    if mode == "full":
        return table.select(columns)
    if newest is None:
        newest = table.agg(F.max(at)).first()[0]
    literal = F.lit(str(newest)).cast(NTZ)
    return table.select(columns).where(F.col(at) > literal if mode == "incremental" else F.col(at) >= literal - F.expr(f"INTERVAL {hours} HOURS"))
