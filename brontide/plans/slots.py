"""Collection slots: what was planned, what came, and what is missing after its deadline."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEADLINE_MINUTES = 60
#: Hours that the wall clock of issues is ahead of UTC.
OFFSET_HOURS = 9
#: Fixed values of the slot contract.
CONTRACT_VERSION = "v1"
CONTRACT_ID = "weather.vilage_fcst.v1"
SCHEDULE_VERSION = "weather.vilage_fcst.issue_cycle.v1"
SOURCE_ID = "kma_vilage_fcst"
DECLARED_BY = "weather_vilage_fcst_bronze"
BOUNDARY_TYPE = "weather_apihub_historical_earliest_issued_at"
RAW_EVIDENCE, HISTORICAL_EVIDENCE = "raw_manifest_verified", "weather_apihub_historical_range"
COLLECTION_STATES = ("observed", "source_empty_valid", "collection_failed", "not_scheduled", "missing_unknown")
RECOVERY_STATES = ("not_required", "pending", "recovered", "unrecoverable")
RECOVERY_CLASSES = ("raw_replay", "historical_query", "rolling_window", "full_refresh", "next_snapshot_diff", "none")
#: States that end a slot for good, and states that need a reason for their gap.
ENDED = ("observed", "source_empty_valid", "not_scheduled")
GAPS = ("collection_failed", "missing_unknown")

c = F.col


def utc_text(local: Column) -> Column:
    """A local wall-clock reading as ISO instant in UTC."""
    return F.date_format(local - F.expr(f"INTERVAL {OFFSET_HOURS} HOURS"), "yyyy-MM-dd'T'HH:mm:ss'+00:00'")


def slot_id(source: Column, slot_at: Column, grain: Column, contract_id: str = CONTRACT_ID) -> Column:
    """SHA-256 of the slot's JSON, names in order. slot_at: local wall clock; grain: a struct
    with its fields in order of their names."""
    payload = F.struct(F.lit(contract_id).alias("collection_contract_id"), utc_text(slot_at).alias("collection_slot_at"), F.lit(CONTRACT_VERSION).alias("contract_version"), grain.alias("grain"), source.alias("source_id"))
    return F.sha2(F.to_json(payload, {"ignoreNullFields": "false"}), 256)


def plan(cycles: DataFrame, grids: DataFrame, recovery_boundary: datetime | None = None, activated_at: datetime | None = None) -> DataFrame:
    """Every issue cycle (collection_slot_at, local wall clock) with every grid cell (place_id,
    nx, ny), from the activation instant on. The cells are a fixed set of some dozens: they go
    as one array, not a join."""
    cells = [tuple(r) for r in grids.select("place_id", "nx", "ny").distinct().orderBy("nx", "ny").collect()]
    if len({x[1:] for x in cells}) < len(cells) or not cells:
        raise ValueError("an issue cycle needs grid cells, each once")
    rows = cycles.select("collection_slot_at").distinct()
    if activated_at is not None:
        rows = rows.where(c("collection_slot_at") >= F.lit(str(activated_at)).cast("timestamp_ntz"))
    cell = F.explode(F.array(*(F.struct(F.lit(n).alias("nx"), F.lit(m).alias("ny"), F.lit(p).alias("place_id")) for p, n, m in cells)))
    rows = rows.select(F.lit(SOURCE_ID).alias("source_id"), "collection_slot_at", cell.alias("grain"))
    boundary = F.lit(None if recovery_boundary is None else str(recovery_boundary)).cast("timestamp_ntz")
    return rows.select(
        slot_id(c("source_id"), c("collection_slot_at"), c("grain")).alias("expected_slot_id"),
        "source_id",
        F.lit(CONTRACT_ID).alias("collection_contract_id"),
        F.lit(SCHEDULE_VERSION).alias("schedule_version"),
        "collection_slot_at",
        (c("collection_slot_at") + F.expr(f"INTERVAL {DEADLINE_MINUTES} MINUTES")).alias("deadline_at"),
        c("grain.place_id").alias("place_id"),
        c("grain.nx").alias("nx"),
        c("grain.ny").alias("ny"),
        F.to_json("grain").alias("grain_json"),
        F.lit(BOUNDARY_TYPE).alias("recovery_boundary_type"),
        boundary.alias("recovery_boundary"),
        F.lit(DECLARED_BY).alias("declared_by"),
    )


CYCLE = ["place_id", "nx", "ny", "collection_slot_at"]


def outcomes(planned: DataFrame, raw: DataFrame, verified: DataFrame) -> DataFrame:
    """An outcome for each planned slot. raw: one row for each raw object with its cell, cycle,
    raw_object_key and row_count; verified: collection_slot_at and the rows that loading counted.

    A cycle is observed as a whole: its raw objects name exactly the planned cells, each has
    rows, no key comes twice, and their sum is the verified number. Else all its slots failed;
    slots of a cycle that nothing is known of are missing.
    """
    cells = raw.groupBy(*CYCLE).agg(F.sum("row_count").alias("row_count"), F.count("*").alias("raw_object_count"))
    cycle = raw.groupBy("collection_slot_at").agg(F.sum("row_count").alias("_sum"), (F.count("*") - F.countDistinct("raw_object_key")).alias("_twice"), F.countDistinct("place_id", "nx", "ny").alias("_cells"))
    joined = planned.join(cells, CYCLE, "left")
    whole = joined.groupBy("collection_slot_at").agg(F.count("*").alias("_planned"), F.count_if(c("row_count") > 0).alias("_filled"))
    cycle = whole.join(cycle, "collection_slot_at", "left").join(verified.select("collection_slot_at", "verified_rows"), "collection_slot_at", "left")
    good = (c("_filled") == c("_planned")) & (c("_cells") == c("_planned")) & (c("_twice") == 0) & (c("_sum") == c("verified_rows"))
    state = F.when(F.coalesce(good, F.lit(False)), "observed").when(c("_sum").isNotNull() | c("verified_rows").isNotNull(), "collection_failed").otherwise("missing_unknown")
    state = cycle.select("collection_slot_at", state.alias("collection_state"))
    return joined.join(state, "collection_slot_at")


def recovery(rows: DataFrame) -> DataFrame:
    """How a slot that is not observed can be had again: by its verified raw objects
    (raw_manifest_verified), by a query of the archive from the boundary on, or not at all."""
    failed = c("collection_state").isin(*GAPS)
    again = F.coalesce(c("raw_manifest_verified"), F.lit(False))
    archive = F.coalesce(c("collection_slot_at") >= c("recovery_boundary"), F.lit(False))
    state = F.when(~failed, "not_required").when(again | archive, "pending").otherwise("unrecoverable")
    kind = F.when(~failed, "none").when(again, "raw_replay").when(archive, "historical_query").otherwise("none")
    evidence = F.when(failed & again, RAW_EVIDENCE).when(failed & archive, HISTORICAL_EVIDENCE)
    return rows.withColumns({"recovery_state": state, "recovery_class": kind, "recovery_evidence_code": evidence, "gap_reason_code": F.when(c("collection_state") == "collection_failed", "collection_failed").when(failed, "missed_collection")})


def outcome_violations(rows: DataFrame) -> DataFrame:
    """Outcomes that break the contract, with the first rule that each breaks. Needs the state,
    recovery and gap columns, recovery_run_id and recovered_at."""
    known = lambda k, values: F.coalesce(c(k).isin(*values), F.lit(False))
    blank = lambda k: F.trim(F.coalesce(c(k), F.lit(""))) == ""
    state, again, kind = c("collection_state"), c("recovery_state"), c("recovery_class")
    needs_gap = state.isin(*GAPS) | (again == "unrecoverable")
    reason = (
        F.when(~known("collection_state", COLLECTION_STATES), "collection_state")
        .when(~known("recovery_state", RECOVERY_STATES), "recovery_state")
        .when(~known("recovery_class", RECOVERY_CLASSES), "recovery_class")
        .when(needs_gap & blank("gap_reason_code"), "gap_reason_missing")
        .when(state.isin(*ENDED) & ((again != "not_required") | (kind != "none")), "recovery_of_ended_slot")
        .when((again == "not_required") & (kind != "none"), "class_without_recovery")
        .when((again == "recovered") & (kind == "none"), "recovered_without_class")
        .when((again == "recovered") & (blank("recovery_run_id") | c("recovered_at").isNull()), "recovered_without_run")
        .when((again != "recovered") & (c("recovery_run_id").isNotNull() | c("recovered_at").isNotNull()), "run_without_recovery")
    )
    return rows.withColumn("reason", reason).where("reason IS NOT NULL")


def deduplicated(receipts: DataFrame, key: str, known: DataFrame | None = None) -> dict[str, DataFrame]:
    """Equal receipts collapse; unequal ones of one id conflict; events need a known slot."""
    content = F.to_json(F.struct(*sorted(receipts.columns)), {"ignoreNullFields": "false"})
    by = receipts.groupBy(key).agg(F.countDistinct(content).alias("_n"), F.first(F.struct(*receipts.columns)).alias("_r"))
    out = {"rows": by.where("_n = 1").select("_r.*"), "conflicts": by.where("_n > 1").select(key)}
    if known is not None:
        out["unknown_slots"] = out["rows"].join(known.select("expected_slot_id"), "expected_slot_id", "left_anti")
    return out


#: Fixed value: how a raw object's key names its cell and cycle.
RAW_KEY = r"/nx=(\d+)/ny=(\d+)/\d{8}T\d{6}KST_base-(\d{8})(\d{4})_[^/]+\.json$"


def covered_cycles(manifests: DataFrame, planned: DataFrame) -> dict[str, DataFrame]:
    """Complete manifests whose keys name exactly the planned cells of one cycle. A manifest
    with a key twice or with a key of another form covers nothing; a cycle that several
    manifests cover is ambiguous."""
    keys = manifests.where(c("status") == "complete").select("run_id", F.explode("object_keys").alias("k"))
    part = lambda i: F.regexp_extract("k", RAW_KEY, i)
    at = F.try_to_timestamp(F.concat(part(3), part(4)), F.lit("yyyyMMddHHmm")).cast("timestamp_ntz")
    read = keys.select("run_id", "k", part(1).try_cast("int").alias("nx"), part(2).try_cast("int").alias("ny"), at.alias("collection_slot_at"))
    want = planned.groupBy("collection_slot_at").agg(F.countDistinct("nx", "ny").alias("planned"))
    known = planned.select("nx", "ny", "collection_slot_at").distinct().withColumn("_known", F.lit(1))
    runs = read.join(known, ["nx", "ny", "collection_slot_at"], "left").groupBy("run_id").agg(
        F.count("*").alias("keys"), F.countDistinct("k").alias("distinct_keys"), F.count("_known").alias("known"), F.countDistinct("nx", "ny").alias("cells"), F.countDistinct("collection_slot_at").alias("cycles"), F.max("collection_slot_at").alias("collection_slot_at")
    )
    full = runs.where("keys = distinct_keys AND keys = known AND cycles = 1").join(want, "collection_slot_at").where("cells = planned")
    by = full.groupBy("collection_slot_at").agg(F.count("*").alias("runs"), F.min("run_id").alias("run_id"))
    return {"covered": by.where("runs = 1").drop("runs"), "ambiguous": by.where("runs > 1")}


def finalise(planned: DataFrame, events: DataFrame, now: Column) -> DataFrame:
    """Slots past their deadline without any outcome: missing for an unknown reason, once."""
    due = planned.where(c("deadline_at") <= now)
    left = due.join(events.select("expected_slot_id").distinct(), "expected_slot_id", "left_anti")
    missing = left.withColumns({"collection_state": F.lit("missing_unknown"), "raw_manifest_verified": F.lit(False)})
    return recovery(missing).select("expected_slot_id", "source_id", "collection_slot_at", "collection_state", "recovery_state", "recovery_class", "gap_reason_code", "recovery_evidence_code", c("deadline_at").alias("event_at"))


def candidate_cycle(interval_end: Column) -> Column:
    """The cycle that a reconciliation run looks at: 80 minutes before its interval ends."""
    return F.date_trunc("HOUR", interval_end - F.expr("INTERVAL 80 MINUTES")).cast("timestamp_ntz")


def daily_volumes(planned: DataFrame) -> DataFrame:
    """Calls a day by source, and of all together."""
    day = F.to_date("collection_slot_at").alias("call_date")
    one = planned.groupBy(day, "source_id").agg(F.count("*").alias("calls"))
    return one.unionByName(one.groupBy("call_date").agg(F.sum("calls").alias("calls")).withColumn("source_id", F.lit("combined")))
