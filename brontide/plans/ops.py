"""Records of operations as a table job: what a record must hold, what is derived, where it goes.

Rows come with the columns of INPUT; each is either a record or refused with the first rule that
it breaks. Records are written by category, domain and local date.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brontide.functions import text

SCHEMA_VERSION = "ops-record/v1"
#: The closed sets of the contract, and what each grain must name.
CATEGORIES = ("runs", "metrics", "errors", "logs", "reports", "recovery", "product-events", "product-health")
STATE_CATEGORIES = ("control", "receipts")
LAYERS = ("raw", "bronze", "silver", "gold", "d1")
STATUSES = ("success", "failed", "skipped", "degraded")
ROWS_SOURCES = ("raw_manifest", "bronze_run_manifest", "iceberg_snapshot", "count_query", "publication_ledger", "not_observed")
SINKS = ("file", "table", "db")
ENVIRONMENTS = ("dev", "prod")
REQUIRED = {
    "airflow_task": ("dag_id", "task_id", "run_id"),
    "dbt_node": ("task_id", "run_id"),
    "product_transition": ("dag_id", "run_id"),
    "product_health": ("dag_id", "run_id"),
    "publication": ("publication_id",),
    "control_state": ("dag_id",),
}
#: What makes a record the same one, and the signs of an address.
IDENTITY = ("domain", "layer", "grain", "dag_id", "task_id", "run_id", "try_number", "product_id", "publication_id")
_ADDRESS = r"(://|^/|\?|&|%[0-9A-Fa-f]{2})"
INPUT = "category string, domain string, layer string, grain string, status string, environment string, dag_id string, task_id string, run_id string, try_number int, observed_at timestamp, started_at timestamp, ended_at timestamp, row_count long, rows_source string, api_name string, sink_type string, publication_id string, product_ids array<string>"

c = F.col


def _in(column: str, allowed: tuple[str, ...]) -> Column:
    return F.coalesce(c(column).isin(*allowed), F.lit(False))


def _blank(column: str) -> Column:
    return F.trim(F.coalesce(c(column).cast("string"), F.lit(""))) == ""


def refusal() -> Column:
    """The first rule that a row breaks; null for a good one."""
    out = F.when(_in("category", STATE_CATEGORIES), "state_category").when(~_in("category", CATEGORIES), "category")
    out = out.when(_blank("domain") | ~c("domain").rlike(r"^[A-Za-z0-9][A-Za-z0-9._-]*$"), "domain").when(~_in("layer", LAYERS), "layer").when(~_in("grain", tuple(REQUIRED)), "grain").when(~_in("status", STATUSES), "status")
    out = out.when(~_in("rows_source", ROWS_SOURCES), "rows_source").when(~_in("environment", ENVIRONMENTS), "environment").when(c("sink_type").isNotNull() & ~_in("sink_type", SINKS), "sink_type")
    for grain, names in REQUIRED.items():
        for name in names:
            out = out.when((c("grain") == grain) & _blank(name), f"missing_{name}")
    unseen = c("rows_source") == "not_observed"
    out = out.when((c("grain") == "product_transition") & (F.coalesce(F.size("product_ids"), F.lit(0)) <= 0), "missing_product_ids")
    out = out.when(c("row_count").isNull() & ~unseen, "count_missing").when(c("row_count") < 0, "count_negative").when(c("row_count").isNotNull() & unseen, "count_without_source")
    return out.when(c("api_name").rlike(_ADDRESS), "holds_address")


def ops_records(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records, refused): refused rows carry the reason; records their derived columns."""
    judged = rows.withColumn("reason", refusal())
    products = F.array_sort(F.array_distinct(F.coalesce("product_ids", F.array().cast("array<string>"))))
    seconds = (F.unix_micros("ended_at") - F.unix_micros("started_at")) / 1_000_000
    good = judged.where("reason IS NULL").drop("reason").withColumns({"product_ids": products, "product_id": F.nullif(F.array_join(products, "|"), F.lit("")), "observed_at": F.coalesce("observed_at", "ended_at", "started_at"), "api_name": F.nullif(F.trim("api_name"), F.lit(""))})
    out = good.withColumns(
        {
            "schema_version": F.lit(SCHEMA_VERSION),
            "event_id": text.identity(**{k: c(k) for k in IDENTITY}),
            "duration_s": F.round(seconds, 3),
            "duration_hms": text.clock(seconds),
            "observed_date_kst": F.to_date(c("observed_at").cast("timestamp_ntz") + F.expr("INTERVAL 9 HOURS")),
        }
    )
    return out, judged.where("reason IS NOT NULL")


def write_records(records: DataFrame, path: str) -> None:
    """Appends records by category, domain and local date."""
    records.write.mode("append").partitionBy("category", "domain", "observed_date_kst").parquet(path)


def bootstrap_evidence(bronze: DataFrame, states: DataFrame, source_id: str, run_id: str) -> DataFrame:
    """One row: whether a pinned run's manifest and its bronze rows allow a first build."""
    m = lambda k: c(k)
    filled = lambda a, b: F.coalesce((m(a) == m(b)) & (m(a) > 0), F.lit(False))
    valid = m("status").eqNullSafe(F.lit("SUCCESS")) & m("is_publishable").eqNullSafe(F.lit(True)) & m("failure_reason").isNull() & filled("expected_rows", "actual_rows") & filled("expected_raw_objects", "actual_raw_objects")
    pinned = states.where(c("dag_run_id") == run_id).agg(F.count("*").alias("manifest_count"), F.count_if(~valid).alias("invalid_manifest_count"), F.coalesce(F.max("actual_rows").cast("long"), F.lit(-1)).alias("manifest_actual_rows"), F.coalesce(F.max("actual_raw_objects").cast("long"), F.lit(-1)).alias("manifest_actual_raw_objects"))
    rows = bronze.where((c("source_id") == source_id) & (c("dag_run_id") == run_id)).agg(F.count("*").alias("bronze_row_count"), F.countDistinct("raw_object_key").alias("bronze_raw_object_count"))
    both = rows.join(F.broadcast(pinned), F.lit(True))  # one row each
    good = (c("manifest_count") == 1) & (c("invalid_manifest_count") == 0) & (c("bronze_row_count") > 0) & (c("bronze_raw_object_count") > 0) & (c("bronze_row_count") == c("manifest_actual_rows")) & (c("bronze_raw_object_count") == c("manifest_actual_raw_objects"))
    return both.withColumn("admitted", good)
