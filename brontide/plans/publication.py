"""Publication as table jobs: gate, reliability, key and coverage checks, content digests,
staged writes with read-back, ledger rows, and the freshness watchdog."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brontide.functions import text
from brontide.functions.time_axes import NTZ, literal_hour
from brontide.sources.tables import VersionedTable


#: What a gate decides, with the serving status that is recorded.
DECISIONS = {"publish": "published", "publish_degraded": "degraded", "skip_retain": "skipped_retained", "fail": "failed"}
#: Policies for an empty candidate, and for rows of too few samples.
ZERO_POLICIES = {"fail": "fail", "allow": "publish", "warn": "publish_degraded", "retain_last_good": "skip_retain"}
SAMPLE_POLICIES = ("allow", "suppress_row", "flag_degraded")


@dataclass(frozen=True)
class Contract:
    """How one product is published."""

    product: str
    key: tuple[str, ...]
    columns: dict[str, str]  # name -> INTEGER, REAL or TEXT
    zero_policy: str = "retain_last_good"
    partial_min_ratio: float | None = None
    coverage: dict[str, tuple[int, float]] = field(default_factory=dict)  # column -> distinct values expected, least share
    freshness_field: str | None = None
    slo_minutes: int = 360


def gate(rows: int, last_good: int | None, zero_policy: str, partial_min_ratio: float | None = None) -> str:
    """What to do with a candidate of so many rows. An empty one goes by its policy; one that
    has lost more than the ratio allows keeps the last good version."""
    if zero_policy not in ZERO_POLICIES:
        raise ValueError(f"no such policy: {zero_policy}")
    if rows == 0:
        return ZERO_POLICIES[zero_policy]
    if partial_min_ratio is not None and last_good and rows < last_good * partial_min_ratio:
        return "skip_retain"
    return "publish"


def gate_column(rows: Column, last_good: Column, zero_policy: str, partial_min_ratio: float | None = None) -> Column:
    """gate for many products at once."""
    if zero_policy not in ZERO_POLICIES:
        raise ValueError(f"no such policy: {zero_policy}")
    partial = F.lit(False) if partial_min_ratio is None else (last_good > 0) & (rows < last_good * partial_min_ratio)
    return F.when(rows == 0, ZERO_POLICIES[zero_policy]).when(F.coalesce(partial, F.lit(False)), "skip_retain").otherwise("publish")


def reliable(rows: DataFrame, sample: str, least: float, policy: str = "allow") -> tuple[DataFrame, Column]:
    """(rows to write, whether the publication is degraded, as an aggregate of the input rows).
    suppress_row drops rows of fewer samples than the least, flag_degraded keeps them."""
    if policy not in SAMPLE_POLICIES:
        raise ValueError(f"no such policy: {policy}")
    value = F.col(sample).try_cast("double")
    enough = F.coalesce(value >= least, F.lit(False)) & ~F.isnan(F.coalesce(value, F.lit(0.0)))
    degraded = F.lit(False) if policy == "allow" else F.coalesce(F.bool_or(~enough), F.lit(False))
    return (rows.where(enough) if policy == "suppress_row" else rows), degraded


def key_stats(rows: DataFrame, key: tuple[str, ...], coverage: dict[str, tuple[int, float]] | None = None) -> DataFrame:
    """One row: rows, distinct keys, null keys, and distinct values of covered columns."""
    null = F.lit(False)
    for k in key:
        null = null | F.col(k).isNull()
    return rows.agg(F.count("*").alias("row_count"), F.countDistinct(F.struct(*key)).alias("distinct_keys"), F.count_if(null).alias("null_keys"), *(F.countDistinct(c).alias(f"distinct_{c}") for c in coverage or {}))


def key_violations(stats: DataFrame, coverage: dict[str, tuple[int, float]]) -> DataFrame:
    c = F.col
    checks = [F.when(c("distinct_keys") != c("row_count"), F.lit("duplicate_keys")), F.when(c("null_keys") > 0, F.lit("null_keys"))]
    checks += [F.when(c(f"distinct_{k}") / n < least, F.lit(f"coverage_{k}")) for k, (n, least) in coverage.items()]
    return stats.select(F.explode(F.array_compact(F.array(*checks))).alias("violation"))


def availability_violations(rows: DataFrame, place_dim: DataFrame, now: datetime, expected: int, slo_minutes: int) -> DataFrame:
    """What keeps availability evidence from being published, as reasons with counts."""
    c = F.col
    hourly = lambda k: F.coalesce(F.date_trunc("HOUR", c(k)).cast(NTZ) != c(k), F.lit(False))
    known = rows.join(place_dim.select("place_id", F.lit(True).alias("_known")), "place_id", "left")
    old = F.timestamp_diff("MINUTE", c("snapshot_as_of_hour"), F.lit(str(now)).cast(NTZ)) > slo_minutes
    one = known.agg(
        (F.count("*") != expected).cast("int").alias("place_count"),
        (F.count("*") - F.countDistinct("place_id")).cast("int").alias("duplicate_place"),
        F.count_if(c("_known").isNull()).cast("int").alias("unknown_place"),
        F.count_if(hourly("available_from_at") | hourly("available_to_at")).cast("int").alias("bounds_not_hourly"),
        F.count_if(c("available_from_at") > c("available_to_at")).cast("int").alias("bounds_order"),
        (F.countDistinct("snapshot_as_of_hour") > 1).cast("int").alias("snapshots_differ"),
        (F.countDistinct("expected_forecast_hour_count") > 1).cast("int").alias("horizons_differ"),
        (F.countDistinct("source_population_revision") > 1).cast("int").alias("revisions_differ"),
        F.count_if(old).cast("int").alias("too_old"),
    )
    pairs = F.array(*(F.struct(F.lit(k).alias("reason"), F.col(k).alias("n")) for k in one.columns))
    return one.select(F.explode(pairs).alias("x")).select("x.*").where("n <> 0")


def freshness_at(rows: DataFrame, column: str, upstream: DataFrame | None = None, upstream_column: str | None = None) -> datetime:
    """The product's newest instant; an empty product takes its upstream's. None fails."""
    newest = rows.agg(F.max(column)).first()[0]
    if newest is None and upstream is not None:
        newest = upstream.agg(F.max(upstream_column)).first()[0]
    if newest is None:
        raise ValueError("no freshness instant")
    return newest


def _cell(rows: DataFrame, column: str, kind: str) -> Column:
    """A value's text for digests. A REAL's shortest text tells values apart as well as 17
    digits do, so it stays in Spark; what a kind cannot hold is refused."""
    of = rows.schema[column].dataType.simpleString()
    if kind != "REAL":
        return text.canonical(F.col(column), kind, of)
    if of == "boolean":
        raise ValueError("a boolean is no REAL")
    value = F.col(column).try_cast("double")
    good = value.isNotNull() & ~F.isnan(value) & (F.abs(value) != float("inf"))
    return F.when(F.col(column).isNull(), F.lit(None).cast("string")).when(good, value.cast("string")).otherwise(F.raise_error(F.lit(f"{column}: a REAL is a finite number")).cast("string"))


def content_digest(rows: DataFrame, key: tuple[str, ...], columns: dict[str, str], namespace: str = "content") -> DataFrame:
    """One row: count and a digest that is equal for equal content in any order, and only with
    equal namespace, columns, kinds and key. Null and repeated keys are refused.

    Rows fall into buckets by 24 bits of their key's digest; each bucket's rows in order of the
    key's digest have one digest, and so have the buckets of 12 bits and all of them, so no task
    or value holds more than its part of the digests.
    """
    if not key or not set(key) <= set(columns) or not namespace:
        raise ValueError("a digest needs a namespace and a key among its columns")
    cells = {c: _cell(rows, c, k) for c, k in columns.items()}
    own = lambda c: F.coalesce(cells[c], F.raise_error(F.lit(f"{c}: a key is not null")).cast("string"))
    every = F.array(*(F.coalesce(F.concat(F.lit("V:"), cells[c]), F.lit("N:")) for c in columns))
    each = rows.select(F.sha2(F.to_json(F.array(*map(own, key))), 256).alias("k"), F.sha2(F.to_json(every), 256).alias("d"))
    lines = lambda part: F.array_join(F.transform(F.array_sort(F.collect_list(part)), lambda x: x["d"]), "")
    fine = each.groupBy(F.substring("k", 1, 6).alias("p")).agg(F.count("*").alias("n"), (F.count("*") - F.size(F.collect_set("k"))).alias("twice"), F.sha2(lines(F.struct("k", "d")), 256).alias("d"))
    coarse = fine.groupBy(F.substring("p", 1, 3).alias("p")).agg(F.sum("n").alias("n"), F.sum("twice").alias("twice"), F.sha2(lines(F.struct("p", "d")), 256).alias("d"))
    head = json.dumps([namespace, list(columns.items()), list(key)], ensure_ascii=False)
    whole = coarse.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"), F.coalesce(F.sum("twice"), F.lit(0)).alias("twice"), F.sha2(F.concat(F.lit(head), F.coalesce(lines(F.struct("p", "d")), F.lit(""))), 256).alias("d"))
    refused = F.raise_error(F.lit("a key comes twice")).cast("string")
    return whole.select("row_count", F.when(F.col("twice") == 0, F.col("d")).otherwise(refused).alias("content_digest"))


LEDGER = "product string, published_at string, row_count long, decision string, serving_status string, content_digest string, version int, violations string"


def publish(spark: SparkSession, candidate: DataFrame, contract: Contract, root: str, now: datetime, verify: Callable[[DataFrame], None] | None = None) -> dict:
    """Gate, stage, read back, compare digests, swap, ledger. Whatever fails before the swap, or
    is to be skipped, leaves the last good version as the table; only failures raise."""
    table = VersionedTable(spark, f"{root}/{contract.product}")
    last = table.read().count() if table.current() else None
    stats = key_stats(candidate, contract.key, contract.coverage)
    rows = stats.first()["row_count"]
    entry = {"product": contract.product, "published_at": str(now), "row_count": rows, "decision": gate(rows, last, contract.zero_policy, contract.partial_min_ratio), "serving_status": None, "content_digest": None, "version": None, "violations": ""}
    if entry["decision"] in ("publish", "publish_degraded"):
        bad = [r[0] for r in key_violations(stats, contract.coverage).collect()]
        if bad and rows:
            entry |= {"decision": "fail", "violations": ",".join(sorted(bad))}
        else:
            wanted = candidate.select(*contract.columns)
            before = content_digest(wanted, contract.key, contract.columns, contract.product).first()
            version = table.stage(wanted)
            staged = table.read(version)
            after = content_digest(staged, contract.key, contract.columns, contract.product).first()
            if before != after:
                entry |= {"decision": "fail", "violations": "content_differs"}
            else:
                if verify:
                    verify(staged)
                table.swap(version)
                entry |= {"content_digest": after["content_digest"], "version": version}
    entry["serving_status"] = DECISIONS[entry["decision"]]
    spark.createDataFrame([tuple(entry.values())], LEDGER).write.mode("append").parquet(f"{root}/_ledger")
    if entry["decision"] == "fail":
        raise RuntimeError(f"{contract.product} was not published: {entry['violations'] or 'row count'}")
    return entry


def restore(spark: SparkSession, root: str, product: str) -> int:
    """Makes the version before the current one the table again."""
    table = VersionedTable(spark, f"{root}/{product}")
    before = [v for v in table.versions() if v < (table.current() or 0)]
    version = before[-1] if before else 0
    table.read(version)
    table.swap(version)
    return version


def catalog_rows(spark: SparkSession, contracts: list[Contract], published: dict[str, dict]) -> DataFrame:
    rows = [(c.product, ",".join(c.key), len(c.columns), c.slo_minutes, published.get(c.product, {}).get("content_digest")) for c in contracts]
    return spark.createDataFrame(rows, "product string, key_columns string, column_count int, slo_minutes int, content_digest string")


def watchdog(contracts: DataFrame, evidence: DataFrame, now: datetime) -> DataFrame:
    """Each product with its list of issues. contracts: product, slo_minutes, needs_availability;
    evidence: product, publication_id, catalog_publication_id, fresh_at, availability_status."""
    c = F.col
    per = evidence.withColumn("_n", F.lit(1)).groupBy("product").agg(F.sum("_n").alias("n"), F.max("publication_id").alias("publication_id"), F.max("catalog_publication_id").alias("catalog_publication_id"), F.max("fresh_at").alias("fresh_at"), F.max("availability_status").alias("availability_status"))
    rows = contracts.join(per, "product", "left")
    age = F.timestamp_diff("MINUTE", c("fresh_at"), F.lit(str(now)).cast(NTZ))
    issues = F.array(
        F.when(c("n").isNull(), "missing"),
        F.when(c("n") > 1, "duplicated"),
        F.when(c("publication_id") != c("catalog_publication_id"), "id_mismatch"),
        F.when(c("n").isNotNull() & c("fresh_at").isNull(), "no_freshness"),
        F.when(age > c("slo_minutes"), "slo"),
        F.when(age < 0, "future"),
        F.when(c("needs_availability") & (F.coalesce("availability_status", F.lit("")) != "complete"), "availability"),
    )
    return rows.select("product", age.alias("age_minutes"), F.array_compact(issues).alias("issues"))


def availability_summary(rows: DataFrame) -> DataFrame:
    return rows.groupBy("product", "publication_id").agg(F.count("*").alias("place_count"), F.count_if(F.col("availability_status") == "complete").alias("complete_count"), F.min("available_from_at").alias("available_from_at"), F.max("available_to_at").alias("available_to_at"))


def publication_delay(events: DataFrame, fresh: str, published: str) -> DataFrame:
    """Minutes from data to publication, and what a missing value means."""
    delay = F.timestamp_diff("MINUTE", F.col(fresh), F.col(published))
    meaning = F.when(F.col(fresh).isNull(), "freshness_unknown").when(F.col(published).isNull(), "not_published").when(delay < 0, "clock_skew")
    return events.withColumns({"delay_minutes": F.when(delay >= 0, delay), "null_meaning": meaning})


def health_metrics(rows: DataFrame, at: str, as_of: datetime) -> DataFrame:
    """A product's metrics as name, value, unit and state; unknown is never zero."""
    age = F.timestamp_diff("MINUTE", F.max(at), literal_hour(as_of)).cast("double")
    entry = lambda n, v, u, empty: F.struct(F.lit(n).alias("name"), v.cast("double").alias("value"), F.lit(u).alias("unit"), F.when(v.isNull(), "unknown").otherwise("known").alias("quality_state"), F.when(v.isNull(), empty).alias("null_meaning"))
    return rows.agg(F.array(entry("row_count", F.count("*"), "rows", "not_counted"), entry("age", age, "minutes", "no_rows")).alias("metrics"))


def product_events(rows: DataFrame, fields: list[str]) -> tuple[DataFrame, DataFrame]:
    """(events, refused): id by content, local date, duration; a count needs its source."""
    pair = F.col("row_count").isNull() != F.col("row_count_source").isNull()
    unknown = (F.col("quality_state") == "unknown") & (F.col("row_count") == 0)
    url = F.lit(False)
    for f in fields:
        url = url | F.coalesce(F.col(f).cast("string").rlike("[a-z]+://"), F.lit(False))
    reason = F.when(pair, "count_without_source").when(unknown, "unknown_is_not_zero").when(url, "holds_url")
    seconds = F.timestamp_diff("SECOND", F.col("started_at"), F.col("ended_at"))
    out = rows.withColumns({"event_id": text.identity(**{f: F.col(f) for f in fields}), "event_date": F.to_date(F.col("ended_at") + F.expr("INTERVAL 9 HOURS")), "duration_s": seconds, "duration": text.clock(seconds), "reason": reason})
    return out.where("reason IS NULL").drop("reason"), out.where("reason IS NOT NULL")


def verify_queries(tables: dict[str, DataFrame], calls: dict[str, DataFrame], may_be_empty: set[str]) -> dict[str, int]:
    """Row counts of the published queries against a candidate; no rows fails unless allowed."""
    counts = {name: df.count() for name, df in calls.items()}
    if empty := [n for n, k in counts.items() if not k and n not in may_be_empty]:
        raise RuntimeError(f"no rows: {', '.join(sorted(empty))}")
    return counts
