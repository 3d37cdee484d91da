"""Forecasts against observed truth: selection, matching, metrics and evidence, as joins and
aggregates. Every check gives rows with a reason; strict=True raises after one count."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brontide.operators import core

#: Vintages by hours before the valid time, and hours that an issue may be older.
VINTAGES = {"D-3": 72, "D-2": 48, "D-1": 24}
LOOKBACK_HOURS = 3
PROVISIONAL_HOURS = 6
MIN_SAMPLES, MIN_COVERAGE = 30, 0.80
BINS = 10
VINTAGE_ID = ["product_family", "grid_id", "variable", "issued_at", "valid_at"]
TRUTH_ID = ["truth_source", "truth_revision", "grid_id", "variable", "observed_at"]
COHORT = ["product_family", "variable", "vintage_label", "valid_at", "value_kind", "unit"]
#: Versions of the policies, families by kind of value, units and better ends of metrics.
VINTAGE_POLICY, TRUTH_POLICY, GATE_VERSION, CLAIM_VERSION = "forecast-vintage-cutoff/v1", "observation-truth-policy/v1", "metric-evidence-gate/v1", "weather-forecast-quality-claim/v1"
FAMILIES = {"continuous": "continuous", "probability": "probabilistic", "categorical": "categorical"}
METRICS = {
    "continuous": {"mae": (None, "lower_is_better"), "rmse": (None, "lower_is_better"), "bias": (None, "zero_is_best")},
    "probabilistic": {"brier_score": ("probability_squared", "lower_is_better"), "expected_calibration_error": ("ratio", "lower_is_better")},
    "categorical": {
        "true_positive": ("count", "descriptive"),
        "false_positive": ("count", "lower_is_better"),
        "true_negative": ("count", "descriptive"),
        "false_negative": ("count", "lower_is_better"),
        "precision": ("ratio", "higher_is_better"),
        "recall": ("ratio", "higher_is_better"),
        "f1": ("ratio", "higher_is_better"),
        "accuracy": ("ratio", "higher_is_better"),
        "positive_prevalence": ("ratio", "descriptive"),
    },
}
#: The one categorical variable, and its labels.
CATEGORICAL_VARIABLE, OCCURRENCE, NO_OCCURRENCE = "precipitation_occurrence_category", "occurrence", "none"
#: What a cohort does not show.
LIMITATIONS = (
    "Synthetic fixtures prove contract behavior, not current Seoul forecast accuracy.",
    "Metrics are valid only for the declared product, variable, vintage, grid universe, and evaluation window.",
)
PROVISIONAL_LIMITATION = "Eligible provisional truth is present; evidence is degraded until final truth arrives."
EVIDENCE_LIMITATION = "The cohort is below metric-evidence-gate/v1 sample or coverage thresholds."


def _strict(violations: DataFrame, strict: bool) -> DataFrame:
    if strict and not violations.isEmpty():
        raise ValueError(f"{violations.count()} records break the contract")
    return violations


def _value_reason() -> Column:
    kind = F.col("value_kind")
    return (
        F.when(kind.isNull() | ~kind.isin("continuous", "probability", "binary", "categorical"), "value_kind")
        .when(kind.isin("continuous", "probability") & (F.col("value_double").isNull() | F.isnan("value_double") | (F.abs("value_double") == float("inf"))), "value")
        .when((kind == "probability") & ~F.col("value_double").between(0, 1), "probability_range")
        .when((kind == "binary") & F.col("value_bool").isNull(), "value")
        .when((kind == "categorical") & (F.trim(F.coalesce("value_text", F.lit(""))) == ""), "value")
    )


def _grid_reason() -> Column:
    form = F.concat(F.lit("kma_"), F.col("nx").cast("string"), F.lit("_"), F.col("ny").cast("string"))
    return F.when(F.col("grid_id").isNull() | (F.col("grid_id") != form), "grid_id").when((F.col("nx") <= 0) | (F.col("ny") <= 0), "grid_cell")


def vintage_violations(forecasts: DataFrame, strict: bool = False) -> DataFrame:
    """Rows and identities that break the contract of forecast vintages."""
    blank = F.when(F.trim(F.coalesce("unit", F.lit(""))) == "", "unit")
    order = F.when(F.col("issued_at").isNull() | F.col("valid_at").isNull(), "time").when(F.col("issued_at") >= F.col("valid_at"), "time_order")
    rows = forecasts.withColumn("reason", F.coalesce(_grid_reason(), _value_reason(), blank, order)).where("reason IS NOT NULL").select(*VINTAGE_ID, "reason")
    twice = forecasts.groupBy(*VINTAGE_ID).count().where("count > 1").select(*VINTAGE_ID, F.lit("duplicate_identity").alias("reason"))
    series = ["product_family", "grid_id", "variable", "valid_at"]
    drift = forecasts.groupBy(*series).agg(F.countDistinct(F.struct("value_kind", "unit")).alias("n"), F.min("issued_at").alias("issued_at")).where("n > 1").select(*VINTAGE_ID, F.lit("series_drift").alias("reason"))
    return _strict(rows.unionByName(twice).unionByName(drift), strict)


def truth_violations(truth: DataFrame, strict: bool = False) -> DataFrame:
    order = F.when((F.col("observed_at") > F.col("truth_as_of")) | (F.col("observed_at") > F.col("collected_at")) | (F.col("truth_as_of") > F.col("collected_at")), "time_order")
    quality = F.when(~F.coalesce(F.col("quality").isin("provisional", "final", "rejected"), F.lit(False)), "quality")
    rows = truth.withColumn("reason", F.coalesce(_grid_reason(), _value_reason(), order, quality)).where("reason IS NOT NULL").select(*TRUTH_ID, "reason")
    twice = truth.groupBy(*TRUTH_ID).count().where("count > 1").select(*TRUTH_ID, F.lit("duplicate_identity").alias("reason"))
    return _strict(rows.unionByName(twice), strict)


def select_vintages(forecasts: DataFrame, vintages: dict[str, int] | None = None, lookback: int = LOOKBACK_HOURS) -> DataFrame:
    """For every series and label the newest issue within the look-back before its cutoff. A
    label without one keeps its row, with nulls: a gap is never filled from another label."""
    key = ["product_family", "grid_id", "variable", "value_kind", "unit"]
    return core.asof_windows(forecasts, forecasts, key, "valid_at", "issued_at", vintages or VINTAGES, lookback, ["issued_at", "source_revision", "source_id"])


def resolve_truth(truth: DataFrame, as_of: datetime, provisional_hours: int = PROVISIONAL_HOURS) -> DataFrame:
    """Each observation's newest visible revision with why it is excluded, if it is.

    Rows of later revisions or collections are excluded by themselves and hidden from the rest;
    unequal values at the newest instant are a conflict.
    """
    now = F.lit(as_of.isoformat()).cast("timestamp")
    early = F.when(F.col("truth_as_of") > now, "future_truth_revision").when(F.col("collected_at") > now, "future_collection")
    seen = truth.withColumn("exclusion", early)
    visible, hidden = seen.where("exclusion IS NULL"), seen.where("exclusion IS NOT NULL")
    key = ["truth_source", "grid_id", "variable", "observed_at"]
    rest = [c for c in truth.columns if c not in key]
    value = F.struct("value_kind", "value_double", "value_bool", "value_text", "unit", "quality")
    by_instant = visible.groupBy(*key, "truth_as_of").agg(F.max_by(F.struct(*rest), "truth_revision").alias("w"), F.countDistinct(F.to_json(value)).alias("n"))
    newest = by_instant.groupBy(*key).agg(F.max_by(F.struct("w", "n"), "truth_as_of").alias("x")).select(*key, *(F.col(f"x.w.{c}").alias(c) for c in rest), F.col("x.n").alias("_n"))
    stale = (F.col("quality") == "provisional") & (F.col("observed_at") + F.expr(f"INTERVAL {provisional_hours} HOURS") < now)
    reason = F.when(F.col("_n") > 1, "conflicting_revisions").when(F.col("quality") == "rejected", "rejected_truth").when(stale, "stale_provisional_truth")
    return newest.withColumn("exclusion", reason).drop("_n").unionByName(hidden)


def many_sources(truth: DataFrame) -> DataFrame:
    """Match keys with more than one truth source."""
    return truth.where("exclusion IS NULL").groupBy("grid_id", "variable", "observed_at").agg(F.countDistinct("truth_source").alias("n")).where("n > 1")


def match(selected: DataFrame, resolved: DataFrame) -> DataFrame:
    """Selected vintages with their truth, or with the reason why they have none."""
    picked = resolved.where("exclusion IS NULL").select("grid_id", "variable", F.col("observed_at").alias("valid_at"), *(F.col(c).alias(f"truth_{c}") for c in ("value_kind", "value_double", "value_bool", "value_text", "unit", "quality")), "truth_source", "truth_revision")
    rows = selected.where("issued_at IS NOT NULL").join(picked, ["grid_id", "variable", "valid_at"], "left")
    pairs = {"continuous": "continuous", "probability": "binary", "categorical": "categorical"}
    kinds = F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for kv in pairs.items() for x in kv)), "value_kind") == F.col("truth_value_kind"), F.lit(False))
    reason = F.when(F.col("truth_source").isNull(), "missing_or_ineligible_truth").when(~F.col("unit").eqNullSafe(F.col("truth_unit")), "incompatible_unit").when(~kinds, "incompatible_value_kind")
    return rows.withColumn("match_reason", reason)


def row_scores(rows: DataFrame, forecast: str = "value_double", observed: str = "truth_value_double") -> DataFrame:
    """Error, absolute and squared error of each pair."""
    error = F.col(forecast) - F.col(observed)
    return rows.withColumns({"error": F.round(error, 12), "absolute_error": F.round(F.abs(error), 12), "squared_error": F.round(error * error, 12)})


def probability_scores(rows: DataFrame, forecast: str = "value_double", observed: str = "truth_value_bool") -> DataFrame:
    p, y = F.col(forecast), F.col(observed).cast("int")
    predicted = p >= 0.5
    outcome = F.when(predicted & (y == 1), "true_positive").when(predicted, "false_positive").when(y == 1, "false_negative").otherwise("true_negative")
    return rows.withColumns({"brier_component": F.round((p - y) * (p - y), 12), "predicted_occurrence": predicted, "classification_outcome": outcome})


def continuous_metrics(pairs: DataFrame, by: list[str], forecast: str, observed: str) -> DataFrame:
    e = F.col(forecast) - F.col(observed)
    mean = lambda c: F.round(F.avg(c), 12)
    return pairs.groupBy(*by).agg(F.count("*").alias("sample_count"), mean(F.abs(e)).alias("mae"), F.round(F.sqrt(F.avg(e * e)), 12).alias("rmse"), mean(e).alias("bias"))


def calibration_bins(pairs: DataFrame, by: list[str], forecast: str, observed: str) -> DataFrame:
    """All fixed bins of each group, empty ones too; the last includes its upper bound."""
    p, y = F.col(forecast), F.col(observed).cast("double")
    found = pairs.withColumn("bin_index", F.least(F.floor(p * BINS), F.lit(BINS - 1)).cast("int")).groupBy(*by, "bin_index").agg(F.count("*").alias("n"), F.round(F.avg(p), 12).alias("mean_forecast_probability"), F.round(F.avg(y), 12).alias("observed_frequency"))
    total = pairs.groupBy(*by).agg(F.count("*").alias("total"))
    every = total.withColumn("bin_index", F.explode(F.sequence(F.lit(0), F.lit(BINS - 1))))
    joined = every.join(found, [*by, "bin_index"], "left")
    gap = F.abs(F.col("mean_forecast_probability") - F.col("observed_frequency")) * F.col("n") / F.col("total")
    return joined.select(
        *by,
        "bin_index",
        (F.col("bin_index") / BINS).alias("lower_bound"),
        ((F.col("bin_index") + 1) / BINS).alias("upper_bound"),
        F.coalesce("n", F.lit(0)).cast("long").alias("sample_count"),
        "mean_forecast_probability",
        "observed_frequency",
        F.coalesce(F.round(gap, 12), F.lit(0.0)).alias("weighted_absolute_calibration_gap"),
    )


def probability_metrics(pairs: DataFrame, by: list[str], forecast: str, observed: str) -> DataFrame:
    """Brier score and expected calibration error in one aggregate over bins."""
    p, y = F.col(forecast), F.col(observed).cast("double")
    bins = pairs.groupBy(*by, F.least(F.floor(p * BINS), F.lit(BINS - 1)).alias("_b")).agg(F.count("*").alias("n"), F.sum((p - y) * (p - y)).alias("s"), F.sum(p).alias("p"), F.sum(y).alias("y"))
    return bins.groupBy(*by).agg(F.sum("n").alias("sample_count"), F.round(F.sum("s") / F.sum("n"), 12).alias("brier_score"), F.round(F.sum(F.abs(F.col("p") - F.col("y"))) / F.sum("n"), 12).alias("expected_calibration_error"))


def confusion_metrics(pairs: DataFrame, by: list[str], predicted: Column, observed: Column) -> DataFrame:
    """Counts and ratios; a ratio with nothing below the line is null."""
    counts = pairs.groupBy(*by).agg(
        F.count("*").alias("sample_count"),
        F.count_if(predicted & observed).alias("true_positive"),
        F.count_if(predicted & ~observed).alias("false_positive"),
        F.count_if(~predicted & ~observed).alias("true_negative"),
        F.count_if(~predicted & observed).alias("false_negative"),
    )
    c = F.col
    ratio = lambda a, b: a / F.nullif(b, F.lit(0))
    tp, fp, tn, fn, n = (c(k) for k in ("true_positive", "false_positive", "true_negative", "false_negative", "sample_count"))
    out = counts.withColumns({"precision": ratio(tp, tp + fp), "recall": ratio(tp, tp + fn), "accuracy": ratio(tp + tn, n), "positive_prevalence": ratio(tp + fn, n)})
    both = c("precision") + c("recall")
    return out.withColumn("f1", 2 * c("precision") * c("recall") / F.nullif(both, F.lit(0.0)))


def evidence_state(samples: Column, expected: Column, provisional: Column) -> Column:
    few = (samples < MIN_SAMPLES) | (F.coalesce(samples / F.nullif(expected, F.lit(0)), F.lit(0.0)) < MIN_COVERAGE)
    return F.when(few, "insufficient_evidence").when(provisional, "degraded").otherwise("sufficient")


def cohort_violations(matched: DataFrame, grids: DataFrame) -> DataFrame:
    """What keeps matched pairs from being evaluated: cells outside the universe, other
    categorical variables, other labels than occurrence and none."""
    known = matched.join(grids.select("grid_id").distinct().withColumn("_known", F.lit(True)), "grid_id", "left")
    paired = F.col("match_reason").isNull() & (F.col("value_kind") == "categorical")
    label = lambda k: F.coalesce(F.col(k).isin(OCCURRENCE, NO_OCCURRENCE), F.lit(False))
    reason = F.when(F.col("_known").isNull(), "grid_outside_universe").when(paired & (F.col("variable") != CATEGORICAL_VARIABLE), "categorical_variable").when(paired & ~(label("value_text") & label("truth_value_text")), "categorical_label")
    return known.withColumn("reason", reason).where("reason IS NOT NULL").select(*VINTAGE_ID, "vintage_label", "reason")


def cohorts(matched: DataFrame, expected: int) -> DataFrame:
    """One document row for each cohort: its metrics, counts, reasons, evidence state, revisions
    and limitations. All families come from one conditional aggregate over the matched pairs."""
    c = F.col
    good = c("match_reason").isNull()
    kind = c("value_kind")
    continuous, probable, categorical = (good & (kind == k) for k in FAMILIES)
    error = c("value_double") - c("truth_value_double")
    p, y = c("value_double"), c("truth_value_bool").cast("int")
    bin_of = F.least(F.floor(p * BINS), F.lit(BINS - 1))
    of = lambda condition, value: F.when(condition, value)
    said = F.when(probable, p >= 0.5).when(categorical, c("value_text") == OCCURRENCE)
    seen = F.when(probable, c("truth_value_bool")).when(categorical, c("truth_value_text") == OCCURRENCE)
    binned = [f(of(probable & (bin_of == i), v)).alias(f"_{n}{i}") for i in range(BINS) for n, f, v in (("p", F.sum, p), ("y", F.sum, y))]
    base = matched.groupBy(*COHORT).agg(
        F.count_if(good).alias("sample_count"),
        F.coalesce(F.bool_or(of(good, c("truth_quality") == "provisional")), F.lit(False)).alias("contains_provisional_truth"),
        F.array_sort(F.collect_set(of(good, c("truth_source")))).alias("truth_sources"),
        F.array_sort(F.collect_set(of(good, c("truth_revision")))).alias("truth_revisions"),
        *(F.count_if(c("match_reason") == r).alias(f"_{r}") for r in REASONS),
        F.round(F.avg(of(continuous, F.round(F.abs(error), 12))), 12).alias("mae"),
        F.round(F.sqrt(F.avg(of(continuous, F.round(error * error, 12)))), 12).alias("rmse"),
        F.round(F.avg(of(continuous, F.round(error, 12))), 12).alias("bias"),
        F.round(F.avg(of(probable, F.round((p - y) * (p - y), 12))), 12).alias("brier_score"),
        *binned,
        F.count_if(said & seen).alias("true_positive"),
        F.count_if(said & ~seen).alias("false_positive"),
        F.count_if(~said & ~seen).alias("true_negative"),
        F.count_if(~said & seen).alias("false_negative"),
    )
    none = F.lit(0.0)
    gap = sum((F.abs(F.coalesce(f"_p{i}", none) - F.coalesce(f"_y{i}", none)) for i in range(BINS)), none)
    judged = (kind != "continuous") & (c("sample_count") > 0)
    tp, fp, tn, fn = (c(k) for k in ("true_positive", "false_positive", "true_negative", "false_negative"))
    ratio = lambda a, b: F.when(judged, a / F.nullif(b, F.lit(0)))
    family = F.try_element_at(F.create_map(*(F.lit(x) for kv in FAMILIES.items() for x in kv)), "value_kind")
    out = base.withColumns(
        {
            "metric_family": family,
            "expected_calibration_error": F.when((kind == "probability") & (c("sample_count") > 0), F.round(gap / F.nullif(c("sample_count"), F.lit(0)), 12)),
            **{k: F.when(judged, c(k)) for k in ("true_positive", "false_positive", "true_negative", "false_negative")},
            "precision": ratio(tp, tp + fp),
            "recall": ratio(tp, tp + fn),
            "accuracy": ratio(tp + tn, c("sample_count")),
            "positive_prevalence": ratio(tp + fn, c("sample_count")),
            "excluded_counts": F.map_filter(F.map_from_arrays(F.array(*map(F.lit, REASONS)), F.array(*(c(f"_{r}") for r in REASONS))), lambda _, n: n > 0),
            "expected_count": F.lit(expected).cast("long"),
            "matched_coverage": c("sample_count") / F.lit(expected),
            "evidence_state": evidence_state(c("sample_count"), F.lit(expected), c("contains_provisional_truth")),
        }
    )
    both = c("precision") + c("recall")
    utc = F.date_format("valid_at", "yyyy-MM-dd HH:mm:ss'+00:00'")
    text = F.to_json(F.array("product_family", "variable", "vintage_label", utc, "metric_family", "unit"))
    notes = F.array(*map(F.lit, LIMITATIONS), F.when(c("contains_provisional_truth"), F.lit(PROVISIONAL_LIMITATION)), F.when(c("evidence_state") == "insufficient_evidence", F.lit(EVIDENCE_LIMITATION)))
    out = out.withColumns({"f1": 2 * c("precision") * c("recall") / F.nullif(both, F.lit(0.0)), "cohort_id": F.substring(F.sha2(text, 256), 1, 24), "limitations": F.array_compact(notes), "evidence_gate_version": F.lit(GATE_VERSION), "truth_policy_version": F.lit(TRUTH_POLICY)})
    return out.drop(*(f"_{n}{i}" for n in "py" for i in range(BINS)), *(f"_{r}" for r in REASONS))


#: Why a selected vintage has no pair.
REASONS = ("incompatible_unit", "incompatible_value_kind", "missing_or_ineligible_truth")


def exclusion_counts(selected: DataFrame, resolved: DataFrame, vintages: dict[str, int] | None = None) -> DataFrame:
    """Counts beside the cohorts: vintage gaps of every label, and excluded truth by reason."""
    labels = selected.sparkSession.createDataFrame([(k,) for k in sorted(vintages or VINTAGES)], "name string")
    gaps = selected.where("issued_at IS NULL").groupBy(F.col("vintage_label").alias("name")).agg(F.count("*").alias("n"))
    gaps = labels.join(gaps, "name", "left").select(F.lit("vintage_gap").alias("kind"), "name", F.coalesce("n", F.lit(0)).alias("n"))
    truth = resolved.where("exclusion IS NOT NULL").groupBy(F.col("exclusion").alias("name")).agg(F.count("*").alias("n"))
    return gaps.unionByName(truth.select(F.lit("truth_excluded").alias("kind"), "name", "n"))


def claims(cohort_rows: DataFrame) -> DataFrame:
    """Each metric of each cohort as a row, with a reason where it must not be claimed."""
    c = F.col
    entry = lambda family, m, unit, better: F.struct(F.lit(family).alias("metric_family"), F.lit(m).alias("metric_name"), c(m).cast("double").alias("metric_value"), F.lit(better).alias("metric_direction"), (c("unit") if unit is None else F.lit(unit)).alias("metric_unit"))
    entries = F.array(*(entry(f, m, *about) for f, own in METRICS.items() for m, about in own.items()))
    # A probability cohort has probabilistic and thresholded metrics; the others have their own.
    own = (c("m.metric_family") == c("cohort_family")) | ((c("cohort_family") == "probabilistic") & (c("m.metric_family") == "categorical"))
    rows = cohort_rows.withColumnRenamed("metric_family", "cohort_family").withColumn("m", F.explode(entries)).where(own & (c("sample_count") > 0))
    refused = F.when(c("evidence_state") == "insufficient_evidence", "insufficient_evidence").when((c("m.metric_name") == "accuracy") & (c("cohort_family") == "probabilistic"), "metric_scope_required")
    return rows.select(F.lit(CLAIM_VERSION).alias("schema_version"), "cohort_id", "m.*", "sample_count", "expected_count", "matched_coverage", "evidence_state", "limitations", refused.alias("refusal"))


def evidence_digest(cohort_rows: DataFrame) -> DataFrame:
    """One digest of all cohorts, whatever their order: rows fall into buckets by their id, each
    bucket's ordered digests have one, and so have all buckets."""
    plain = [F.to_json(k).alias(k) if t.startswith(("map", "array")) else F.col(k) for k, t in sorted(cohort_rows.dtypes)]
    each = cohort_rows.select("cohort_id", F.sha2(F.to_json(F.struct(*plain), {"ignoreNullFields": "false"}), 256).alias("d"))
    lines = lambda part: F.array_join(F.transform(F.array_sort(F.collect_list(part)), lambda r: r["d"]), "")
    fine = each.groupBy(F.substring("cohort_id", 1, 3).alias("p")).agg(F.sha2(lines(F.struct("cohort_id", "d")), 256).alias("d"))
    return fine.agg(F.sha2(F.coalesce(lines(F.struct("p", "d")), F.lit("")), 256).alias("evidence_revision"))


#: The categories of a complete observation.
OBSERVED = ("PTY", "REH", "RN1", "T1H", "UUU", "VEC", "VVV", "WSD")
SNAPSHOT = ["source_id", "grid_id", "nx", "ny", "observed_at", "collected_at", "payload_sha256", "source_revision"]


def observed_truth(observations: DataFrame) -> DataFrame:
    """Complete snapshots as provisional truth rows: temperature, and whether there was
    precipitation. A snapshot has each of the eight categories once, all from one payload."""
    value = lambda k: F.max(F.when(F.col("category") == k, F.col("observed_value")))
    wide = observations.groupBy(*SNAPSHOT).agg(F.count("*").alias("n"), F.countDistinct(F.when(F.col("category").isin(*OBSERVED), F.col("category"))).alias("own"), value("T1H").alias("t"), value("PTY").alias("pty"), value("RN1").alias("rn1"))
    wide = wide.where((F.col("n") == len(OBSERVED)) & (F.col("own") == len(OBSERVED)))
    wet = (F.col("pty") != 0) | (F.col("rn1") > 0)
    none = F.lit(None)
    rows = F.array(
        F.struct(F.lit("temperature_air_2m").alias("variable"), F.lit("continuous").alias("value_kind"), F.col("t").alias("value_double"), none.cast("boolean").alias("value_bool"), none.cast("string").alias("value_text"), F.lit("degC").alias("unit")),
        F.struct(F.lit("precipitation_occurrence").alias("variable"), F.lit("binary").alias("value_kind"), none.cast("double").alias("value_double"), wet.alias("value_bool"), none.cast("string").alias("value_text"), F.lit("1").alias("unit")),
    )
    about = [F.col("source_id").alias("truth_source"), F.col("source_revision").alias("truth_revision"), F.col("collected_at").alias("truth_as_of"), "collected_at", F.lit("provisional").alias("quality")]
    return wide.withColumn("r", F.explode(rows)).select("grid_id", "nx", "ny", "observed_at", *about, "r.*")
