"""Data-quality assertions. Each gives the rows that break it; none means it holds."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brontide.functions.time_axes import day_floor, literal_hour
from brontide.operators import core
from brontide.plans import models

#: The source's categories, and those whose values are plain numbers.
CATEGORIES = ("POP", "PTY", "PCP", "REH", "SNO", "SKY", "TMP", "TMN", "TMX", "UUU", "VVV", "WAV", "VEC", "WSD")
NUMERIC = ("POP", "REH", "TMP", "TMN", "TMX", "UUU", "VVV", "VEC", "WSD")


@dataclass(frozen=True)
class Rule:
    """breaks: whether a row breaks it; each: columns of which every value is one violation, where
    it is not every row."""

    breaks: Column
    each: tuple[str, ...] = ()


def profile(df: DataFrame, rules: dict[str, Callable[[], Rule]], keep: list[str]) -> DataFrame:
    """How many rows there are of every combination of broken rules, of the values that rules
    count, and of the columns in keep: few rows, from one scan and one aggregate."""
    made = {name: rule() for name, rule in rules.items()}
    values = dict.fromkeys([*keep, *(c for r in made.values() for c in r.each)])
    flags = [F.coalesce(r.breaks, F.lit(False)).alias(f"breaks_{n}") for n, r in made.items()]
    return df.groupBy(*values, *flags).agg(F.count("*").alias("rows"))


def profile_violations(profiled: DataFrame, rules: dict[str, Callable[[], Rule]]) -> DataFrame:
    """(assertion, violations) of all rules, from one aggregate of a profile."""
    counts = []
    for name, rule in rules.items():
        broken, each = F.col(f"breaks_{name}"), rule().each
        # A struct of nulls is a value; a null is none.
        count = F.countDistinct(F.when(broken, F.struct(*each))) if each else F.sum(F.when(broken, F.col("rows")))
        counts.append(F.coalesce(count, F.lit(0)).cast("long").alias(name))
    one = profiled.agg(*counts)
    return one.select(F.inline(F.array(*(F.struct(F.lit(n).alias("assertion"), F.col(n).alias("violations")) for n in rules))))


def _silver_amount() -> Column:
    r, n, lo, hi = (F.col(c) for c in ("value_representation", "value_num", "value_lower_bound", "value_upper_bound"))
    return (r.isin("quantitative_exact", "bare_numeric") & n.isNull()) | ((r == "quantitative_range") & (lo.isNull() | n.isNotNull())) | ((r == "explicit_none") & (n.isNotNull() | lo.isNotNull())) | (lo > hi)


def _silver_code(types=tuple("01234"), skies=("1", "3", "4")) -> Column:
    code = F.col("qualitative_code")
    return ((F.col("category") == "PTY") & ~code.isin(*types)) | ((F.col("category") == "SKY") & ~code.isin(*skies))


def _silver_number() -> Column:
    return F.col("category").isin(*NUMERIC) & F.col("fcst_value_raw").isNotNull() & F.col("value_num").isNull()


#: The rules over single rows of silver; functions, as columns need a session.
SILVER_RULES: dict[str, Callable[[], Rule]] = {
    "D01_not_null": lambda: Rule(F.col("fcst_value_raw").isNull()),
    "D06": lambda: Rule(~F.col("event_at").eqNullSafe(F.col("forecast_at"))),
    "D07": lambda: Rule(~F.col("category").isin(*CATEGORIES), ("category",)),
    "D08": lambda: Rule(_silver_number(), ("category",)),
    "D09": lambda: Rule(F.col("category").isin("PCP", "SNO") & _silver_amount()),
    "D11": lambda: Rule(_silver_code(), ("category", "qualitative_code")),
    "D12": lambda: Rule(F.col("value_representation") == "unparseable", ("category", "fcst_value_raw")),
}


def key_violations(silver: DataFrame) -> DataFrame:
    """(assertion, violations) of the rules over keys of silver: keys that come twice (D02), and hours
    of no precipitation with an amount (D10). Both come from one scan: keys first, then their hours."""
    hour = ["place_id", "nx", "ny", "issued_at", "forecast_at"]
    of = lambda c, v: F.max(F.when(F.col("category") == c, F.col(v)))
    keys = silver.groupBy(*hour, "category").agg((F.count("*") > 1).alias("twice"), of("PTY", "qualitative_code").alias("pty"), of("PCP", "value_num").alias("amount"), of("PCP", "value_lower_bound").alias("low"))
    hours = keys.groupBy(*hour).agg(F.count_if("twice").alias("twice"), *(F.max(c).alias(c) for c in ("pty", "amount", "low")))
    dry = F.coalesce((F.col("pty") == "0") & (F.coalesce("amount", "low", F.lit(0.0)) > 0), F.lit(False))
    one = hours.agg(F.coalesce(F.sum("twice"), F.lit(0)).alias("D02"), F.count_if(dry).alias("D10"))
    return one.select(F.inline(F.array(*(F.struct(F.lit(n).alias("assertion"), F.col(n).alias("violations")) for n in ("D02", "D10")))))


def _kinds(parts: dict[str, DataFrame]) -> DataFrame:
    """Violations of several kinds: kind and the keys, as text."""
    return reduce(DataFrame.unionByName, [df.select(F.lit(k).alias("violation"), F.concat_ws("|", *df.columns).alias("key")) for k, df in parts.items()])


def not_null(df: DataFrame, *cols: str) -> DataFrame:
    return df.where(reduce(Column.__or__, [F.col(c).isNull() for c in cols]))


def unique(df: DataFrame, *key: str) -> DataFrame:
    return df.groupBy(*key).count().where("count > 1")


def accepted_values(df: DataFrame, col: str, allowed) -> DataFrame:
    return df.where(F.col(col).isNotNull() & ~F.col(col).isin(*allowed)).groupBy(col).count()


def coordinates_in_box(df: DataFrame, lon: str, lat: str, box=(124.0, 132.0, 33.0, 43.0)) -> DataFrame:
    return df.where(F.col(lon).isNotNull() & ~(F.col(lon).between(box[0], box[1]) & F.col(lat).between(box[2], box[3])))


def coverage(df: DataFrame, col: str, least: float) -> DataFrame:
    """One row if too few values are there; an empty table fails."""
    return df.agg(F.count("*").alias("row_count"), F.count(col).alias("filled")).where((F.col("row_count") == 0) | (F.col("filled") / F.nullif(F.col("row_count"), F.lit(0)) < least))


def only_publishable(silver: DataFrame, runs: DataFrame) -> DataFrame:
    return silver.groupBy("dag_run_id").count().join(runs, "dag_run_id", "left_anti")


def event_is_forecast_time(silver: DataFrame) -> DataFrame:
    return silver.where(~F.col("event_at").eqNullSafe(F.col("forecast_at")))


def category_domain(silver: DataFrame) -> DataFrame:
    return accepted_values(silver, "category", CATEGORIES)


def numbers_parsed(silver: DataFrame) -> DataFrame:
    return silver.where(_silver_number()).groupBy("category").count()


def amounts_consistent(silver: DataFrame) -> DataFrame:
    """Amounts whose columns contradict their class."""
    return silver.where(F.col("category").isin("PCP", "SNO") & _silver_amount())


def type_against_amount(silver: DataFrame) -> DataFrame:
    """Hours whose type says none but whose amount is positive; one pivot, no self-join."""
    key = ["place_id", "nx", "ny", "issued_at", "forecast_at"]
    of = lambda c, v: F.max(F.when(F.col("category") == c, F.col(v)))
    wide = silver.where(F.col("category").isin("PTY", "PCP")).groupBy(*key).agg(of("PTY", "qualitative_code").alias("pty"), of("PCP", "value_num").alias("amount"), of("PCP", "value_lower_bound").alias("low"))
    return wide.where((F.col("pty") == "0") & (F.coalesce("amount", "low", F.lit(0.0)) > 0))


def code_domain(silver: DataFrame, types=tuple("01234"), skies=("1", "3", "4")) -> DataFrame:
    return silver.where(_silver_code(types, skies)).groupBy("category", "qualitative_code").count()


def all_classified(silver: DataFrame) -> DataFrame:
    return silver.where(F.col("value_representation") == "unparseable").groupBy("category", "fcst_value_raw").count()


def canonical_grid(grid: DataFrame, expected: int = 80) -> DataFrame:
    form = F.concat(F.lit("kma_"), F.col("nx"), F.lit("_"), F.col("ny"))
    return _kinds(
        {
            "count": grid.agg(F.count("*").alias("n")).where(F.col("n") != expected),
            "duplicate_id": unique(grid, "grid_id"),
            "duplicate_cell": unique(grid, "nx", "ny"),
            "id_form": grid.where(F.col("grid_id") != form).select("grid_id"),
            "missing": not_null(grid, "grid_id", "nx", "ny", "coverage_scope").select("grid_id"),
        }
    )


def admin_axis(place_dim: DataFrame) -> DataFrame:
    return place_dim.where((F.col("gu_code") != F.substring("admin_dong_code", 1, 5)) | F.col("admin_dong_code").isNull())


def issue_window(mart: DataFrame, most: int = 2) -> DataFrame:
    return mart.groupBy("place_id", "forecast_at").agg(F.countDistinct("issued_at").alias("issues")).where(F.col("issues") > most)


def retention_window(mart: DataFrame, as_of: datetime) -> DataFrame:
    day, issued = literal_hour(day_floor(as_of, 1)), literal_hour(as_of - timedelta(hours=24))
    return mart.where((F.col("forecast_at") < day) | (F.col("issued_at") < issued))


def grid_covered(current: DataFrame, grid: DataFrame) -> DataFrame:
    return grid.join(current.select("grid_id").distinct(), "grid_id", "left_anti")


def windows_apart(windows: DataFrame, key: str) -> DataFrame:
    """Windows that overlap or touch the one before, or whose hours do not fill them."""
    before = F.lag("window_end_at").over(Window.partitionBy(key).orderBy("window_start_at"))
    rows = windows.withColumn("previous_end_at", before)
    near = F.timestamp_diff("HOUR", F.col("previous_end_at"), F.col("window_start_at")) <= 1
    count = F.col("precipitation_hour_count") != F.timestamp_diff("HOUR", F.col("window_start_at"), F.col("window_end_at")) + 1
    return rows.where(F.coalesce(near, F.lit(False)) | count)


def windows_reconcile(windows: DataFrame, hourly: DataFrame, as_of: datetime, key: str) -> DataFrame:
    """Keys whose wet hours differ between the windows and the hourly source; empty windows
    are right only where the source has no wet hour."""
    source = hourly.where((F.col("forecast_at") >= literal_hour(as_of)) & F.col("is_precipitating")).groupBy(key).agg(F.count("*").alias("source_hours"))
    product = windows.groupBy(key).agg(F.sum("precipitation_hour_count").alias("window_hours"))
    return source.join(product, key, "full_outer").where(~F.col("source_hours").eqNullSafe(F.col("window_hours")))


def current_ready(current: DataFrame, hourly: DataFrame, place_dim: DataFrame, as_of: datetime) -> DataFrame:
    """What keeps a current outlook from being served, by kind."""
    want = models.current_outlook(hourly, as_of).select("place_id", F.col("forecast_at").alias("want_at"), F.col("forecast_issued_at_max").alias("want_issue"))
    both = current.join(want, "place_id", "full_outer")
    past = current.where(F.col("forecast_at") < literal_hour(as_of))
    return _kinds(
        {
            "duplicate_place": unique(current, "place_id"),
            "null_key": not_null(current, "place_id", "forecast_at").select("place_id"),
            "past_hour": past.select("place_id"),
            "not_nearest": both.where(F.col("forecast_at").isNotNull() & ~F.col("forecast_at").eqNullSafe(F.col("want_at"))).select("place_id"),
            "missing_place": both.where(F.col("forecast_at").isNull()).select("place_id"),
            "older_issue": both.where(F.col("forecast_issued_at_max") < F.col("want_issue")).select("place_id"),
            "unknown_place": current.join(place_dim, "place_id", "left_anti").select("place_id"),
            "snapshot": current.where(F.col("snapshot_as_of_hour") != literal_hour(as_of)).select("place_id"),
        }
    )


def _recomputed(have: DataFrame, want: DataFrame, key: list[str]) -> DataFrame:
    """Keys that are on one side only or whose other columns differ."""
    cols = [c for c in want.columns if c not in key]
    a = have.select(*key, F.struct(*cols).alias("_have"))
    b = want.select(*key, F.struct(*cols).alias("_want"))
    return a.join(b, key, "full_outer").where(~F.col("_have").eqNullSafe(F.col("_want"))).select(*key)


def change_recomputes(change: DataFrame, mart: DataFrame, as_of: datetime) -> DataFrame:
    return _recomputed(change, models.forecast_change(mart, as_of), ["place_id", "forecast_date"])


def single_issue(hourly: DataFrame) -> DataFrame:
    return hourly.where(~F.col("forecast_issued_at_min").eqNullSafe(F.col("forecast_issued_at_max")))


def availability_holds(rows: DataFrame, hourly: DataFrame, place_dim: DataFrame, as_of: datetime, expected: int, prefix: str = "places:") -> DataFrame:
    c = F.col
    want = models.availability(hourly, place_dim, as_of, prefix)
    return _kinds(
        {
            "duplicate_place": unique(rows, "place_id"),
            "status": rows.where(~c("availability_status").isin("complete", "incomplete")).select("place_id"),
            "place_count": rows.agg(F.count("*").alias("n")).where(c("n") != expected),
            "population": rows.join(place_dim, "place_id", "left_anti").select("place_id"),
            "revision": rows.select("source_population_revision").distinct().join(want.select("source_population_revision").distinct(), "source_population_revision", "left_anti"),
            "recomputed": _recomputed(rows, want, ["place_id"]),
        }
    )


def future_only(risks: DataFrame, as_of: datetime) -> DataFrame:
    return risks.where(F.col("forecast_at") < literal_hour(as_of))


def freshness(rows: DataFrame, at: str, as_of: datetime, warn_minutes: int = 240, error_minutes: int = 360) -> DataFrame:
    """One row: the newest instant and its state; nothing at all is an error."""
    age = F.timestamp_diff("MINUTE", F.max(at), literal_hour(as_of))
    state = F.when(age.isNull() | (age > error_minutes), "error").when(age > warn_minutes, "warn").otherwise("ok")
    return rows.agg(F.max(at).alias("newest_at"), age.alias("age_minutes"), state.alias("freshness_state"))


def bounded_by_publishable(silver: DataFrame, manifest: DataFrame, source_id: str) -> DataFrame:
    """Silver without the rows of runs whose latest state is not publishable."""
    return core.among(silver, core.publishable_runs(models.run_states(manifest, source_id)), "dag_run_id", models.WINNER_ORDER)
