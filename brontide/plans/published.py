"""The published queries: 77 parameterised reads of the gold products.

query(name)(tables, as_of, **params) gives a DataFrame. tables: the products by short name:
risk, windows, current, change, grid, grid_windows. Names, columns, parameters and defaults are
fixed values of the publication; a pattern says which product it reads, its filter, its groups
and its order. Relative defaults are resolved against the frozen hour on the driver, so plans
hold literals and filters reach the scan. Orders that leave ties end with the product's key.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from brontide.functions.time_axes import NTZ
from brontide.operators import core

Tables = dict[str, DataFrame]
c = F.col

#: What makes a row of each product unique, for orders that leave ties.
KEYS = {
    "risk": "place_id forecast_at",
    "windows": "place_id window_start_at",
    "current": "place_id",
    "change": "place_id forecast_date",
    "grid": "grid_id",
    "grid_windows": "grid_id window_start_at",
    "windows_now": "place_id window_start_at",
}


@dataclass(frozen=True)
class Relative:
    """A default that moves with the frozen hour: +2d, 0d, -1w, +1M or +1y, as date or datetime."""

    offset: str
    kind: str = "datetime"

    def resolved(self, as_of: datetime) -> str:
        number, unit = int(self.offset[:-1]), self.offset[-1]
        if unit in "dw":
            moved = as_of + timedelta(days=number * (7 if unit == "w" else 1))
        else:
            months = as_of.year * 12 + as_of.month - 1 + (number if unit == "M" else 12 * number)
            first = as_of.replace(year=months // 12, month=months % 12 + 1, day=1)
            # Days that the month does not have run over into the next one.
            moved = first + timedelta(days=as_of.day - 1)
        if self.kind == "date":
            return moved.strftime("%Y-%m-%d")
        # Only "now" keeps the clock; any other day starts at midnight.
        return moved.strftime("%Y-%m-%d %H:%M:%S" if number == 0 else "%Y-%m-%d 00:00:00")


NOW, DAYS2 = Relative("0d"), Relative("+2d")
TODAY, DAY2, DAY4 = Relative("0d", "date"), Relative("+2d", "date"), Relative("+4d", "date")
RANGE = {"from_at": NOW, "to_at": DAYS2}
DATES = {"from_date": TODAY, "to_date": DAY4}
#: Parameters that take no other values.
DIRECTIONS = ("asc", "desc")


class Params(dict):
    """Parameters of one call, with the literals that filters need."""

    def at(self, name: str) -> Column:
        return F.lit(str(self[name])).cast(NTZ)

    def day(self, name: str) -> Column:
        return F.lit(str(self[name])[:10]).cast("date")


Columns = Callable[[Params], dict[str, Column]]


@dataclass(frozen=True)
class Pattern:
    """One published query. order: names, with - before those that descend; n: rows at most,
    of a pattern whose limit is no parameter."""

    product: str
    columns: str
    order: str | Callable[[Params], str] = ""
    where: Callable[[Params], Column] | None = None
    derive: Columns | None = None
    group: str = ""
    aggregates: Columns | None = None
    having: Callable[[Params], Column] | None = None
    tie: str | None = None
    n: int | None = None
    defaults: dict = field(default_factory=dict)
    required: str = ""

    def rows(self, t: Tables, p: Params) -> DataFrame:
        out = t[self.product]
        if self.derive:
            out = out.withColumns(self.derive(p))
        if self.where:
            out = out.where(self.where(p))
        tie = self.tie
        if self.aggregates:
            out = out.groupBy(*self.group.split()).agg(*(v.alias(k) for k, v in self.aggregates(p).items()))
            tie = tie or self.group
        else:
            tie = tie or KEYS[self.product]
        if self.having:
            out = out.where(self.having(p))
        order = (self.order(p) if callable(self.order) else self.order).split()
        if order:
            order += [k for k in tie.split() if k not in order and f"-{k}" not in order]
            out = out.orderBy(*(F.desc_nulls_last(k[1:]) if k.startswith("-") else F.asc_nulls_first(k) for k in order))
        out = out.select(*self.columns.split())
        limit = p.get("n", self.n)
        return out if limit is None else out.limit(limit)


def _within(column: str):
    return lambda p: (c(column) >= p.at("from_at")) & (c(column) < p.at("to_at"))


def _of(column: str, name: str | None = None):
    return lambda p: c(column) == p[name or column]


def _both(*parts):
    def where(p: Params) -> Column:
        out = parts[0](p)
        for x in parts[1:]:
            out = out & x(p)
        return out

    return where


def _on(p: Params) -> Column:
    return c("forecast_date") == p.day("forecast_date")


def _at_least(column: str, name: str):
    return lambda p: c(column) >= p[name]


def _in_gu(p: Params) -> Column:
    return F.lit(True) if p["gu"] == "ALL" else c("gu") == p["gu"]


def _contains(column: str, name: str):
    return lambda p: F.contains(c(column), F.lit(p[name]))


def _changed(p: Params) -> Column:
    return _on(p) & (c("change_state") == "changed")


def _directed(column: str, *then: str):
    """By one column, the way that :dir says, then by others."""
    return lambda p: " ".join([("-" if p["dir"] == "desc" else "") + column, *then])


def _choice(values: dict[str, str], default: str | None):
    """The column that a parameter names."""

    def chosen(value: str) -> Column:
        name = values.get(value, default)
        return c(name) if name else F.lit(None).cast("double")

    return chosen


def _edge(p: Params) -> dict[str, Column]:
    return {"window_edge_at": c("window_end_at" if p["edge"] == "end" else "window_start_at")}


def _hours(p: Params) -> dict[str, Column]:
    return {"duration_hours": F.timestamp_diff("HOUR", c("window_start_at"), c("window_end_at")) + 1}


def _mean(column: str, digits: int) -> Column:
    return F.round(F.avg(column), digits)


def _n(**more):
    return lambda p: {k: v() for k, v in more.items()}


def _changes(p: Params) -> dict[str, Column]:
    return {
        "place_count": F.count("*"),
        "changed_count": F.count_if(c("change_state") == "changed"),
        "avg_max_temp_change_c": _mean("max_temp_change_c", 2),
        "min_max_temp_change_c": F.min("max_temp_change_c"),
        "avg_max_precip_prob_change_pct": _mean("max_precip_prob_change_pct", 2),
        "min_max_precip_prob_change_pct": F.min("max_precip_prob_change_pct"),
    }


RANKED = _choice({"temp": "temp_c", "humidity": "humidity_pct", "wind": "wind_ms", "precip": "precip_prob_pct"}, None)
AT_TIME = _choice({"temp_c": "temp_c", "wind_ms": "wind_ms"}, "precip_prob_pct")
MOVED = _choice({"min_temp": "min_temp_change_c", "max_precip": "max_precip_prob_change_pct"}, "max_temp_change_c")
RISK_AREA = _choice({"gu": "gu"}, "admin_dong")
CHANGE_AREA = _choice({"admin_dong": "admin_dong"}, "gu")

#: Column lists that several patterns share.
RISK = "place_id forecast_at risk_labels"
RISK_PLACE = "place_id place_name gu forecast_at temp_c wind_ms precip_prob_pct pty_code"
WINDOW = "place_id window_start_at window_end_at"
CHANGE = "place_id place_name gu forecast_date change_state min_temp_change_c max_temp_change_c max_precip_prob_change_pct"
GRID_WINDOW = "grid_id window_start_at window_end_at"

_PRECIPITATING = lambda p: c("is_precipitating")

PATTERNS: dict[str, Pattern] = {
    # Current outlook of places.
    "current_outlook_for_place": Pattern("current", "place_id place_name admin_dong gu forecast_at temp_c humidity_pct wind_ms precip_prob_pct sky_label pty_label is_precipitating forecast_lead_hours", where=_of("place_id"), required="place_id"),
    "current_outlook_for_gu": Pattern("current", "place_id place_name admin_dong gu forecast_at temp_c precip_prob_pct sky_label pty_label is_precipitating", "place_name", _of("gu_code"), defaults={"n": 100}, required="gu_code"),
    "precipitating_places_now": Pattern("current", "place_id place_name gu forecast_at precip_prob_pct pty_label pcp_raw sno_raw", "-precip_prob_pct place_name", _PRECIPITATING, defaults={"n": 50}),
    "highest_precip_probability": Pattern("current", "place_id place_name gu forecast_at precip_prob_pct pty_label is_precipitating", "-precip_prob_pct place_name", _at_least("precip_prob_pct", "min_precip_prob_pct"), defaults={"min_precip_prob_pct": 0, "n": 50}),
    "outlook_forecast_window": Pattern("current", "place_id place_name gu forecast_at temp_c precip_prob_pct sky_label pty_label", "forecast_at place_name", _within("forecast_at"), defaults={"from_at": TODAY, "to_at": DAYS2, "n": 100}),
    "hottest_places_now": Pattern("current", "place_id place_name gu forecast_at temp_c humidity_pct precip_prob_pct", "-temp_c place_name", defaults={"n": 20}),
    "strong_wind_places_now": Pattern("current", "place_id place_name gu forecast_at wind_ms wind_dir_deg sky_label pty_label", "-wind_ms place_name", _at_least("wind_ms", "min_wind_ms"), defaults={"min_wind_ms": 0, "n": 50}),
    "forecast_category_coverage_overview": Pattern("current", "forecast_category_count place_count", "forecast_category_count", group="forecast_category_count", aggregates=_n(place_count=lambda: F.count("*"))),
    "place_metric_ranking": Pattern("current", "place_id place_name admin_dong gu forecast_at temp_c humidity_pct wind_ms precip_prob_pct metric_value", lambda p: ("-" if p["dir"] == "desc" else "") + "metric_value place_name", derive=lambda p: {"metric_value": RANKED(p["metric"])}, defaults={"dir": "desc", "n": 20}, required="metric"),
    "gu_weather_summary": Pattern("current", "gu_code gu place_count avg_temp_c min_temp_c max_temp_c avg_humidity_pct avg_wind_ms max_precip_prob_pct", "-avg_temp_c gu", group="gu_code gu", aggregates=lambda p: {"place_count": F.count("*"), "avg_temp_c": _mean("temp_c", 1), "min_temp_c": F.min("temp_c"), "max_temp_c": F.max("temp_c"), "avg_humidity_pct": _mean("humidity_pct", 1), "avg_wind_ms": _mean("wind_ms", 2), "max_precip_prob_pct": F.max("precip_prob_pct")}),
    "muggy_places_threshold": Pattern("current", "place_id place_name admin_dong gu temp_c humidity_pct wind_ms forecast_at", "-temp_c -humidity_pct place_name", _both(_at_least("temp_c", "min_temp_c"), _at_least("humidity_pct", "min_humidity_pct")), defaults={"min_temp_c": 28, "min_humidity_pct": 60, "n": 50}),
    "compare_named_places": Pattern("current", "place_id place_name admin_dong gu forecast_at temp_c humidity_pct wind_ms precip_prob_pct sky_label pty_label", "place_name", lambda p: c("place_name").isin(p["names"]), required="names"),
    "outlook_collection_freshness": Pattern("current", "place_id place_name admin_dong gu forecast_collected_at_max forecast_issued_at_max forecast_at", _directed("forecast_collected_at_max", "place_name"), defaults={"dir": "desc", "n": 20}),
    "place_current_by_name_search": Pattern("current", "place_id place_name alias_names admin_dong gu forecast_at temp_c humidity_pct precip_prob_pct sky_label pty_label", "place_name", lambda p: _contains("place_name", "q")(p) | _contains("alias_names", "q")(p), defaults={"n": 50}, required="q"),
    "nearest_places_to_point": Pattern("current", "place_id place_name admin_dong gu latitude longitude temp_c humidity_pct precip_prob_pct sky_label pty_label dist_sq", "dist_sq place_name", derive=lambda p: {"dist_sq": (c("latitude") - p["lat"]) * (c("latitude") - p["lat"]) + (c("longitude") - p["lon"]) * (c("longitude") - p["lon"])}, defaults={"n": 10}, required="lat lon"),
    # Risk windows.
    "risk_windows_for_place": Pattern("risk", RISK, "forecast_at", _of("place_id"), required="place_id"),
    "upcoming_risk_windows": Pattern("risk", RISK, "forecast_at place_id", _within("forecast_at"), defaults={**RANGE, "n": 100}),
    "risk_label_candidates": Pattern("risk", RISK, "forecast_at place_id", _contains("risk_labels", "risk_label"), defaults={"n": 100}, required="risk_label"),
    "risk_candidates_for_place_window": Pattern("risk", RISK, "forecast_at", _both(_of("place_id"), _within("forecast_at")), defaults=RANGE, required="place_id"),
    "next_risk_candidate_for_place": Pattern("risk", RISK, "forecast_at", lambda p: (c("place_id") == p["place_id"]) & (c("forecast_at") >= p.at("as_of_at")), n=1, defaults={"as_of_at": NOW}, required="place_id"),
    "multi_risk_label_candidates": Pattern("risk", RISK, "forecast_at place_id", lambda p: F.contains("risk_labels", F.lit(",")), defaults={"n": 100}),
    "latest_risk_candidates": Pattern("risk", RISK, "-forecast_at place_id", defaults={"n": 20}),
    "risk_candidate_count_by_place": Pattern("risk", "place_id risk_candidate_count", "-risk_candidate_count place_id", _within("forecast_at"), group="place_id", aggregates=_n(risk_candidate_count=lambda: F.count("*")), defaults={**RANGE, "n": 100}),
    "place_risk_forecast_timeline": Pattern("risk", f"{RISK_PLACE} heat_risk cold_risk heavy_rain_risk snow_risk wind_risk risk_labels", "forecast_at", _of("place_id"), required="place_id"),
    "top_places_by_metric_at_time": Pattern("risk", RISK_PLACE, _directed("metric", "place_name"), lambda p: (c("forecast_at") == p.at("forecast_at")) & _in_gu(p), derive=lambda p: {"metric": AT_TIME(p["metric"])}, defaults={"gu": "ALL", "dir": "desc", "n": 15}, required="forecast_at metric"),
    "peak_temp_by_place": Pattern("risk", "place_id place_name gu peak_temp_c peak_wind_ms risk_hour_count", "-peak_temp_c -risk_hour_count place_name", _within("forecast_at"), group="place_id place_name gu", aggregates=_n(peak_temp_c=lambda: F.max("temp_c"), peak_wind_ms=lambda: F.max("wind_ms"), risk_hour_count=lambda: F.count("*")), having=lambda p: c("peak_temp_c") >= p["min_peak_temp"], defaults={**RANGE, "min_peak_temp": 35, "n": 20}),
    "risk_exposure_by_area": Pattern("risk", "area risk_hour_count place_count peak_temp_c peak_wind_ms", "-risk_hour_count area", _within("forecast_at"), derive=lambda p: {"area": RISK_AREA(p["dim"])}, group="area", aggregates=_n(risk_hour_count=lambda: F.count("*"), place_count=lambda: F.countDistinct("place_id"), peak_temp_c=lambda: F.max("temp_c"), peak_wind_ms=lambda: F.max("wind_ms")), defaults={**RANGE, "n": 25}, required="dim"),
    "risk_load_by_forecast_time": Pattern("risk", "forecast_at place_count peak_temp_c peak_wind_ms peak_precip_prob_pct", "forecast_at", _within("forecast_at"), group="forecast_at", aggregates=_n(place_count=lambda: F.countDistinct("place_id"), peak_temp_c=lambda: F.max("temp_c"), peak_wind_ms=lambda: F.max("wind_ms"), peak_precip_prob_pct=lambda: F.max("precip_prob_pct")), defaults=RANGE),
    "risk_windows_for_gu_set": Pattern("risk", RISK_PLACE, "gu forecast_at place_name", lambda p: c("gu").isin(p["gus"]) & _within("forecast_at")(p), defaults={**RANGE, "n": 100}, required="gus"),
    "high_precip_probability_windows": Pattern("risk", "place_id place_name gu forecast_at precip_prob_pct pty_code temp_c wind_ms", "-precip_prob_pct forecast_at place_name", _both(_at_least("precip_prob_pct", "min_precip_prob_pct"), _within("forecast_at")), defaults={**RANGE, "min_precip_prob_pct": 20, "n": 50}),
    "temp_severity_distribution": Pattern("risk", "temp_c risk_hour_count place_count forecast_hour_count", "-temp_c", _within("forecast_at"), group="temp_c", aggregates=_n(risk_hour_count=lambda: F.count("*"), place_count=lambda: F.countDistinct("place_id"), forecast_hour_count=lambda: F.countDistinct("forecast_at")), defaults=RANGE),
    # Precipitation windows of places.
    "precipitation_windows_for_place": Pattern("windows", WINDOW, "window_start_at", _of("place_id"), required="place_id"),
    "next_precipitation_window_for_place": Pattern("windows", WINDOW, "window_start_at", lambda p: (c("place_id") == p["place_id"]) & (c("window_start_at") >= p.at("as_of_at")), n=1, defaults={"as_of_at": NOW}, required="place_id"),
    "windows_starting_in_range": Pattern("windows", WINDOW, "window_start_at place_id", _within("window_start_at"), defaults={**RANGE, "n": 100}),
    "windows_overlapping_visit_window": Pattern("windows", WINDOW, "window_start_at place_id", lambda p: (c("window_start_at") < p.at("to_at")) & (c("window_end_at") >= p.at("from_at")), defaults={**RANGE, "n": 100}),
    "longest_precipitation_windows": Pattern("windows", f"{WINDOW} duration_hours", "-duration_hours window_start_at", derive=_hours, defaults={"n": 20}),
    "long_precipitation_windows_for_place": Pattern("windows", f"{WINDOW} duration_hours", "-duration_hours window_start_at", _both(_of("place_id"), _at_least("duration_hours", "min_duration_hours")), derive=_hours, defaults={"min_duration_hours": 1}, required="place_id"),
    "latest_starting_precipitation_windows": Pattern("windows", WINDOW, "-window_start_at place_id", defaults={"n": 20}),
    "precipitation_window_count_by_place": Pattern("windows", "place_id precipitation_window_count", "-precipitation_window_count place_id", _within("window_start_at"), group="place_id", aggregates=_n(precipitation_window_count=lambda: F.count("*")), defaults={**RANGE, "n": 100}),
    "precipitation_edge_hour_distribution": Pattern("windows", "window_edge_at place_count", "-place_count window_edge_at", derive=_edge, group="window_edge_at", aggregates=_n(place_count=lambda: F.count("*")), required="edge"),
    "active_precipitation_at_instant": Pattern("windows", WINDOW, "place_id", lambda p: (c("window_start_at") <= p.at("at")) & (c("window_end_at") >= p.at("at")), defaults={"at": NOW, "n": 100}),
    "precipitation_windows_by_edge_in_range": Pattern("windows", WINDOW, "window_edge_at place_id", _within("window_edge_at"), derive=_edge, defaults={**RANGE, "n": 100}, required="edge"),
    "precipitation_duration_distribution": Pattern("windows", "duration_hours place_count", "duration_hours", derive=_hours, group="duration_hours", aggregates=_n(place_count=lambda: F.count("*"))),
    "active_place_count_by_hour": Pattern("windows_by_edge", "hour_at active_place_count", "hour_at", tie="hour_at"),
    "precipitation_windows_for_place_set": Pattern("windows", WINDOW, "window_start_at place_id", lambda p: c("place_id").isin(p["places"]), defaults={"n": 100}, required="places"),
    "precipitation_windows_in_gu": Pattern("windows_now", "place_id place_name admin_dong gu window_start_at window_end_at", "window_start_at place_name", _of("gu_code"), defaults={"n": 100}, required="gu_code"),
    "precipitation_window_place_count_by_gu": Pattern("windows_now", "gu_code gu place_count earliest_window_start_at latest_window_end_at", "-place_count gu_code", group="gu_code gu", aggregates=_n(place_count=lambda: F.count("*"), earliest_window_start_at=lambda: F.min("window_start_at"), latest_window_end_at=lambda: F.max("window_end_at")), defaults={"n": 25}),
    # Change from one issue to the next.
    "forecast_change_for_place_date": Pattern("change", "place_name admin_dong gu forecast_date latest_issued_at previous_issued_at change_state min_temp_change_c max_temp_change_c max_precip_prob_change_pct latest_first_precipitation_at previous_first_precipitation_at", where=_both(_of("place_id"), _on), defaults={"forecast_date": TODAY}, required="place_id"),
    "changed_forecasts_for_date": Pattern("change", "place_id place_name gu forecast_date latest_issued_at previous_issued_at min_temp_change_c max_temp_change_c max_precip_prob_change_pct", "-latest_issued_at place_name", _changed, defaults={"forecast_date": TODAY, "n": 100}),
    "partial_comparison_forecasts": Pattern("change", "place_id place_name gu forecast_date latest_issued_at previous_issued_at latest_category_count previous_category_count change_state", "-latest_issued_at place_name", lambda p: _on(p) & (c("change_state") == "partial_comparison"), defaults={"forecast_date": TODAY, "n": 100}),
    "forecasts_without_previous_issue": Pattern("change", "place_id place_name gu forecast_date latest_issued_at change_state latest_category_count latest_forecast_hour_count", "-latest_issued_at place_name", lambda p: _on(p) & (c("change_state") == "no_previous_issue"), defaults={"forecast_date": TODAY, "n": 100}),
    "largest_temperature_change": Pattern("change", "place_id place_name gu forecast_date min_temp_change_c max_temp_change_c latest_issued_at previous_issued_at", "-size place_name", _changed, derive=lambda p: {"size": F.greatest(F.abs("min_temp_change_c"), F.abs("max_temp_change_c"))}, defaults={"forecast_date": TODAY, "n": 20}),
    "largest_precip_probability_change": Pattern("change", "place_id place_name gu forecast_date latest_max_precip_prob_pct previous_max_precip_prob_pct max_precip_prob_change_pct latest_first_precipitation_at previous_first_precipitation_at", "-size place_name", _changed, derive=lambda p: {"size": F.abs("max_precip_prob_change_pct")}, defaults={"forecast_date": TODAY, "n": 20}),
    "forecast_change_for_gu": Pattern("change", CHANGE, "place_name", _both(_of("gu_code"), _on), defaults={"forecast_date": TODAY, "n": 100}, required="gu_code"),
    "change_state_over_date_range": Pattern("change", "forecast_date change_state place_count", "forecast_date -place_count change_state", lambda p: (c("forecast_date") >= p.day("from_date")) & (c("forecast_date") < p.day("to_date")), group="forecast_date change_state", aggregates=_n(place_count=lambda: F.count("*")), defaults=DATES),
    "forecast_change_timeline_for_place": Pattern("change", f"{CHANGE} latest_forecast_hour_count previous_forecast_hour_count", "forecast_date", _of("place_id"), required="place_id"),
    "temp_change_by_area_for_date": Pattern("change", "area place_count changed_count avg_max_temp_change_c min_max_temp_change_c avg_max_precip_prob_change_pct", lambda p: ("avg_max_precip_prob_change_pct" if p["metric"] == "max_precip" else "avg_max_temp_change_c") + " area", _on, derive=lambda p: {"area": CHANGE_AREA(p["dim"])}, group="area", aggregates=_changes, defaults={"forecast_date": TODAY, "n": 25}, required="dim metric"),
    "forecast_movers_by_metric_direction": Pattern("change", f"{CHANGE} metric_change", _directed("metric_change", "place_name"), lambda p: _on(p) & _in_gu(p) & (c("metric_change") != 0), derive=lambda p: {"metric_change": MOVED(p["metric"])}, defaults={"gu": "ALL", "dir": "asc", "n": 20, "forecast_date": DAY2}, required="metric"),
    "forecasts_dropping_precipitation": Pattern("change", "place_id place_name gu forecast_date previous_first_precipitation_at latest_first_precipitation_at previous_max_precip_prob_pct latest_max_precip_prob_pct max_precip_prob_change_pct", "max_precip_prob_change_pct place_name", lambda p: c("previous_first_precipitation_at").isNotNull() & c("latest_first_precipitation_at").isNull(), defaults={"n": 100}),
    "forecast_change_for_places": Pattern("change", f"{CHANGE} latest_issued_at previous_issued_at", "place_name", lambda p: _on(p) & c("place_id").isin(p["place_ids"]), defaults={"forecast_date": TODAY}, required="place_ids"),
    "change_intensity_over_date_range": Pattern("change", "forecast_date place_count changed_count avg_max_temp_change_c min_max_temp_change_c avg_max_precip_prob_change_pct min_max_precip_prob_change_pct", "forecast_date", lambda p: (c("forecast_date") >= p.day("from_date")) & (c("forecast_date") < p.day("to_date")), group="forecast_date", aggregates=_changes, defaults=DATES),
    # Current outlook of grid cells.
    "all_current_grid_outlooks": Pattern("grid", "grid_id nx ny coverage_scope forecast_at temp_c precip_prob_pct sky_label pty_label", "grid_id"),
    "precipitating_grids_now": Pattern("grid", "grid_id nx ny forecast_at precip_prob_pct pty_label pcp_raw", "-precip_prob_pct grid_id", _PRECIPITATING),
    "high_precip_probability_grids": Pattern("grid", "grid_id forecast_at precip_prob_pct pty_label", "-precip_prob_pct grid_id", lambda p: c("precip_prob_pct") >= 60),
    "warmest_grids_now": Pattern("grid", "grid_id nx ny forecast_at temp_c humidity_pct", "-temp_c grid_id", n=20),
    "windiest_grids_now": Pattern("grid", "grid_id nx ny forecast_at wind_ms wind_dir_deg", "-wind_ms grid_id", n=20),
    "sky_distribution_now": Pattern("grid", "sky_label grid_count", "-grid_count sky_label", group="sky_label", aggregates=_n(grid_count=lambda: F.count("*"))),
    "category_coverage_distribution": Pattern("grid", "forecast_category_count grid_count", "forecast_category_count", group="forecast_category_count", aggregates=_n(grid_count=lambda: F.count("*"))),
    "collection_scope_freshness": Pattern("grid", "coverage_scope grid_count latest_collected_at", group="coverage_scope", aggregates=_n(grid_count=lambda: F.count("*"), latest_collected_at=lambda: F.max("forecast_collected_at_max"))),
    # Precipitation windows of grid cells.
    "all_grid_precipitation_windows": Pattern("grid_windows", "grid_id nx ny window_start_at window_end_at precipitation_hour_count", "window_start_at grid_id"),
    "earliest_grid_precipitation_windows": Pattern("grid_windows", f"{GRID_WINDOW} precip_prob_max_pct pcp_max_mm", "window_start_at grid_id", n=20),
    "longest_grid_precipitation_windows": Pattern("grid_windows", f"{GRID_WINDOW} precipitation_hour_count", "-precipitation_hour_count window_start_at grid_id", n=20),
    "highest_grid_precip_probability": Pattern("grid_windows", f"{GRID_WINDOW} precip_prob_max_pct", "-precip_prob_max_pct grid_id", n=20),
    "snowfall_candidate_windows": Pattern("grid_windows", f"{GRID_WINDOW} sno_max_cm", "-sno_max_cm grid_id", lambda p: c("sno_max_cm").isNotNull()),
    "high_precip_amount_windows": Pattern("grid_windows", f"{GRID_WINDOW} pcp_max_mm", "-pcp_max_mm grid_id", n=20),
    "precipitation_windows_by_scope": Pattern("grid_windows", "coverage_scope window_count", group="coverage_scope", aggregates=_n(window_count=lambda: F.count("*"))),
    "precipitation_window_freshness": Pattern("grid_windows", "latest_collected_at", group="", aggregates=_n(latest_collected_at=lambda: F.max("forecast_collected_at_max"))),
}


class _Views(dict):
    """The products, and what two patterns make of several of them."""

    def __init__(self, tables: Tables):
        super().__init__()
        self._tables = tables

    def __missing__(self, name: str) -> DataFrame:
        if name not in ("windows_now", "windows_by_edge"):
            return self._tables[name]
        if name == "windows_now":
            about = self["current"].select("place_id", "place_name", "admin_dong", "gu_code", "gu")
            return self["windows"].select("place_id", "window_start_at", "window_end_at").join(about, "place_id")
        return core.active_at_edges(self["windows"], "window_start_at", "window_end_at").select(c("edge_at").alias("hour_at"), c("active_count").alias("active_place_count"))


def names() -> list[str]:
    return list(PATTERNS)


def resolved(name: str, as_of: datetime | None, params: dict) -> Params:
    """All parameters of one call; unknown, missing or ill-valued ones are refused."""
    pattern = PATTERNS[name]
    required = pattern.required.split()
    if unknown := set(params) - set(pattern.defaults) - set(required):
        raise ValueError(f"{name} has no {sorted(unknown)}")
    if missing := set(required) - set(params):
        raise ValueError(f"{name} needs {sorted(missing)}")
    out = Params({k: v.resolved(as_of) if isinstance(v, Relative) else v for k, v in (pattern.defaults | params).items()})
    if out.get("dir", "asc") not in DIRECTIONS:
        raise ValueError(f"dir is one of {DIRECTIONS}")
    return out


def query(name: str) -> Callable[..., DataFrame]:
    """The query by name; parameters that are left out take their defaults."""

    def run(tables: Tables, as_of: datetime | None = None, **params) -> DataFrame:
        return PATTERNS[name].rows(_Views(tables), resolved(name, as_of, params))

    return run


def verified(tables: Tables, calls: dict[str, dict], as_of: datetime, allow_empty: set[str]) -> dict[str, tuple[str, int]]:
    """What each published query gives on candidate tables: (verified, rows), or (empty, 0) for
    one that must not be empty."""
    out = {}
    for name, params in calls.items():
        n = query(name)(tables, as_of, **params).count()
        out[name] = ("verified" if n or name in allow_empty else "empty", n)
    return out


def covered_range(t: Tables, place_id: str, from_at, to_at, cursor: tuple | None = None, limit: int = 100) -> DataFrame:
    """A page of one place's risk rows, with the context that says what an empty page means.

    The asked range must lie in the place's complete availability; else there is one row with
    the reason. t needs availability besides risk.
    """
    at = lambda v: F.lit(str(v)).cast(NTZ)
    own = t["availability"].where(c("place_id") == place_id)
    inside = (c("availability_status") == "complete") & (c("available_from_at") <= at(from_at)) & (c("available_to_at") >= at(to_at))
    context = own.select("place_id", "availability_status", "available_from_at", "available_to_at", F.coalesce(inside, F.lit(False)).alias("covered"))
    rows = t["risk"].where((c("place_id") == place_id) & (c("forecast_at") >= at(from_at)) & (c("forecast_at") <= at(to_at)))
    page = core.keyset_page(rows.select("place_id", "forecast_at", "product_row_id", "risk_labels"), ["forecast_at", "product_row_id"], cursor, limit)
    out = context.join(page, "place_id", "left")
    reason = F.when(~c("covered"), "range_not_covered").when(c("forecast_at").isNull(), "no_risk_in_range")
    shown = lambda k: F.when(c("covered"), c(k)).alias(k)
    return out.select("place_id", "covered", "available_from_at", "available_to_at", shown("forecast_at"), shown("product_row_id"), shown("risk_labels"), reason.alias("zero_result_reason")).distinct()


def covered_page(t: Tables, place_id: str, from_at, to_at, publication_id: str, cursor: str | None = None, limit: int = 100) -> tuple[list[Row], str | None]:
    """(rows of a page of covered_range, cursor of the next one or None). The cursor is good for this
    publication, place and range alone."""
    asked = core.fingerprint("covered_range", {"place_id": place_id, "from_at": str(from_at), "to_at": str(to_at)})
    at = None if cursor is None else core.cursor_values(cursor, publication_id, asked)
    rows = covered_range(t, place_id, from_at, to_at, at, limit).orderBy(F.asc_nulls_last("forecast_at"), "product_row_id").collect()
    if len(rows) <= limit:
        return rows, None
    return rows[:limit], core.cursor_of((rows[limit - 1].forecast_at, rows[limit - 1].product_row_id), publication_id, asked)
