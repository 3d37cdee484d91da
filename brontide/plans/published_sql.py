"""Each published query called over the driver's tables: its parameters and the SQL of the same."""

from __future__ import annotations

from brontide.plans.feed import AS_OF

_T = f"TIMESTAMP '{AS_OF}'"
_D = f"{_T}::DATE"
_TO = f"date_trunc('day', {_T} + INTERVAL 2 DAY)"


def _in_range(column: str) -> str:
    return f"{column} >= {_T} AND {column} < {_TO}"


_WINDOW = "place_id, window_start_at, window_end_at"
_CHANGE = "place_id, place_name, gu, forecast_date, change_state, min_temp_change_c, max_temp_change_c, max_precip_prob_change_pct"
_RISK = "SELECT place_id, forecast_at, risk_labels FROM risk"
_RISK_PLACE = "SELECT place_id, place_name, gu, forecast_at, temp_c, wind_ms, precip_prob_pct, pty_code FROM risk"
_HOURS = "date_sub('hour', window_start_at, window_end_at) + 1"
_CHANGED = "count(*) AS place_count, count(*) FILTER (change_state = 'changed') AS changed_count, round(avg(max_temp_change_c), 2) AS avg_max_temp_change_c, min(max_temp_change_c) AS min_max_temp_change_c, round(avg(max_precip_prob_change_pct), 2) AS avg_max_precip_prob_change_pct"
_NOW = "windows w JOIN current o ON o.place_id = w.place_id"

CALLS: dict[str, tuple[dict, str]] = {
    "current_outlook_for_place": ({"place_id": "place_4"}, "SELECT place_id, place_name, admin_dong, gu, forecast_at, temp_c, humidity_pct, wind_ms, precip_prob_pct, sky_label, pty_label, is_precipitating, forecast_lead_hours FROM current WHERE place_id = 'place_4'"),
    "current_outlook_for_gu": ({"gu_code": "11001"}, "SELECT place_id, place_name, admin_dong, gu, forecast_at, temp_c, precip_prob_pct, sky_label, pty_label, is_precipitating FROM current WHERE gu_code = '11001' ORDER BY place_name LIMIT 100"),
    "precipitating_places_now": ({}, "SELECT place_id, place_name, gu, forecast_at, precip_prob_pct, pty_label, pcp_raw, sno_raw FROM current WHERE is_precipitating ORDER BY precip_prob_pct DESC NULLS LAST, place_name LIMIT 50"),
    "highest_precip_probability": ({}, "SELECT place_id, place_name, gu, forecast_at, precip_prob_pct, pty_label, is_precipitating FROM current WHERE precip_prob_pct >= 0 ORDER BY precip_prob_pct DESC, place_name LIMIT 50"),
    "outlook_forecast_window": ({}, f"SELECT place_id, place_name, gu, forecast_at, temp_c, precip_prob_pct, sky_label, pty_label FROM current WHERE {_in_range('forecast_at')} ORDER BY forecast_at, place_name LIMIT 100"),
    "hottest_places_now": ({}, "SELECT place_id, place_name, gu, forecast_at, temp_c, humidity_pct, precip_prob_pct FROM current ORDER BY temp_c DESC NULLS LAST, place_name LIMIT 20"),
    "strong_wind_places_now": ({}, "SELECT place_id, place_name, gu, forecast_at, wind_ms, wind_dir_deg, sky_label, pty_label FROM current WHERE wind_ms >= 0 ORDER BY wind_ms DESC, place_name LIMIT 50"),
    "forecast_category_coverage_overview": ({}, "SELECT forecast_category_count, count(*) AS place_count FROM current GROUP BY forecast_category_count"),
    "place_metric_ranking": ({"metric": "wind"}, "SELECT place_id, place_name, admin_dong, gu, forecast_at, temp_c, humidity_pct, wind_ms, precip_prob_pct, wind_ms AS metric_value FROM current ORDER BY wind_ms DESC NULLS LAST, place_name LIMIT 20"),
    "gu_weather_summary": ({}, "SELECT gu_code, gu, count(*) AS place_count, round(avg(temp_c), 1) AS avg_temp_c, min(temp_c) AS min_temp_c, max(temp_c) AS max_temp_c, round(avg(humidity_pct), 1) AS avg_humidity_pct, round(avg(wind_ms), 2) AS avg_wind_ms, max(precip_prob_pct) AS max_precip_prob_pct FROM current GROUP BY gu_code, gu"),
    "muggy_places_threshold": ({"min_temp_c": -20, "min_humidity_pct": 0}, "SELECT place_id, place_name, admin_dong, gu, temp_c, humidity_pct, wind_ms, forecast_at FROM current WHERE temp_c >= -20 AND humidity_pct >= 0 ORDER BY temp_c DESC, humidity_pct DESC, place_name LIMIT 50"),
    "compare_named_places": ({"names": ["NATION_1", "NATION_9", "CANADA", "CHINA"]}, "SELECT place_id, place_name, admin_dong, gu, forecast_at, temp_c, humidity_pct, wind_ms, precip_prob_pct, sky_label, pty_label FROM current WHERE place_name IN ('NATION_1', 'NATION_9', 'CANADA', 'CHINA')"),
    "outlook_collection_freshness": ({}, "SELECT place_id, place_name, admin_dong, gu, forecast_collected_at_max, forecast_issued_at_max, forecast_at FROM current ORDER BY forecast_collected_at_max DESC NULLS LAST, place_name LIMIT 20"),
    "place_current_by_name_search": ({"q": "NATION_1"}, "SELECT place_id, place_name, alias_names, admin_dong, gu, forecast_at, temp_c, humidity_pct, precip_prob_pct, sky_label, pty_label FROM current WHERE contains(place_name, 'NATION_1') OR contains(alias_names, 'NATION_1') ORDER BY place_name LIMIT 50"),
    "nearest_places_to_point": ({"lat": 37.1, "lon": 126.9}, "SELECT place_id, place_name, admin_dong, gu, latitude, longitude, temp_c, humidity_pct, precip_prob_pct, sky_label, pty_label, (latitude - 37.1::DOUBLE) * (latitude - 37.1::DOUBLE) + (longitude - 126.9::DOUBLE) * (longitude - 126.9::DOUBLE) AS dist_sq FROM current ORDER BY dist_sq, place_name LIMIT 10"),
    "risk_windows_for_place": ({"place_id": "place_3"}, f"{_RISK} WHERE place_id = 'place_3'"),
    "upcoming_risk_windows": ({}, f"{_RISK} WHERE {_in_range('forecast_at')} ORDER BY forecast_at, place_id LIMIT 100"),
    "risk_label_candidates": ({"risk_label": "강풍후보"}, f"{_RISK} WHERE contains(risk_labels, '강풍후보') ORDER BY forecast_at, place_id LIMIT 100"),
    "risk_candidates_for_place_window": ({"place_id": "place_3", "to_at": "2024-01-25 00:00:00"}, f"{_RISK} WHERE place_id = 'place_3' AND forecast_at >= {_T} AND forecast_at < TIMESTAMP '2024-01-25'"),
    "next_risk_candidate_for_place": ({"place_id": "place_3"}, f"{_RISK} WHERE place_id = 'place_3' AND forecast_at >= {_T} ORDER BY forecast_at LIMIT 1"),
    "multi_risk_label_candidates": ({}, f"{_RISK} WHERE contains(risk_labels, ',') ORDER BY forecast_at, place_id LIMIT 100"),
    "latest_risk_candidates": ({}, f"{_RISK} ORDER BY forecast_at DESC, place_id LIMIT 20"),
    "risk_candidate_count_by_place": ({}, f"SELECT place_id, count(*) AS risk_candidate_count FROM risk WHERE {_in_range('forecast_at')} GROUP BY place_id ORDER BY risk_candidate_count DESC, place_id LIMIT 100"),
    "place_risk_forecast_timeline": ({"place_id": "place_3"}, f"{_RISK_PLACE.replace(' FROM', ', heat_risk, cold_risk, heavy_rain_risk, snow_risk, wind_risk, risk_labels FROM')} WHERE place_id = 'place_3'"),
    "top_places_by_metric_at_time": ({"metric": "wind_ms", "forecast_at": "2024-01-16 02:00:00"}, f"{_RISK_PLACE} WHERE forecast_at = TIMESTAMP '2024-01-16 02:00:00' ORDER BY wind_ms DESC NULLS LAST, place_name LIMIT 15"),
    "peak_temp_by_place": ({}, f"SELECT place_id, place_name, gu, max(temp_c) AS peak_temp_c, max(wind_ms) AS peak_wind_ms, count(*) AS risk_hour_count FROM risk WHERE {_in_range('forecast_at')} GROUP BY place_id, place_name, gu HAVING max(temp_c) >= 35 ORDER BY peak_temp_c DESC, risk_hour_count DESC, place_name LIMIT 20"),
    "risk_exposure_by_area": ({"dim": "gu"}, f"SELECT gu AS area, count(*) AS risk_hour_count, count(DISTINCT place_id) AS place_count, max(temp_c) AS peak_temp_c, max(wind_ms) AS peak_wind_ms FROM risk WHERE {_in_range('forecast_at')} GROUP BY gu ORDER BY risk_hour_count DESC, area LIMIT 25"),
    "risk_load_by_forecast_time": ({}, f"SELECT forecast_at, count(DISTINCT place_id) AS place_count, max(temp_c) AS peak_temp_c, max(wind_ms) AS peak_wind_ms, max(precip_prob_pct) AS peak_precip_prob_pct FROM risk WHERE {_in_range('forecast_at')} GROUP BY forecast_at"),
    "risk_windows_for_gu_set": ({"gus": ["REGION_1", "REGION_2", "AMERICA", "ASIA"]}, f"{_RISK_PLACE} WHERE gu IN ('REGION_1', 'REGION_2', 'AMERICA', 'ASIA') AND {_in_range('forecast_at')} ORDER BY gu, forecast_at, place_name LIMIT 100"),
    "high_precip_probability_windows": ({}, f"SELECT place_id, place_name, gu, forecast_at, precip_prob_pct, pty_code, temp_c, wind_ms FROM risk WHERE precip_prob_pct >= 20 AND {_in_range('forecast_at')} ORDER BY precip_prob_pct DESC, forecast_at, place_name LIMIT 50"),
    "temp_severity_distribution": ({}, f"SELECT temp_c, count(*) AS risk_hour_count, count(DISTINCT place_id) AS place_count, count(DISTINCT forecast_at) AS forecast_hour_count FROM risk WHERE {_in_range('forecast_at')} GROUP BY temp_c"),
    "precipitation_windows_for_place": ({"place_id": "place_4"}, f"SELECT {_WINDOW} FROM windows WHERE place_id = 'place_4'"),
    "next_precipitation_window_for_place": ({"place_id": "place_4"}, f"SELECT {_WINDOW} FROM windows WHERE place_id = 'place_4' AND window_start_at >= {_T} ORDER BY window_start_at LIMIT 1"),
    "windows_starting_in_range": ({}, f"SELECT {_WINDOW} FROM windows WHERE {_in_range('window_start_at')} ORDER BY window_start_at, place_id LIMIT 100"),
    "windows_overlapping_visit_window": ({"n": None}, f"SELECT {_WINDOW} FROM windows WHERE window_start_at < {_TO} AND window_end_at >= {_T}"),
    "longest_precipitation_windows": ({}, f"SELECT {_WINDOW}, {_HOURS} AS duration_hours FROM windows ORDER BY duration_hours DESC, window_start_at, place_id LIMIT 20"),
    "long_precipitation_windows_for_place": ({"place_id": "place_4"}, f"SELECT {_WINDOW}, {_HOURS} AS duration_hours FROM windows WHERE place_id = 'place_4' AND {_HOURS} >= 1"),
    "latest_starting_precipitation_windows": ({}, f"SELECT {_WINDOW} FROM windows ORDER BY window_start_at DESC, place_id LIMIT 20"),
    "precipitation_window_count_by_place": ({}, f"SELECT place_id, count(*) AS precipitation_window_count FROM windows WHERE {_in_range('window_start_at')} GROUP BY place_id ORDER BY precipitation_window_count DESC, place_id LIMIT 100"),
    "precipitation_edge_hour_distribution": ({"edge": "start"}, "SELECT window_start_at AS window_edge_at, count(*) AS place_count FROM windows GROUP BY window_start_at"),
    "active_precipitation_at_instant": ({"at": "2024-01-16 03:00:00"}, f"SELECT {_WINDOW} FROM windows WHERE window_start_at <= TIMESTAMP '2024-01-16 03:00:00' AND window_end_at >= TIMESTAMP '2024-01-16 03:00:00' ORDER BY place_id LIMIT 100"),
    "precipitation_windows_by_edge_in_range": ({"edge": "end"}, f"SELECT {_WINDOW} FROM windows WHERE {_in_range('window_end_at')} ORDER BY window_end_at, place_id, window_start_at LIMIT 100"),
    "precipitation_duration_distribution": ({}, f"SELECT {_HOURS} AS duration_hours, count(*) AS place_count FROM windows GROUP BY 1"),
    "active_place_count_by_hour": ({}, "SELECT h AS hour_at, count(*) AS active_place_count FROM (SELECT window_start_at AS h FROM windows UNION SELECT window_end_at FROM windows) JOIN windows ON window_start_at <= h AND window_end_at >= h GROUP BY h"),
    "precipitation_windows_for_place_set": ({"places": ["place_1", "place_9"]}, f"SELECT {_WINDOW} FROM windows WHERE place_id IN ('place_1', 'place_9') ORDER BY window_start_at, place_id LIMIT 100"),
    "precipitation_windows_in_gu": ({"gu_code": "11001"}, f"SELECT w.place_id, o.place_name, o.admin_dong, o.gu, w.window_start_at, w.window_end_at FROM {_NOW} WHERE o.gu_code = '11001' ORDER BY w.window_start_at, o.place_name LIMIT 100"),
    "precipitation_window_place_count_by_gu": ({}, f"SELECT o.gu_code, o.gu, count(*) AS place_count, min(w.window_start_at) AS earliest_window_start_at, max(w.window_end_at) AS latest_window_end_at FROM {_NOW} GROUP BY o.gu_code, o.gu ORDER BY place_count DESC, o.gu_code LIMIT 25"),
    "forecast_change_for_place_date": ({"place_id": "place_2"}, f"SELECT place_name, admin_dong, gu, forecast_date, latest_issued_at, previous_issued_at, change_state, min_temp_change_c, max_temp_change_c, max_precip_prob_change_pct, latest_first_precipitation_at, previous_first_precipitation_at FROM change WHERE place_id = 'place_2' AND forecast_date = {_D}"),
    "changed_forecasts_for_date": ({"forecast_date": "2024-01-16"}, "SELECT place_id, place_name, gu, forecast_date, latest_issued_at, previous_issued_at, min_temp_change_c, max_temp_change_c, max_precip_prob_change_pct FROM change WHERE forecast_date = DATE '2024-01-16' AND change_state = 'changed' ORDER BY latest_issued_at DESC, place_name LIMIT 100"),
    "partial_comparison_forecasts": ({"forecast_date": "2024-01-16"}, f"SELECT place_id, place_name, gu, forecast_date, latest_issued_at, previous_issued_at, latest_category_count, previous_category_count, change_state FROM change WHERE forecast_date = DATE '2024-01-16' AND change_state = 'partial_comparison' ORDER BY latest_issued_at DESC, place_name LIMIT 100"),
    "forecasts_without_previous_issue": ({}, f"SELECT place_id, place_name, gu, forecast_date, latest_issued_at, change_state, latest_category_count, latest_forecast_hour_count FROM change WHERE forecast_date = {_D} AND change_state = 'no_previous_issue' ORDER BY latest_issued_at DESC, place_name LIMIT 100"),
    "largest_temperature_change": ({"forecast_date": "2024-01-16"}, "SELECT place_id, place_name, gu, forecast_date, min_temp_change_c, max_temp_change_c, latest_issued_at, previous_issued_at FROM change WHERE forecast_date = DATE '2024-01-16' AND change_state = 'changed' ORDER BY greatest(abs(min_temp_change_c), abs(max_temp_change_c)) DESC, place_name LIMIT 20"),
    "largest_precip_probability_change": ({"forecast_date": "2024-01-16"}, "SELECT place_id, place_name, gu, forecast_date, latest_max_precip_prob_pct, previous_max_precip_prob_pct, max_precip_prob_change_pct, latest_first_precipitation_at, previous_first_precipitation_at FROM change WHERE forecast_date = DATE '2024-01-16' AND change_state = 'changed' ORDER BY abs(max_precip_prob_change_pct) DESC, place_name LIMIT 20"),
    "forecast_change_for_gu": ({"gu_code": "11001"}, f"SELECT {_CHANGE} FROM change WHERE gu_code = '11001' AND forecast_date = {_D} ORDER BY place_name LIMIT 100"),
    "change_state_over_date_range": ({}, f"SELECT forecast_date, change_state, count(*) AS place_count FROM change WHERE forecast_date >= {_D} AND forecast_date < {_D} + 4 GROUP BY forecast_date, change_state"),
    "forecast_change_timeline_for_place": ({"place_id": "place_2"}, f"SELECT {_CHANGE}, latest_forecast_hour_count, previous_forecast_hour_count FROM change WHERE place_id = 'place_2'"),
    "temp_change_by_area_for_date": ({"forecast_date": "2024-01-16", "dim": "gu", "metric": "max_temp"}, f"SELECT gu AS area, {_CHANGED} FROM change WHERE forecast_date = DATE '2024-01-16' GROUP BY gu ORDER BY avg_max_temp_change_c NULLS FIRST, area LIMIT 25"),
    "forecast_movers_by_metric_direction": ({"metric": "max_temp", "forecast_date": "2024-01-16"}, f"SELECT {_CHANGE}, max_temp_change_c AS metric_change FROM change WHERE forecast_date = DATE '2024-01-16' AND max_temp_change_c <> 0 ORDER BY max_temp_change_c, place_name LIMIT 20"),
    "forecasts_dropping_precipitation": ({}, "SELECT place_id, place_name, gu, forecast_date, previous_first_precipitation_at, latest_first_precipitation_at, previous_max_precip_prob_pct, latest_max_precip_prob_pct, max_precip_prob_change_pct FROM change WHERE previous_first_precipitation_at IS NOT NULL AND latest_first_precipitation_at IS NULL ORDER BY max_precip_prob_change_pct NULLS FIRST, place_name, place_id, forecast_date LIMIT 100"),
    "forecast_change_for_places": ({"place_ids": ["place_1", "place_9"]}, f"SELECT {_CHANGE}, latest_issued_at, previous_issued_at FROM change WHERE place_id IN ('place_1', 'place_9') AND forecast_date = {_D}"),
    "change_intensity_over_date_range": ({}, f"SELECT forecast_date, {_CHANGED}, min(max_precip_prob_change_pct) AS min_max_precip_prob_change_pct FROM change WHERE forecast_date >= {_D} AND forecast_date < {_D} + 4 GROUP BY forecast_date"),
    "all_current_grid_outlooks": ({}, "SELECT grid_id, nx, ny, coverage_scope, forecast_at, temp_c, precip_prob_pct, sky_label, pty_label FROM grid_current"),
    "precipitating_grids_now": ({}, "SELECT grid_id, nx, ny, forecast_at, precip_prob_pct, pty_label, pcp_raw FROM grid_current WHERE is_precipitating"),
    "high_precip_probability_grids": ({}, "SELECT grid_id, forecast_at, precip_prob_pct, pty_label FROM grid_current WHERE precip_prob_pct >= 60"),
    "warmest_grids_now": ({}, "SELECT grid_id, nx, ny, forecast_at, temp_c, humidity_pct FROM grid_current ORDER BY temp_c DESC NULLS LAST, grid_id LIMIT 20"),
    "windiest_grids_now": ({}, "SELECT grid_id, nx, ny, forecast_at, wind_ms, wind_dir_deg FROM grid_current ORDER BY wind_ms DESC NULLS LAST, grid_id LIMIT 20"),
    "sky_distribution_now": ({}, "SELECT sky_label, count(*) AS grid_count FROM grid_current GROUP BY sky_label"),
    "category_coverage_distribution": ({}, "SELECT forecast_category_count, count(*) AS grid_count FROM grid_current GROUP BY forecast_category_count"),
    "collection_scope_freshness": ({}, "SELECT coverage_scope, count(*) AS grid_count, max(forecast_collected_at_max) AS latest_collected_at FROM grid_current GROUP BY coverage_scope"),
    "all_grid_precipitation_windows": ({}, "SELECT grid_id, nx, ny, window_start_at, window_end_at, precipitation_hour_count FROM grid_windows"),
    "earliest_grid_precipitation_windows": ({}, "SELECT grid_id, window_start_at, window_end_at, precip_prob_max_pct, pcp_max_mm FROM grid_windows ORDER BY window_start_at, grid_id LIMIT 20"),
    "longest_grid_precipitation_windows": ({}, "SELECT grid_id, window_start_at, window_end_at, precipitation_hour_count FROM grid_windows ORDER BY precipitation_hour_count DESC, window_start_at, grid_id LIMIT 20"),
    "highest_grid_precip_probability": ({}, "SELECT grid_id, window_start_at, window_end_at, precip_prob_max_pct FROM grid_windows ORDER BY precip_prob_max_pct DESC NULLS LAST, grid_id, window_start_at LIMIT 20"),
    "snowfall_candidate_windows": ({}, "SELECT grid_id, window_start_at, window_end_at, sno_max_cm FROM grid_windows WHERE sno_max_cm IS NOT NULL"),
    "high_precip_amount_windows": ({}, "SELECT grid_id, window_start_at, window_end_at, pcp_max_mm FROM grid_windows ORDER BY pcp_max_mm DESC NULLS LAST, grid_id, window_start_at LIMIT 20"),
    "precipitation_windows_by_scope": ({}, "SELECT coverage_scope, count(*) AS window_count FROM grid_windows GROUP BY coverage_scope"),
    "precipitation_window_freshness": ({}, "SELECT max(forecast_collected_at_max) AS latest_collected_at FROM grid_windows"),
}
