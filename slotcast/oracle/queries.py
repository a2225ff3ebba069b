"""Oracle SQL per registered query."""

from __future__ import annotations

from .parts import (
    ERRORS,
    exact_mean,
    exact_sum,
    flags_of,
    paris,
    parts_of,
    rolling,
    utc,
    utc_first,
    with_parts,
)

NOW = "TIMESTAMP '2024-01-31 00:00:00'"

METRIC = """region, mae_mw, round(p95_error_mw, 4) AS p95_error_mw,
            round(p99_error_mw, 4) AS p99_error_mw, n_samples"""

RECENT = f"""(SELECT * FROM matched WHERE forecast_horizon_dt >= {NOW} - INTERVAL 7 DAY
              AND forecast_horizon_dt <= {NOW} - INTERVAL 2 HOUR)"""

RECENT_KEY = f"""(SELECT region, {ERRORS} FROM
    (SELECT *, abs(predicted_mw - consommation) AS e FROM {RECENT}) GROUP BY 1)"""

RECENT_ALL = f"""(SELECT 'France' AS region, {ERRORS} FROM (
    SELECT forecast_horizon_dt, abs({exact_sum('predicted_mw')} - {exact_sum('consommation')}) AS e
    FROM {RECENT} GROUP BY 1 HAVING COUNT(DISTINCT region) = 5) HAVING COUNT(*) > 0)"""

BASE = """(SELECT * FROM (SELECT *, CASE WHEN epoch_us(date_heure) <= (
      SELECT min(epoch_us(date_heure)) + CAST(floor((max(epoch_us(date_heure))
             - min(epoch_us(date_heure))) * CAST(1 - 0.2e0 AS DOUBLE)) AS BIGINT)
      FROM train WHERE consommation_lag_168h IS NOT NULL) THEN 'train' ELSE 'val' END AS split
    FROM train WHERE consommation_lag_168h IS NOT NULL) WHERE split = 'val')"""


def scores(predicted: str) -> str:
    e = f"({predicted} - consommation)"
    ms = (
        f"CAST(SUM(CAST(CAST(round({e} * 100) AS BIGINT) * CAST(round({e} * 100) AS BIGINT)"
        " AS BIGINT)) AS DOUBLE) / 10000.0e0 / COUNT(*)"
    )
    return (
        f"round({exact_mean(f'abs({e})')}, 2) AS mae, round(sqrt({ms}), 2) AS rmse, "
        f"round(1 - ({ms}) / NULLIF(var_pop(consommation), 0), 2) AS r2, COUNT(*) AS n"
    )


def status_class(age: str, fresh: int, late: int) -> str:
    return f"CASE WHEN {age} < {fresh} THEN 'ok' WHEN {age} < {late} THEN 'warn' ELSE 'dead' END"


DAY_ROWS = """SELECT date_heure AS slot, consommation AS actual, NULL::DOUBLE AS predicted,
                     NULL::DOUBLE AS yesterday, region FROM eco
   UNION ALL SELECT forecast_horizon_dt, NULL, predicted_mw, NULL, region FROM predictions
   UNION ALL SELECT date_heure + INTERVAL 24 HOUR, NULL, NULL, consommation, region FROM eco"""


def day_view(where: str) -> str:
    return f"""SELECT slot, {exact_sum('actual')} AS actual, {exact_sum('predicted')} AS predicted,
               {exact_sum('yesterday')} AS yesterday FROM ({DAY_ROWS})
        WHERE slot >= TIMESTAMP '2024-01-29' AND slot < TIMESTAMP '2024-01-30' AND {where}
        GROUP BY 1"""


HOURS = ", ".join(
    f"{exact_mean(f'CASE WHEN h = {h} THEN predicted_mw END')} AS h{h:02d}" for h in range(24)
)
HOUR_TOTAL = " + ".join(f"coalesce(h{h:02d}, 0)" for h in range(24))

# 02:00 occurs twice on the night the clock goes back; the first one counts.
FOLD_DAYS = f"""SELECT CAST(d AS DATE) AS forecast_date, {utc_first('d + INTERVAL 2 HOUR')} AS cutoff
    FROM generate_series({{first}}, {{last}}, INTERVAL 1 DAY) t(d)"""
EVENT_DAYS = {"first": "TIMESTAMP '2024-01-01'", "last": "TIMESTAMP '2024-01-30'"}
LAST_FEATURES = "SELECT max(date_trunc('day', date_heure) + INTERVAL 1 DAY + INTERVAL 110 MINUTE) FROM eco"
LAST_RUN = f"SELECT max(cutoff) FROM ({FOLD_DAYS.format(**EVENT_DAYS)})"

STATUS = f"""SELECT (SELECT max(_ingested_at) FROM raw) AS last_ingest,
                   ({LAST_FEATURES}) AS last_features,
                   ({LAST_RUN}) AS last_train,
                   (SELECT max(forecasted_at) FROM predictions) AS last_forecast,
                   (SELECT max(_computed_at) FROM metrics) AS last_eval"""

AGES = f"""SELECT name, last_at, (epoch_us({NOW}) - epoch_us(last_at)) / 1e6 AS age_s FROM (
    SELECT 'ingest' AS name, max(_ingested_at) AS last_at FROM raw
    UNION ALL SELECT 'features', ({LAST_FEATURES})
    UNION ALL SELECT 'train', ({LAST_RUN})
    UNION ALL SELECT 'forecast', max(forecasted_at) FROM predictions
    UNION ALL SELECT 'eval', max(_computed_at) FROM metrics)"""

CUT = "TIMESTAMP '2024-01-25 01:00:00'"


def folds(frame: str, first: str, last: str) -> str:
    """Each day's frame spelled out by joining days with rows, then split and scored."""
    days = FOLD_DAYS.format(first=first, last=last)
    return f"""WITH d AS ({days}),
        m AS (SELECT d.forecast_date, t.date_heure, abs(t.consommation_lag_24h - t.consommation) AS e
              FROM d JOIN {frame} t ON t.date_heure >= d.cutoff - INTERVAL 730 DAY
               AND t.date_heure + INTERVAL 24 HOUR < d.cutoff),
        s AS (SELECT forecast_date, min(date_heure) AS t_min, max(date_heure) AS t_max FROM m GROUP BY 1),
        c AS (SELECT *, CAST(floor(epoch(t_min) + floor((epoch(t_max) - epoch(t_min))
                     * CAST(1 - 0.2e0 AS DOUBLE))) AS BIGINT) AS cut FROM s)
        SELECT c.forecast_date, t_min, t_max, COUNT(*) AS n_rows,
               COUNT(*) FILTER (WHERE epoch(date_heure) <= cut) AS n_train,
               COUNT(*) FILTER (WHERE epoch(date_heure) > cut) AS n_val,
               CAST(SUM(CAST(e AS DECIMAL(18,2))) FILTER (WHERE epoch(date_heure) > cut) AS DOUBLE)
                 / NULLIF(COUNT(e) FILTER (WHERE epoch(date_heure) > cut), 0) AS val_mae,
               COUNT(*) >= 200 AS fit
        FROM c JOIN m USING (forecast_date) GROUP BY 1, 2, 3, cut"""


DUBIOUS = """(SELECT * REPLACE (CASE dayofmonth(forecast_horizon_dt) % 7
      WHEN 1 THEN 0.0e0 WHEN 2 THEN -predicted_mw WHEN 3 THEN 'nan'::DOUBLE
      WHEN 4 THEN 'inf'::DOUBLE ELSE predicted_mw END AS predicted_mw) FROM predictions)"""
KNOWN = "region IN ('click', 'error', 'purchase', 'signup')"
POSITIVE = "(isfinite(predicted_mw) AND predicted_mw > 0)"

FRAME_TAIL = f"""w.temperature_celsius, w.wind_speed_kmh, w.solar_radiation_wm2,
    {parts_of('f.forecast_horizon_dt')}, {flags_of('f.forecast_horizon_dt')}"""

SQL = {
    # sources
    "read_records": f"""SELECT ts AS date_heure, event_type AS region, value AS consommation,
        {NOW} AS _ingested_at FROM events
        WHERE value IS NOT NULL AND ts > TIMESTAMP '2024-01-02'""",
    "read_hourly_arrays": f"""SELECT hour_dt AS date_heure, region, temperature_celsius,
        wind_speed_kmh, solar_radiation_wm2, {NOW} AS _ingested_at FROM weather_h
        WHERE hour_dt > TIMESTAMP '2024-01-02'""",
    "region_dim": """SELECT region, CAST(row_number() OVER (ORDER BY region) - 1 AS INTEGER)
        AS region_idx FROM keys""",
    "plan_periods_month": """SELECT CAST(m AS DATE) AS period_start,
        CAST(m + INTERVAL 1 MONTH AS DATE) AS period_end
        FROM (SELECT unnest(generate_series(date_trunc('month', min(o_orderdate)),
              max(o_orderdate), INTERVAL 1 MONTH)) AS m FROM orders)""",
    "plan_periods_year": """WITH b AS (SELECT CAST(min(o_orderdate) AS DATE) AS lo,
            CAST(max(o_orderdate) AS DATE) AS hi FROM orders),
        y AS (SELECT unnest(generate_series(year(lo), year(hi))) AS y FROM b)
        SELECT greatest(make_date(y, 1, 1), lo) AS period_start,
               least(make_date(y, 12, 31), hi) AS period_end FROM y, b""",
    "read_backfill": """SELECT * FROM raw WHERE date_heure >= TIMESTAMP '2024-01-01 06:00:00'
        AND date_heure < TIMESTAMP '2024-01-30 12:00:00' AND consommation IS NOT NULL""",
    "prefer_source": """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
            PARTITION BY date_heure, region
            ORDER BY event_id % 2, _ingested_at DESC, event_id DESC) AS rn FROM raw) WHERE rn = 1""",
    "exogenous_source": """SELECT CAST(date_heure AS DATE) AS day,
        CASE WHEN DATE '2024-01-31' - CAST(date_heure AS DATE) >= 5 THEN 'archive'
             ELSE 'forecast' END AS feed, COUNT(*) AS n FROM eco GROUP BY 1, 2""",
    "high_water_mark": "SELECT max(date_heure) AS hwm FROM raw",
    "since_with_overlap": f"""SELECT max(date_heure) - INTERVAL 6 HOUR AS since, 'filled' AS case_
        FROM raw GROUP BY region UNION ALL SELECT {NOW} - INTERVAL 7 DAY, 'empty'""".replace(
        "case_", '"case"'
    ),
    "refresh_window": f"""SELECT * FROM raw WHERE date_heure > {NOW} - INTERVAL 168 HOUR
        AND date_heure <= {NOW}""",
    # cleaning
    "dedupe_latest": "SELECT * FROM eco",
    "dedupe_latest_non_null": """SELECT date_heure, region, consommation, _ingested_at, event_id
        FROM (SELECT *, row_number() OVER (PARTITION BY date_heure, region
              ORDER BY _ingested_at DESC, event_id DESC) AS rn FROM raw WHERE event_id % 3 <> 0)
        WHERE rn = 1""",
    "time_range": """SELECT * FROM raw WHERE date_heure >= TIMESTAMP '2024-01-03'
        AND date_heure < TIMESTAMP '2024-01-28'""",
    "complete_slots": """SELECT date_heure, region, consommation FROM eco WHERE date_heure IN (
        SELECT date_heure FROM eco GROUP BY 1 HAVING COUNT(DISTINCT region) = 5)""",
    "null_gate": """SELECT * EXCLUDE (consommation_rolling_168h) FROM lags
        WHERE consommation_lag_24h IS NOT NULL AND consommation_lag_168h IS NOT NULL""",
    # features
    "pit_lag": "SELECT * EXCLUDE (consommation_rolling_168h) FROM lags",
    "pit_lag_join": "SELECT * EXCLUDE (consommation_rolling_168h) FROM lags",
    "pit_lag_many_keys": f"""SELECT e.date_heure, e.region AS user_id, e.consommation,
        a.consommation AS consommation_lag_24h, b.consommation AS consommation_lag_48h,
        c.consommation AS consommation_lag_168h, e.r AS consommation_rolling_168h
        FROM (SELECT *, {rolling('1 HOUR')} AS r FROM users) e
        LEFT JOIN users a ON a.region = e.region AND a.date_heure = e.date_heure - INTERVAL 24 HOUR
        LEFT JOIN users b ON b.region = e.region AND b.date_heure = e.date_heure - INTERVAL 48 HOUR
        LEFT JOIN users c ON c.region = e.region AND c.date_heure = e.date_heure - INTERVAL 168 HOUR""",
    "rolling_mean": "SELECT date_heure, region, consommation, consommation_rolling_168h FROM lags",
    "hourly_mean": "SELECT * FROM weather_h",
    "join_hourly": """SELECT e.date_heure, e.region, e.consommation, w.temperature_celsius,
        w.wind_speed_kmh, w.solar_radiation_wm2 FROM eco e LEFT JOIN weather_h w
        ON w.region = e.region AND w.hour_dt = date_trunc('hour', e.date_heure)""",
    "calendar_parts": f"""SELECT date_heure, region, consommation, {parts_of('date_heure')}
        FROM eco""",
    "is_weekend": f"""SELECT date_heure, region, isodow({paris('date_heure')}) >= 6 AS is_weekend
        FROM daily""",
    "holiday_flag": f"""SELECT date_heure, region, CAST({paris('date_heure')} AS DATE) IN
        (SELECT d FROM holiday) AS is_public_holiday_fr FROM daily""",
    "build_features": "SELECT * FROM features",
    "build_features_since": """SELECT * FROM features
        WHERE date_heure > TIMESTAMP '2024-01-12 03:00:00'""",
    "daily_history_features": "SELECT * FROM dlags",
    # forecast frame
    "horizon_slots": f"""SELECT CAST(d AS DATE) AS forecast_date,
        {utc('d + INTERVAL 6 HOUR')} AS anchor,
        {utc('d + INTERVAL 6 HOUR')} + i * INTERVAL 15 MINUTE AS forecast_horizon_dt
        FROM (SELECT DISTINCT CAST(o_orderdate AS TIMESTAMP) AS d FROM orders),
             generate_series(0, 95) s(i)""",
    "scaffold": "SELECT * FROM slots CROSS JOIN keys",
    "aligned_lags": "SELECT * FROM frame0",
    "lag_fallback": """SELECT CAST(d AS DATE) AS forecast_date, d AS forecast_horizon_dt, k.region,
        coalesce(a.consommation, b.consommation) AS consommation_lag_24h,
        b.consommation AS consommation_lag_48h, c.consommation AS consommation_lag_168h,
        a.consommation IS NULL AND b.consommation IS NOT NULL AS used_fallback
        FROM generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2001-08-01', INTERVAL 1 DAY) t(d)
        CROSS JOIN (SELECT DISTINCT o_orderpriority AS region FROM orders) k
        LEFT JOIN daily a ON a.region = k.region AND a.date_heure = d - INTERVAL 2 DAY
        LEFT JOIN daily b ON b.region = k.region AND b.date_heure = d - INTERVAL 3 DAY
        LEFT JOIN daily c ON c.region = k.region AND c.date_heure = d - INTERVAL 8 DAY""",
    "lag_fallback_count": """SELECT COUNT(*) AS n_rows, COUNT(*) FILTER (
            WHERE a.consommation IS NULL AND b.consommation IS NOT NULL) AS n_fallback
        FROM generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2001-08-01', INTERVAL 1 DAY) t(d)
        CROSS JOIN (SELECT DISTINCT o_orderpriority AS region FROM orders) k
        LEFT JOIN daily a ON a.region = k.region AND a.date_heure = d - INTERVAL 2 DAY
        LEFT JOIN daily b ON b.region = k.region AND b.date_heure = d - INTERVAL 3 DAY""",
    "aligned_rolling": "SELECT * FROM roll0",
    "forecast_frame": f"""SELECT f.forecast_date, f.anchor, f.forecast_horizon_dt, f.region,
        coalesce(f.consommation_lag_24h, f.consommation_lag_48h) AS consommation_lag_24h,
        f.consommation_lag_48h, f.consommation_lag_168h, r.consommation_rolling_168h,
        f.consommation_lag_24h IS NULL AND f.consommation_lag_48h IS NOT NULL AS used_fallback,
        {FRAME_TAIL}
        FROM frame0 f JOIN roll0 r ON r.forecast_horizon_dt = f.forecast_horizon_dt
             AND r.region = f.region AND r.forecast_date = f.forecast_date
        LEFT JOIN weather_h w ON w.region = f.region AND w.hour_dt = f.forecast_horizon_dt""",
    "forecast_frame_as_known": f"""SELECT f.forecast_date, f.anchor, f.forecast_horizon_dt,
        f.region, coalesce(f.l24, f.l48) AS consommation_lag_24h, f.l48 AS consommation_lag_48h,
        f.l168 AS consommation_lag_168h, r.consommation_rolling_168h,
        f.l24 IS NULL AND f.l48 IS NOT NULL AS used_fallback, {FRAME_TAIL}
        FROM known_frame f JOIN known_roll r ON r.forecast_horizon_dt = f.forecast_horizon_dt
             AND r.region = f.region AND r.forecast_date = f.forecast_date
        LEFT JOIN weather_h w ON w.region = f.region AND w.hour_dt = f.forecast_horizon_dt""",
    "naive_forecast": "SELECT * FROM predictions",
    # training
    "training_frame": "SELECT * FROM train",
    "training_frame_reference": "SELECT * FROM train_ref",
    "training_frame_asof": f"""SELECT * FROM train_ref
        WHERE date_heure < {CUT} AND date_heure + INTERVAL 24 HOUR < {CUT}""",
    "time_split": "SELECT date_heure, region, consommation, split FROM split",
    "encode": """SELECT f.date_heure, f.region, d.i AS region_idx,
        CAST(f.is_weekend AS INTEGER) AS is_weekend,
        CAST(f.is_public_holiday_fr AS INTEGER) AS is_public_holiday_fr
        FROM features f LEFT JOIN (SELECT region, CAST(row_number() OVER (ORDER BY region) - 1
             AS INTEGER) AS i FROM keys) d ON d.region = f.region AND d.region <> 'view'""",
    "min_rows_gate": """SELECT region, COUNT(*) AS n_rows, COUNT(*) >= 200 AS fit
        FROM train GROUP BY 1""",
    "eval_metrics": f"SELECT region, {scores('consommation_lag_24h')} FROM {BASE} GROUP BY 1",
    "compare_models": f"""SELECT *, mae = min(mae) OVER () AS best_mae,
        rmse = min(rmse) OVER () AS best_rmse, r2 = max(r2) OVER () AS best_r2 FROM (
        SELECT 'lag_24h' AS model, {scores('consommation_lag_24h')} FROM {BASE}
        UNION ALL SELECT 'lag_168h', {scores('consommation_lag_168h')} FROM {BASE})""",
    "mae_by_key": f"""SELECT region, {exact_mean('abs(consommation_lag_24h - consommation)')} AS mae
        FROM {BASE} GROUP BY 1""",
    "prediction_error_sample": f"""SELECT date_heure, region, consommation AS actual,
        consommation_lag_24h AS predicted, consommation - consommation_lag_24h AS residual FROM {BASE}
        ORDER BY md5(strftime(date_heure, '%Y-%m-%d %H:%M:%S') || '|' || region || '|42'), 1, 2 LIMIT 5000""",
    "latest_run": """SELECT o_orderkey, o_orderdate FROM orders
        ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1""",
    "stale_versions": """SELECT o_custkey, run_time FROM (SELECT *, row_number() OVER (
            ORDER BY run_time DESC, o_custkey DESC) AS rn FROM (
            SELECT o_custkey, min(o_orderdate) AS run_time FROM orders GROUP BY 1)) WHERE rn > 7""",
    "walk_forward_folds": folds(
        "dtrain", "TIMESTAMP '1995-01-01'", "TIMESTAMP '2001-08-02'"
    ),
    "walk_forward": f"""SELECT p.* FROM predictions p WHERE p.forecast_date IN (
        SELECT forecast_date FROM ({folds('train_ref', "TIMESTAMP '2024-01-01'",
                                          "TIMESTAMP '2024-01-30'")}) WHERE fit)""",
    "walk_forward_ledger": f"""SELECT forecast_date, n_train, n_val, 13 AS n_features, 0.2e0 AS val_fraction
        FROM ({folds('train_ref', EVENT_DAYS['first'], EVENT_DAYS['last'])}) WHERE fit""",
    "run_log_split": """SELECT COUNT(*) FILTER (WHERE split = 'train') AS n_train,
        COUNT(*) FILTER (WHERE split = 'val') AS n_val, 13 AS n_features, 0.2e0 AS val_fraction FROM split""",
    "full_rebuild_counts": """SELECT 'consumption' AS name, COUNT(*) AS n_rows FROM eco
        UNION ALL SELECT 'weather', COUNT(*) FROM (SELECT DISTINCT date_heure, region FROM weather)
        UNION ALL SELECT 'features', COUNT(*) FROM features WHERE date_heure > TIMESTAMP '2023-12-31'
        UNION ALL SELECT 'predictions', 24 * COUNT(*) FROM keys
        UNION ALL SELECT 'journal', 6""",
    # quality
    "match_actuals": f"SELECT * FROM {RECENT}",
    "key_metrics": f"SELECT {METRIC} FROM {RECENT_KEY}",
    "national_metrics": f"SELECT {METRIC} FROM {RECENT_ALL}",
    "metrics_snapshot": f"""SELECT DATE '2024-01-31' AS computed_date, {METRIC},
        {NOW} AS _computed_at FROM (SELECT * FROM {RECENT_KEY} UNION ALL SELECT * FROM {RECENT_ALL})""",
    "metrics_backfill": f"SELECT computed_date, {METRIC}, _computed_at FROM metrics",
    "mae_alert": f"""SELECT computed_date, {METRIC}, _computed_at FROM metrics
        WHERE region = 'France' AND mae_mw > 60.0""",
    # monitoring
    "recent_forecasts": f"""SELECT forecast_horizon_dt, region, predicted_mw, model_version,
        forecasted_at FROM predictions WHERE forecast_horizon_dt >= {NOW} - INTERVAL 48 HOUR
        AND forecast_horizon_dt <= {NOW} + INTERVAL 24 HOUR""",
    "recent_actuals": f"""SELECT date_heure, region, consommation FROM eco
        WHERE date_heure >= {NOW} - INTERVAL 48 HOUR AND date_heure IN (
        SELECT date_heure FROM eco GROUP BY 1 HAVING COUNT(DISTINCT region) = 5)""",
    "system_status": STATUS,
    "freshness": f"""SELECT name, last_at, age_s, CASE name
        WHEN 'ingest' THEN {status_class('age_s', 1200, 3600)}
        WHEN 'eval' THEN {status_class('age_s', 1200, 3600)}
        ELSE {status_class('age_s', 93600, 108000)} END AS class,
        CASE WHEN floor(age_s / 60) < 1 THEN 'just now'
             WHEN floor(age_s / 60) < 60 THEN CAST(floor(age_s / 60) AS INTEGER) || ' min ago'
             WHEN floor(age_s / 60) < 1440 THEN CAST(floor(age_s / 3600) AS INTEGER) || ' h '
                  || (CAST(floor(age_s / 60) AS INTEGER) % 60) || ' min ago'
             ELSE CAST(floor(age_s / 86400) AS INTEGER) || ' d ago' END AS age FROM ({AGES})""",
    "latest_metrics": f"""SELECT {METRIC}, computed_date FROM metrics
        WHERE computed_date = (SELECT max(computed_date) FROM metrics)""",
    "metrics_history": """SELECT region, computed_date, mae_mw, region = 'France' AS is_national
        FROM metrics WHERE computed_date >= DATE '2024-01-31' - INTERVAL 30 DAY""",
    "completeness": f"""SELECT COUNT(*) AS n_slots, round(COUNT(*) * 100.0e0 / 120, 1) AS pct
        FROM (SELECT DISTINCT date_heure, region FROM raw
              WHERE date_heure >= {NOW} - INTERVAL 24 HOUR AND consommation IS NOT NULL)""",
    "next_slot_total": f"""SELECT forecast_horizon_dt AS slot, {exact_sum('predicted_mw')} AS total_mw
        FROM predictions WHERE forecast_horizon_dt = (SELECT min(forecast_horizon_dt)
        FROM predictions WHERE forecast_horizon_dt > TIMESTAMP '2024-01-20 07:30:00') GROUP BY 1""",
    "latest_batch": """SELECT max(forecasted_at) AS forecasted_at,
        substring(max_by(model_version, forecasted_at), 1, 8) AS model FROM predictions""",
    "latest_batch_daily": """SELECT forecasted_at, substring(v, 1, 8) AS model FROM (
        SELECT o_orderdate AS forecasted_at, 'run-' || o_orderkey AS v FROM orders)
        ORDER BY forecasted_at DESC, v DESC LIMIT 1""",
    "mean_by_key": f"""SELECT region, avg_mw, min(avg_mw) OVER () * 0.85e0 AS scale_min,
        max(avg_mw) OVER () * 1.05e0 AS scale_max FROM (
        SELECT region, {exact_mean('predicted_mw')} AS avg_mw FROM predictions GROUP BY 1)""",
    "day_view": day_view("true"),
    "day_view_key": day_view("region = 'click'"),
    "mae_ranking": """SELECT region, mae_mw FROM metrics WHERE region <> 'France'
        AND mae_mw IS NOT NULL AND computed_date = (SELECT max(computed_date) FROM metrics)""",
    "hour_heatmap": f"""SELECT *, round({HOUR_TOTAL}, 4) AS row_total FROM (
        SELECT region, {HOURS} FROM (SELECT *, hour({paris('forecast_horizon_dt')}) AS h
        FROM predictions) GROUP BY 1)""",
    "kpi_strip": f"""SELECT max(m.mae_mw) AS mae_mw, round(max(m.p95_error_mw), 4) AS p95_error_mw,
        coalesce(max(m.n_samples), 0) AS n_samples,
        (SELECT round(COUNT(*) * 100.0e0 / 120, 1) FROM (SELECT DISTINCT date_heure, region FROM raw
           WHERE date_heure >= TIMESTAMP '2024-01-29 12:00:00')) AS completeness_pct,
        (SELECT {exact_sum('predicted_mw')} FROM predictions WHERE forecast_horizon_dt = (
           SELECT min(forecast_horizon_dt) FROM predictions
           WHERE forecast_horizon_dt > TIMESTAMP '2024-01-30 12:00:00')) AS next_total_mw
        FROM metrics m WHERE m.region = 'France'
        AND m.computed_date = (SELECT max(computed_date) FROM metrics)""",
    "prediction_audit": """SELECT CAST(forecast_horizon_dt AS DATE) AS day,
        CAST(forecasted_at AS DATE) AS made_on, COUNT(*) AS n FROM predictions
        WHERE forecast_horizon_dt >= TIMESTAMP '2024-01-01' GROUP BY 1, 2""",
    "smoke_checks": f"""WITH c AS (SELECT 'raw_fresh' AS "check", COUNT(*) AS n FROM raw
          WHERE date_heure > {NOW} - INTERVAL 2 HOUR
        UNION ALL SELECT 'predictions_recent', COUNT(*) FROM predictions
          WHERE forecast_date >= DATE '2024-01-30')
        SELECT "check", n, n > 0 AS ok, (SELECT COUNT(*) FROM c WHERE n = 0) AS failures FROM c""",
    # validation
    "validate_records": """SELECT event_type AS region, CASE WHEN event_id % 701 = 0
        THEN 'time_has_zone' ELSE 'good' END AS reason, COUNT(*) AS n FROM events GROUP BY 1, 2""",
    "validate_pages": """SELECT event_id // 100 AS page, CASE WHEN min(event_id % 701) = 0
        THEN 'time_has_zone' ELSE 'good' END AS reason FROM events GROUP BY 1""",
    "validate_hourly": """SELECT DISTINCT region, CAST(hour_dt AS DATE) AS day,
        CASE WHEN dayofmonth(hour_dt) % 5 = 0 THEN 'temperature_2m_length' ELSE 'good' END AS reason
        FROM weather_h""",
    "validate_predictions": f"""SELECT forecast_horizon_dt, region, CASE
        WHEN NOT {KNOWN} AND NOT {POSITIVE} THEN 'known_region,positive_and_finite'
        WHEN NOT {KNOWN} THEN 'known_region' WHEN NOT {POSITIVE} THEN 'positive_and_finite'
        ELSE 'good' END AS reason FROM {DUBIOUS}""",
    "validate_metrics": f"""SELECT computed_date, {METRIC}, _computed_at FROM metrics
        WHERE n_samples % 2 = 0""",
    "violations": f"""SELECT COUNT(*) FILTER (WHERE NOT {KNOWN}) AS known_region,
        COUNT(*) FILTER (WHERE NOT {POSITIVE}) AS positive_and_finite FROM {DUBIOUS}""",
    # tables
    "upsert_rows": """SELECT date_heure, region, CASE WHEN dayofmonth(date_heure) >= 15
        THEN consommation + 1 ELSE consommation END AS consommation, _ingested_at, event_id
        FROM eco""",
    "expire": """SELECT date_heure, region, consommation FROM daily
        WHERE date_heure > TIMESTAMP '2001-08-02' - INTERVAL 730 DAY""",
    "append_table": "SELECT date_heure, region, consommation, _ingested_at FROM raw",
    "upsert_table": """SELECT date_heure, region, CASE WHEN dayofmonth(date_heure) >= 15
        THEN consommation + 1 ELSE consommation END AS consommation, _ingested_at FROM eco""",
    "table_layout": """SELECT CAST(date_heure AS DATE) AS day, COUNT(*) AS n_rows,
        COUNT(DISTINCT region) AS n_regions FROM raw GROUP BY 1""",
    "drop_expired": f"""SELECT date_heure, region, consommation, _ingested_at FROM raw
        WHERE CAST(date_heure AS DATE) > CAST({NOW} AS DATE) - 10""",
    "truncate_tables": "SELECT CAST(0 AS BIGINT) AS n_after, COUNT(*) AS n_before FROM raw",
    "materialize_incremental": "SELECT * FROM features",
    "materialize_incremental_late": "SELECT * FROM features",
    # Landed times keep their minutes, and equal stamps are settled by the greater value.
    "run_ingest": """WITH low AS (SELECT max(ts) - INTERVAL 6 HOUR AS t FROM events
              WHERE (event_id // 100) % 2 = 0),
        hours AS (SELECT max(hour_dt) - INTERVAL 6 HOUR AS t FROM weather_h WHERE hour_dt < TIMESTAMP '2024-01-11')
        SELECT ts AS date_heure, event_type AS region, max(value) AS consommation,
               'consumption' AS table_name FROM events
        WHERE value IS NOT NULL AND ts > TIMESTAMP '2023-12-18'
          AND ((event_id // 100) % 2 = 0 OR ts > (SELECT t FROM low)) GROUP BY 1, 2
        UNION ALL SELECT hour_dt, region, wind_speed_kmh,
               'weather since ' || strftime((SELECT t FROM hours), '%Y-%m-%dT%H:%M:%S')
        FROM weather_h""",
    "run_reingest": f"""SELECT e.date_heure, e.region, CASE WHEN e.date_heure > {NOW} - INTERVAL 168 HOUR
            AND e.date_heure <= {NOW} THEN l.v + 1 ELSE e.consommation END AS consommation
        FROM eco e JOIN (SELECT date_heure, region, arg_max(consommation, (_ingested_at, consommation)) AS v
                         FROM raw GROUP BY 1, 2) l
          ON l.date_heure = e.date_heure AND l.region = e.region""",
    "run_backfill": """SELECT date_heure, region, consommation, _ingested_at FROM (
        SELECT *, row_number() OVER (PARTITION BY date_heure, region
               ORDER BY _ingested_at DESC, consommation DESC) AS rn FROM raw
        WHERE date_heure >= TIMESTAMP '2024-01-05' AND date_heure < TIMESTAMP '2024-01-25'
          AND consommation IS NOT NULL) WHERE rn = 1""",
    "quarantined_pages": """SELECT CASE WHEN page % 11 = 3 THEN 'results_present'
            WHEN page % 11 = 5 THEN 'well_formed' WHEN broken THEN 'time_has_zone'
            ELSE 'good' END AS reason, COUNT(*) AS n
        FROM (SELECT event_id // 100 AS page, min(event_id % 701) = 0 AS broken FROM events GROUP BY 1)
        GROUP BY 1""",
    "write_predictions": """SELECT f.forecast_horizon_dt, f.region,
        coalesce(f.consommation_lag_24h, f.consommation_lag_48h, r.consommation_rolling_168h) + 1
          AS predicted_mw, 'naive24' AS model_version, f.forecast_date,
        TIMESTAMP '2024-01-29 05:00:00' AS forecasted_at
        FROM frame0 f JOIN roll0 r ON r.forecast_horizon_dt = f.forecast_horizon_dt
             AND r.region = f.region AND r.forecast_date = f.forecast_date
        WHERE f.forecast_date = DATE '2024-01-29'""",
    "run_metrics": f"""SELECT DATE '2024-01-31' AS computed_date, {METRIC}, {NOW} AS _computed_at
        FROM (SELECT * FROM {RECENT_KEY} UNION ALL SELECT * FROM {RECENT_ALL})""",
    # streaming, where the end of the input decides
    "stream_upsert": "SELECT date_heure, region, consommation, _ingested_at FROM eco",
    "stream_hourly": """SELECT * FROM weather_h WHERE hour_dt + INTERVAL 1 HOUR <= (
        SELECT max(date_heure) - INTERVAL 6 HOUR FROM weather)""",
    "stream_dedupe": "SELECT * FROM raw",
    "stream_metrics": f"""SELECT DATE '2024-01-31' AS computed_date, {METRIC}, {NOW} AS _computed_at
        FROM (SELECT * FROM {RECENT_KEY} UNION ALL SELECT * FROM {RECENT_ALL})""",
    "expired_days": """SELECT CAST(date_heure AS DATE) AS day, COUNT(*) AS n_rows FROM daily
        WHERE date_heure <= TIMESTAMP '2001-08-02' - INTERVAL 730 DAY GROUP BY 1""",
}


def oracle_sql() -> dict[str, str]:
    return {name: with_parts(text) for name, text in SQL.items()}
