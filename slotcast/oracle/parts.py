"""Common table expressions the oracle queries share."""

from __future__ import annotations

import re

AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"


def exact_sum(x: str) -> str:
    return f"CAST(SUM(CAST({x} AS DECIMAL(18,2))) AS DOUBLE)"


def exact_mean(x: str) -> str:
    return f"{exact_sum(x)} / NULLIF(COUNT({x}), 0)"


def paris(t: str, zone: str = "Europe/Paris") -> str:
    return f"(({t}) AT TIME ZONE 'UTC') AT TIME ZONE '{zone}'"


def utc(wall: str, zone: str = "Europe/Paris") -> str:
    return f"(({wall}) AT TIME ZONE '{zone}') AT TIME ZONE 'UTC'"


def utc_first(wall: str, zone: str = "Europe/Paris") -> str:
    """The earlier instant where a wall-clock time occurs twice."""
    early = f"({utc(f'({wall}) - INTERVAL 1 HOUR', zone)} + INTERVAL 1 HOUR)"
    return f"CASE WHEN {paris(early, zone)} = ({wall}) THEN {early} ELSE {utc(wall, zone)} END"


def parts_of(t: str) -> str:
    p = paris(t)
    return (
        f"CAST(hour({p}) AS INTEGER) AS hour_of_day, "
        f"CAST(isodow({p}) - 1 AS INTEGER) AS day_of_week, "
        f"CAST(month({p}) AS INTEGER) AS month"
    )


def flags_of(t: str) -> str:
    p = paris(t)
    return (
        f"isodow({p}) >= 6 AS is_weekend, "
        f"CAST({p} AS DATE) IN (SELECT d FROM holiday) AS is_public_holiday_fr"
    )


def rolling(step: str) -> str:
    frame = (
        "OVER (PARTITION BY region ORDER BY date_heure RANGE BETWEEN "
        f"INTERVAL 168 HOUR PRECEDING AND INTERVAL {step} PRECEDING)"
    )
    return (
        f"CAST(SUM(CAST(consommation AS DECIMAL(18,2))) {frame} AS DOUBLE)"
        f" / NULLIF(COUNT(consommation) {frame}, 0)"
    )


def lagged(table: str, step: str, extra: str = "") -> str:
    """Lags by self-join and the rolling mean by one frame."""
    joins = " ".join(
        f"LEFT JOIN {table} l{h} ON l{h}.region = e.region "
        f"AND l{h}.date_heure = e.date_heure - INTERVAL {h} HOUR"
        for h in (24, 48, 168)
    )
    lags = ", ".join(f"l{h}.consommation AS consommation_lag_{h}h" for h in (24, 48, 168))
    return (
        f"SELECT e.date_heure, e.region, e.consommation, {lags}, e.r AS consommation_rolling_168h"
        f"{extra} FROM (SELECT *, {rolling(step)} AS r FROM {table}) e {joins}"
    )


ERRORS = (
    f"{exact_mean('e')} AS mae_mw, quantile_cont(e, 0.95) AS p95_error_mw, "
    "quantile_cont(e, 0.99) AS p99_error_mw, COUNT(*) AS n_samples"
)

# Cycle-free: each text may use the names above it.
CTES = {
    "raw": """
        SELECT date_trunc('hour', ts) AS date_heure, event_type AS region,
               value AS consommation, ts AS _ingested_at, event_id FROM events""",
    "eco": """
        SELECT date_heure, region, consommation, _ingested_at, event_id FROM (
          SELECT *, row_number() OVER (PARTITION BY date_heure, region
                 ORDER BY _ingested_at DESC, event_id DESC) AS rn FROM raw) WHERE rn = 1""",
    "users": """
        SELECT date_heure, region, consommation FROM (
          SELECT date_trunc('hour', ts) AS date_heure, user_id AS region, value AS consommation,
                 row_number() OVER (PARTITION BY date_trunc('hour', ts), user_id
                 ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""",
    "weather": """
        SELECT date_trunc('hour', ts) AS date_heure, event_type AS region,
               CAST(json_extract_string(props, '$.k') AS DOUBLE) AS temperature_celsius,
               CAST(user_id % 37 AS DOUBLE) AS wind_speed_kmh,
               CAST(event_id % 997 AS DOUBLE) AS solar_radiation_wm2,
               ts AS _ingested_at FROM events""",
    "weather_h": """
        SELECT date_heure AS hour_dt, region, avg(temperature_celsius) AS temperature_celsius,
               avg(wind_speed_kmh) AS wind_speed_kmh,
               avg(solar_radiation_wm2) AS solar_radiation_wm2
        FROM weather GROUP BY 1, 2""",
    "keys": "SELECT DISTINCT event_type AS region FROM events",
    "daily": f"""
        SELECT o_orderdate AS date_heure, o_orderpriority AS region,
               {exact_sum('o_totalprice')} AS consommation FROM orders GROUP BY 1, 2""",
    "holiday": """
        WITH y AS (SELECT unnest(generate_series(1990, 2060)) AS y),
        g AS (SELECT y, (19 * (y % 19) + 24) % 30 AS d FROM y),
        h AS (SELECT y, d, (2 * (y % 4) + 4 * (y % 7) + 6 * d + 5) % 7 AS e FROM g),
        easter AS (
          SELECT y, CAST(make_date(y, 3, 22) + CAST(d + e
             - CASE WHEN d = 29 AND e = 6 THEN 7
                    WHEN d = 28 AND e = 6 AND y % 19 > 10 THEN 7 ELSE 0 END AS INTEGER) AS DATE) AS s
          FROM h)
        SELECT CAST(s + unnest([1, 39, 50]) AS DATE) AS d FROM easter
        UNION SELECT make_date(y, 1, 1) FROM y UNION SELECT make_date(y, 5, 1) FROM y
        UNION SELECT make_date(y, 5, 8) FROM y UNION SELECT make_date(y, 7, 14) FROM y
        UNION SELECT make_date(y, 8, 15) FROM y UNION SELECT make_date(y, 11, 1) FROM y
        UNION SELECT make_date(y, 11, 11) FROM y UNION SELECT make_date(y, 12, 25) FROM y""",
    "lags": lagged("eco", "1 HOUR"),
    "dlags": lagged("daily", "24 HOUR"),
    "features": f"""
        SELECT l.* EXCLUDE (consommation), w.temperature_celsius, w.wind_speed_kmh,
               w.solar_radiation_wm2, {parts_of('l.date_heure')}, {flags_of('l.date_heure')}
        FROM lags l LEFT JOIN weather_h w
          ON w.region = l.region AND w.hour_dt = date_trunc('hour', l.date_heure)""",
    "slots": f"""
        SELECT CAST(d AS DATE) AS forecast_date, {utc("d + INTERVAL 6 HOUR")} AS anchor,
               {utc("d + INTERVAL 6 HOUR")} + i * INTERVAL 1 HOUR AS forecast_horizon_dt
        FROM generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-30', INTERVAL 1 DAY) t(d),
             generate_series(0, 23) s(i)""",
    "frame0": """
        SELECT s.*, k.region, a.consommation AS consommation_lag_24h,
               b.consommation AS consommation_lag_48h, c.consommation AS consommation_lag_168h
        FROM slots s CROSS JOIN keys k
        LEFT JOIN eco a ON a.region = k.region
             AND a.date_heure = s.forecast_horizon_dt - INTERVAL 48 HOUR
        LEFT JOIN eco b ON b.region = k.region
             AND b.date_heure = s.forecast_horizon_dt - INTERVAL 72 HOUR
        LEFT JOIN eco c ON c.region = k.region
             AND c.date_heure = s.forecast_horizon_dt - INTERVAL 192 HOUR""",
    "roll0": f"""
        SELECT s.forecast_date, s.forecast_horizon_dt, k.region,
               {exact_mean('e.consommation')} AS consommation_rolling_168h
        FROM slots s CROSS JOIN keys k LEFT JOIN eco e ON e.region = k.region
             AND e.date_heure >= s.forecast_horizon_dt - INTERVAL 192 HOUR
             AND e.date_heure <= s.forecast_horizon_dt - INTERVAL 25 HOUR
        GROUP BY 1, 2, 3""",
    "known": """
        SELECT * EXCLUDE (rn) FROM (
          SELECT a.forecast_date, r.date_heure, r.region, r.consommation, row_number() OVER (
                 PARTITION BY a.forecast_date, r.date_heure, r.region
                 ORDER BY r._ingested_at DESC, r.event_id DESC) AS rn
          FROM (SELECT DISTINCT forecast_date, anchor FROM slots) a JOIN raw r
            ON r.date_heure >= a.anchor - INTERVAL 216 HOUR AND r.date_heure < a.anchor
           AND r._ingested_at + INTERVAL 30 HOUR <= a.anchor) WHERE rn = 1""",
    "known_frame": """
        SELECT s.*, k.region, a.consommation AS l24, b.consommation AS l48,
               c.consommation AS l168
        FROM slots s CROSS JOIN keys k
        LEFT JOIN known a ON a.region = k.region AND a.forecast_date = s.forecast_date
             AND a.date_heure = s.forecast_horizon_dt - INTERVAL 48 HOUR
        LEFT JOIN known b ON b.region = k.region AND b.forecast_date = s.forecast_date
             AND b.date_heure = s.forecast_horizon_dt - INTERVAL 72 HOUR
        LEFT JOIN known c ON c.region = k.region AND c.forecast_date = s.forecast_date
             AND c.date_heure = s.forecast_horizon_dt - INTERVAL 192 HOUR""",
    "known_roll": f"""
        SELECT s.forecast_horizon_dt, s.forecast_date, k.region,
               {exact_mean('e.consommation')} AS consommation_rolling_168h
        FROM slots s CROSS JOIN keys k LEFT JOIN known e ON e.region = k.region
             AND e.forecast_date = s.forecast_date
             AND e.date_heure >= s.forecast_horizon_dt - INTERVAL 192 HOUR
             AND e.date_heure <= s.forecast_horizon_dt - INTERVAL 25 HOUR
        GROUP BY 1, 2, 3""",
    "predictions": """
        SELECT forecast_horizon_dt, region,
               COALESCE(consommation_lag_24h, consommation_lag_48h) AS predicted_mw,
               'naive24' AS model_version, forecast_date, anchor AS forecasted_at
        FROM frame0 WHERE COALESCE(consommation_lag_24h, consommation_lag_48h) IS NOT NULL""",
    "matched": """
        SELECT p.forecast_horizon_dt, p.region, p.predicted_mw, e.consommation
        FROM predictions p JOIN eco e
          ON e.region = p.region AND e.date_heure = p.forecast_horizon_dt""",
    "eval_days": """
        SELECT d AS a FROM generate_series(TIMESTAMP '2024-01-02', TIMESTAMP '2024-01-31',
               INTERVAL 1 DAY) t(d)""",
    "evaluated": """
        SELECT a, m.* FROM eval_days JOIN matched m
          ON m.forecast_horizon_dt >= a - INTERVAL 7 DAY
         AND m.forecast_horizon_dt <= a - INTERVAL 2 HOUR""",
    "per_key": f"""
        SELECT a, region, {ERRORS} FROM (
          SELECT *, abs(predicted_mw - consommation) AS e FROM evaluated) GROUP BY 1, 2""",
    "national": f"""
        SELECT a, 'France' AS region, {ERRORS} FROM (
          SELECT a, forecast_horizon_dt,
                 abs({exact_sum('predicted_mw')} - {exact_sum('consommation')}) AS e
          FROM evaluated GROUP BY 1, 2 HAVING COUNT(DISTINCT region) = 5) GROUP BY 1""",
    "metrics": """
        SELECT CAST(a AS DATE) AS computed_date, region, mae_mw, p95_error_mw, p99_error_mw,
               n_samples, a AS _computed_at
        FROM (SELECT * FROM per_key UNION ALL SELECT * FROM national)""",
    "train": f"""
        SELECT f.* EXCLUDE (temperature_celsius, wind_speed_kmh, solar_radiation_wm2, hour_of_day,
                            day_of_week, month, is_weekend, is_public_holiday_fr),
               w.temperature_celsius, w.wind_speed_kmh, w.solar_radiation_wm2,
               {parts_of("f.date_heure + INTERVAL 24 HOUR")},
               {flags_of("f.date_heure + INTERVAL 24 HOUR")},
               t.consommation
        FROM features f
        JOIN eco t ON t.region = f.region AND t.date_heure = f.date_heure + INTERVAL 24 HOUR
        LEFT JOIN weather_h w ON w.region = f.region
             AND w.hour_dt = f.date_heure + INTERVAL 24 HOUR
        WHERE f.consommation_lag_24h IS NOT NULL AND t.consommation IS NOT NULL""",
    "train_ref": """
        SELECT f.*, t.consommation FROM features f
        JOIN eco t ON t.region = f.region AND t.date_heure = f.date_heure + INTERVAL 24 HOUR
        WHERE f.consommation_lag_24h IS NOT NULL AND t.consommation IS NOT NULL""",
    "dtrain": """
        SELECT l.* EXCLUDE (consommation), t.consommation FROM dlags l
        JOIN daily t ON t.region = l.region AND t.date_heure = l.date_heure + INTERVAL 24 HOUR
        WHERE l.consommation_lag_24h IS NOT NULL""",
    "split": """
        SELECT *, CASE WHEN epoch_us(date_heure) <= (SELECT min(epoch_us(date_heure)) +
               CAST(floor((max(epoch_us(date_heure)) - min(epoch_us(date_heure))) * CAST(1 - 0.2e0 AS DOUBLE))
               AS BIGINT) FROM train) THEN 'train' ELSE 'val' END AS split FROM train""",
}

_WORD = re.compile(r"[A-Za-z_][A-Za-z_0-9]*")


def with_parts(select: str) -> str:
    """The query preceded by the shared expressions it names, directly or through others."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for word in set(_WORD.findall(text)):
            if word in CTES and word not in needed:
                needed.add(word)
                visit(CTES[word])

    visit(select)
    body = ", ".join(f"{name} AS ({CTES[name]})" for name in CTES if name in needed)
    if body and select.lstrip().startswith("WITH"):
        select = f"SELECT * FROM ({select})"
    return f"WITH {body} {select}" if body else select
