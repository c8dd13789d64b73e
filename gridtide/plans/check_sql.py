"""For each named query the same result in another engine's SQL, written independently.

Sources, sinks and streams compare with the direct computation of what they should hold.
"""

from __future__ import annotations

_WIDE = """
wide AS (
    SELECT event_id, ts + INTERVAL 20 DAY AS time,
        CASE WHEN event_type <> 'signup' THEN value END AS load_actual,
        CAST(user_id AS DOUBLE) AS load_forecast,
        CASE WHEN event_type = 'view' THEN value END AS solar_actual,
        CASE WHEN event_type = 'click' THEN value END AS wind_actual,
        CASE WHEN event_type = 'error' THEN value END AS wind_onshore,
        value * 0.25 AS wind_offshore
    FROM events
)"""

_SEVEN = "time, load_actual, load_forecast, solar_actual, wind_actual, wind_onshore, wind_offshore"

_FEATURES = f"""
WITH {_WIDE}
SELECT {_SEVEN}, load_actual - load_forecast AS forecast_error,
    CAST(hour(time) AS INTEGER) AS hour_of_day, CAST(dayofweek(time) AS INTEGER) AS day_of_week,
    LAG(load_actual, 1) OVER w AS load_actual_lag_1,
    LAG(load_actual, 24) OVER w AS load_actual_lag_24,
    LAG(load_forecast, 1) OVER w AS load_forecast_lag_1
FROM wide WINDOW w AS (ORDER BY time, event_id)"""


_CROWDED = """
crowded AS (
    SELECT * REPLACE (
        CASE WHEN event_type = 'purchase' THEN TIMESTAMP '2024-01-15 12:00:00' ELSE ts END AS ts,
        CASE WHEN event_type = 'purchase' THEN 7 ELSE user_id END AS user_id,
        CASE WHEN event_type = 'purchase' THEN 20.0 ELSE value END AS value)
    FROM events
)"""
_CROWDED_WIDE = f"{_CROWDED}, {_WIDE.replace('FROM events', 'FROM crowded')}"


def _daily(load: str = "load_actual") -> str:
    clock = "strftime(time, '%H:%M')"
    return f"""{_WIDE}, daily AS (
    SELECT CAST(time AS DATE) AS day,
        first({load} ORDER BY {load} DESC, time) AS peak_load, first({clock} ORDER BY {load} DESC, time) AS peak_time,
        first({load} ORDER BY {load}, time) AS min_load, first({clock} ORDER BY {load}, time) AS min_time
    FROM wide WHERE load_actual IS NOT NULL GROUP BY ALL
)"""


def _long(series: tuple[str, ...], where: str = "") -> str:
    names = ", ".join(series)
    return f"""
WITH {_WIDE}, chosen AS (
    SELECT time, {names} FROM (SELECT *, load_actual - load_forecast AS forecast_error FROM wide) {where}
)
SELECT time, "Type", "Load (MW)" FROM chosen UNPIVOT INCLUDE NULLS ("Load (MW)" FOR "Type" IN ({names}))"""


_MONTH = "WHERE strftime(time, '%Y-%m') = '2024-02'"
_TARGETS = _long(("load_actual", "load_forecast"), _MONTH)
_QUALITY = f"""
WITH {_WIDE}
SELECT COUNT(*) AS total_rows, MIN(time) AS start_date, MAX(time) AS end_date,
    ROUND(AVG(load_actual), 6) AS avg_load_mw, MAX(load_actual) AS max_load_mw, MIN(load_actual) AS min_load_mw,
    COUNT(*) FILTER (load_actual IS NULL) AS null_counts
FROM wide"""


def _scores(key: str = "", group: str = "") -> str:
    return f"""
WITH {_WIDE}, errors AS (SELECT time, load_actual - load_forecast AS e FROM wide)
SELECT {key} COUNT(e) AS scored_rows, ROUND(AVG(ABS(e)), 6) AS mae, ROUND(SQRT(AVG(e * e)), 6) AS rmse
FROM errors {group}"""


def _latest(step: str, keys: str, where: str = "TRUE", value: str = "value") -> str:
    """Newest sample per series and instant."""
    return f"""
samples AS (
    SELECT event_id, event_type AS job, CAST(user_id AS VARCHAR) AS instance, ts, {value} AS value FROM events
), placed AS (
    SELECT {keys}, time_bucket(INTERVAL '{step}', ts) + INTERVAL '{step}' AS instant, value,
        ROW_NUMBER() OVER (
            PARTITION BY {keys}, time_bucket(INTERVAL '{step}', ts) ORDER BY ts DESC, value DESC) AS age
    FROM samples WHERE {where}
), latest AS (SELECT {keys}, instant, value FROM placed WHERE age = 1)"""


def _rates(window: str, step: str, steps: int, keys: str, where: str = "TRUE") -> str:
    """Every window taken apart: its samples, their neighbours inside it, growth over time."""
    return f"""
samples AS (
    SELECT event_id, event_type AS job, CAST(user_id AS VARCHAR) AS instance, ts, value
    FROM events WHERE {where}
), seen AS (
    SELECT {keys}, event_id, ts, value,
        time_bucket(INTERVAL '{step}', ts) + i * INTERVAL '{step}' AS instant
    FROM samples, range(1, {steps + 1}) AS offsets(i)
), paired AS (
    SELECT {keys}, instant, ts, value,
        LAG(value) OVER (PARTITION BY {keys}, instant ORDER BY ts, event_id) AS earlier
    FROM seen
), rates AS (
    SELECT {keys}, instant,
        SUM(CASE WHEN earlier IS NULL THEN 0 WHEN value >= earlier THEN value - earlier ELSE value END)
            / (epoch_us(MAX(ts)) - epoch_us(MIN(ts))) * 1000000 AS value
    FROM paired GROUP BY {keys}, instant HAVING MAX(ts) > MIN(ts)
)"""


def _runs(source: str, ts: str, order: str, threshold: float, hold: str, gap: str = "") -> str:
    return f"""
marked AS (
    SELECT *, value > {threshold} AS above,
        LAG(value > {threshold}) OVER w AS was_above, LAG({ts}) OVER w AS before
    FROM {source} WINDOW w AS (PARTITION BY job ORDER BY {order})
), numbered AS (
    SELECT *, SUM(CASE WHEN above AND was_above {gap} THEN 0 ELSE 1 END)
        OVER (PARTITION BY job ORDER BY {order} ROWS UNBOUNDED PRECEDING) AS run
    FROM marked
), runs AS (
    SELECT job, {ts}, value, MIN({ts}) OVER (PARTITION BY job, run) AS active_since FROM numbered WHERE above
), alerts AS (
    SELECT job, {ts}, value, active_since,
        CASE WHEN {ts} - active_since >= INTERVAL '{hold}' THEN 'firing' ELSE 'pending' END AS state
    FROM runs
)"""


_HOURLY = """
hourly AS (
    SELECT event_type AS job, time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour' AS instant,
        ROUND(SUM(value), 4) / COUNT(*) AS value
    FROM events GROUP BY ALL
)"""
_GAP = "AND instant - before <= INTERVAL '1 hour'"

SQL: dict[str, str] = {
    "staging_load": f"WITH {_WIDE} SELECT {_SEVEN} FROM wide",
    "staging_untimed": f"""
        WITH {_WIDE} SELECT wide.event_id, {_SEVEN} FROM wide JOIN events USING (event_id)
        WHERE event_type <> 'purchase'""",
    "features_lag": _FEATURES,
    "features_lag_blocks": _FEATURES,
    "features_calendar": f"""
        WITH {_WIDE} SELECT event_id, time, CAST(hour(time) AS INTEGER) AS hour_of_day,
            CAST(dayofweek(time) AS INTEGER) AS day_of_week FROM wide""",
    "forecast_error": f"WITH {_WIDE} SELECT event_id, time, load_actual - load_forecast AS forecast_error FROM wide",
    "daily_peak_struct": f"WITH {_daily()} SELECT * FROM daily",
    "daily_peak_rank": f"WITH {_daily()} SELECT * FROM daily",
    "daily_peak_ties": f"WITH {_daily('floor(load_actual)')} SELECT * FROM daily",
    "daily_peak_rank_ties": f"WITH {_daily('floor(load_actual)')} SELECT * FROM daily",
    "latest_days": f"WITH {_daily()} SELECT * FROM daily ORDER BY day DESC LIMIT 10",
    "latest_days_display": f"""
        WITH {_daily()}
        SELECT day AS "Date", CAST(peak_load AS VARCHAR) || ' MW' AS "Peak Load", peak_time AS "Time of Peak",
            CAST(min_load AS VARCHAR) || ' MW' AS "Minimum Load", min_time AS "Time of Minimum"
        FROM daily ORDER BY day DESC LIMIT 10""",
    "load_melt": _long(
        (
            "load_actual",
            "load_forecast",
            "solar_actual",
            "wind_actual",
            "wind_onshore",
            "wind_offshore",
            "forecast_error",
        )
    ),
    "series_targets": _TARGETS,
    "series_features": _long(("solar_actual", "wind_actual", "wind_onshore", "wind_offshore"), _MONTH),
    "month_counts": f"""
        WITH {_WIDE} SELECT strftime(time, '%Y-%m') AS month, COUNT(*) AS row_count FROM wide GROUP BY ALL""",
    "quality_summary": _QUALITY,
    "forecast_metrics": _scores(),
    "forecast_metrics_by_day": _scores("CAST(time AS DATE) AS day,", "GROUP BY day"),
    "forecast_metrics_by_hour": _scores("CAST(hour(time) AS INTEGER) AS hour_of_day,", "GROUP BY hour_of_day"),
    "metric_label_filters": """
        SELECT event_id, event_type AS job, CAST(user_id AS VARCHAR) AS instance, value FROM events
        WHERE event_type IN ('click', 'view') AND user_id <> 7 AND NOT starts_with(CAST(user_id AS VARCHAR), '1')""",
    "metric_latest": f"WITH {_latest('1 hour', 'job, instance')} SELECT * FROM latest",
    "metric_latest_any": f"WITH {_latest('1 hour', 'job, instance')} SELECT * FROM latest",
    "metric_avg_by_label": f"""
        WITH {_latest('1 hour', 'job, instance')}
        SELECT instant, job, ROUND(SUM(value), 4) / COUNT(*) AS value FROM latest GROUP BY instant, job""",
    "metric_sum_matched": f"""
        WITH {_latest('1 hour', 'job, instance', "job IN ('click', 'view', 'purchase')")}
        SELECT instant, ROUND(SUM(value), 6) AS value FROM latest GROUP BY instant""",
    "targets_up": f"""
        WITH {_latest('1 hour', 'instance', value="CAST(event_type <> 'error' AS DOUBLE)")}
        SELECT instant, SUM(value) AS value FROM latest GROUP BY instant""",
    "metric_counter_rate": f"""
        WITH {_rates('2 hours', '30 minutes', 4, 'job')} SELECT job, instant, ROUND(value, 6) AS value FROM rates""",
    "busy_percent": f"""
        WITH {_rates('2 days', '12 hours', 4, 'job, instance', "event_type IN ('click', 'view')")}
        SELECT instant, instance, ROUND(100 - AVG(value) * 100, 6) AS value FROM rates GROUP BY instant, instance""",
    "metric_rate_by_label": f"""
        WITH {_rates('2 days', '12 hours', 4, 'job, instance', "event_type <> 'signup'")}
        SELECT instant, job, ROUND(SUM(value) * 100, 6) AS value FROM rates GROUP BY instant, job""",
    "metric_topk": f"""
        WITH {_latest('6 hours', 'job, instance')}, ranked AS (
            SELECT *, ROW_NUMBER() OVER (PARTITION BY instant ORDER BY value DESC, job, instance) AS n FROM latest)
        SELECT job, instance, instant, value, CAST(n AS INTEGER) AS rank FROM ranked WHERE n <= 10""",
    "metric_ratio": f"""
        WITH {_latest('1 day', 'job, instance')}
        SELECT f.instance, f.instant, ROUND((1 - f.value / t.value) * 100, 6) AS value
        FROM latest f JOIN latest t ON f.instance = t.instance AND f.instant = t.instant
        WHERE f.job = 'click' AND t.job = 'view'""",
    "alert_sustained": f"""
        WITH samples AS (SELECT event_id, event_type AS job, ts, value FROM events),
        {_runs('samples', 'ts', 'ts, event_id', 20.0, '30 minutes')} SELECT * FROM alerts""",
    "alert_instants": f"""
        WITH {_HOURLY}, {_runs('hourly', 'instant', 'instant', 45.0, '2 hours', _GAP)} SELECT * FROM alerts""",
    "alerts_firing": f"""
        WITH {_HOURLY}, {_runs('hourly', 'instant', 'instant', 45.0, '2 hours', _GAP)}
        SELECT instant, COUNT(*) AS firing FROM alerts WHERE state = 'firing' GROUP BY instant""",
    "stream_rolling_avg": """
        WITH seen AS (
            SELECT event_type AS job, value,
                time_bucket(INTERVAL '30 minutes', ts) + i * INTERVAL '30 minutes' AS instant
            FROM events, range(1, 5) AS offsets(i))
        SELECT instant, job, ROUND(SUM(value), 4) / COUNT(*) AS value FROM seen GROUP BY instant, job""",
    "stream_daily_peak": f"WITH {_daily()} SELECT * FROM daily",
    "alert_busy": f"""
        WITH {_rates('2 days', '12 hours', 4, 'job, instance', "event_type IN ('click', 'view')")}, busy AS (
            SELECT instance AS job, instant, ROUND(100 - AVG(value) * 100, 6) AS value FROM rates GROUP BY instant, instance
        ), {_runs('busy', 'instant', 'instant', 99.95, '1 day', "AND instant - before <= INTERVAL '12 hours'")}
        SELECT job AS instance, instant, value, active_since, state FROM alerts""",
    "csv_staging": f"WITH {_WIDE} SELECT {_SEVEN} FROM wide",
    "csv_inferred": f"WITH {_WIDE} SELECT {_SEVEN} FROM wide",
    "parquet_export": """
        SELECT series AS "Type", COUNT(*) AS stored, CAST(7 * COUNT(*) AS INTEGER) AS written
        FROM events, unnest(['load_actual', 'load_forecast', 'solar_actual', 'wind_actual', 'wind_onshore',
            'wind_offshore', 'forecast_error']) AS names(series)
        GROUP BY series""",
    "table_replace": "SELECT COUNT(*) AS row_count, CAST(2 AS BIGINT) AS column_count FROM events",
    "table_replace_failed": "SELECT event_id, value FROM events",
    "table_replace_self": """
        SELECT event_id + 2 AS event_id, value FROM events WHERE event_id % 3 > 0 AND (event_id + 1) % 3 > 0""",
    "footer_counts": """
        SELECT COUNT(*) AS rows, 'plain' AS layout FROM events UNION ALL SELECT COUNT(*), 'parts' FROM events""",
    "sql_text": f"""
        WITH {_WIDE} SELECT CAST(time AS DATE) AS day, COUNT(*) AS row_count, MAX(load_actual) AS peak_load
        FROM wide WHERE load_actual >= 10 GROUP BY day""",
    "stored_features": _FEATURES,
    "features_lag_crowded": _FEATURES.replace(_WIDE, _CROWDED_WIDE).replace(
        "ORDER BY time, event_id", f"ORDER BY {', '.join(f'{name} NULLS FIRST' for name in _SEVEN.split(', '))}"
    ),
    "stored_features_order": f"""
        WITH {_CROWDED_WIDE} SELECT COUNT(*) AS row_count, MIN(time) AS first_time, MAX(time) AS last_time,
            CAST(0 AS BIGINT) AS disordered_rows, CAST(0 AS BIGINT) AS overlapping_files FROM wide""",
    "stored_quality": _QUALITY,
    "stored_latest_days": f"WITH {_daily()} SELECT * FROM daily ORDER BY day DESC LIMIT 10",
    "stored_series": _TARGETS,
    "train_split": f"""
        WITH {_WIDE}, numbered AS (
            SELECT time, event_id, ROW_NUMBER() OVER (ORDER BY time, event_id) AS n,
                CAST(floor(COUNT(*) OVER () * 0.8) AS BIGINT) AS training
            FROM wide)
        SELECT time, event_id, CAST(CASE WHEN n <= training // 3 THEN 0 WHEN n <= training * 2 // 3 THEN 1
                WHEN n <= training THEN 2 END AS INTEGER) AS fold,
            CASE WHEN n <= training THEN 'train' ELSE 'test' END AS part
        FROM numbered""",
}
SQL["stream_rate"] = SQL["stream_rate_scattered"] = SQL["stream_rate_batches"] = SQL["metric_counter_rate"]
SQL["stream_ratio"] = SQL["stream_ratio_scattered"] = SQL["metric_ratio"]
# Six batches of five days; rows of odd hours count as seven hours later.
SQL["stream_alert_timely"] = f"""
    WITH {_HOURLY}, placed AS (
        SELECT *, epoch(instant)::BIGINT // 3600 AS h FROM hourly
    ), dealt AS (
        SELECT job, instant, value, greatest(0, least(5, (h + 7 * (h % 2) - 473352) // 120)) AS arrived FROM placed
    ), so_far AS (
        SELECT job, instant, value, batch FROM dealt, range(6) AS batches(batch) WHERE arrived <= batch AND value > 45
    )
    SELECT a.batch::INTEGER AS batch, a.job, a.instant, a.value,
        CASE WHEN COUNT(*) = 3 THEN 'firing' ELSE 'pending' END AS state
    FROM so_far a JOIN so_far b ON a.job = b.job AND a.batch = b.batch
        AND b.instant BETWEEN a.instant - INTERVAL '2 hours' AND a.instant
    GROUP BY ALL"""
SQL["stream_resumed"] = """
    WITH seen AS (
        SELECT event_type AS job, value, drained::INTEGER AS drained,
            time_bucket(INTERVAL '30 minutes', ts) + i * INTERVAL '30 minutes' AS instant
        FROM events, range(1, 5) AS offsets(i), range(3) AS drains(drained)
        WHERE drained = 2 OR ts < TIMESTAMP '2024-01-15 00:00:00')
    SELECT instant, job, drained, ROUND(SUM(value), 4) / COUNT(*) AS value FROM seen GROUP BY instant, job, drained"""
SQL["stream_alerts"] = SQL["stream_alerts_scattered"] = SQL["alert_instants"]
SQL["stream_rolling_scattered"] = SQL["stream_rolling_avg"]
# The held-out fifth in time order, predicted without error.
SQL["train_holdout"] = """
    SELECT COUNT(*) - CAST(floor(COUNT(*) * 0.8) AS BIGINT) AS scored_rows,
        CAST(0 AS DOUBLE) AS mae, CAST(0 AS DOUBLE) AS rmse FROM events"""
# A tree takes the learning rate's share of what is left of each step, so the error shrinks by a power.
SQL["train_grid"] = """
    WITH numbered AS (
        SELECT 20.0 + 30.0 * (event_type = 'view')::INTEGER + 10.0 * (event_type = 'click')::INTEGER AS load,
            ROW_NUMBER() OVER (ORDER BY ts) AS n, CAST(floor(COUNT(*) OVER () * 0.8) AS BIGINT) AS training
        FROM events),
    folds AS (
        SELECT load::DOUBLE AS load, CASE WHEN n <= training // 3 THEN 0 WHEN n <= training * 2 // 3 THEN 1 ELSE 2 END AS fold
        FROM numbered WHERE n <= training),
    means AS (
        SELECT held.fold, AVG(folds.load) AS mean
        FROM range(3) AS held(fold) JOIN folds ON folds.fold <> held.fold GROUP BY held.fold),
    errors AS (SELECT fold, AVG(ABS(load - mean)) AS error FROM folds JOIN means USING (fold) GROUP BY fold)
    SELECT trees::DOUBLE AS n_estimators, depth::DOUBLE AS max_depth, least::DOUBLE AS min_samples_split,
        rate::DOUBLE AS learning_rate, ROUND(AVG(error) * POWER(1 - rate::DOUBLE, trees), 6) AS mae
    FROM errors, (VALUES (200), (500)) AS a(trees), (VALUES (5), (8)) AS b(depth), (VALUES (5), (10)) AS c(least),
        (VALUES (0.01), (0.05)) AS d(rate)
    GROUP BY trees, depth, least, rate"""
