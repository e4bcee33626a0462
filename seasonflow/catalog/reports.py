"""Report tables over demand and predictions."""

from __future__ import annotations

from pyspark.sql import functions as F

from seasonflow.catalog.base import LONG, PREDICTIONS, holidays, predictions, query, rounded
from seasonflow.catalog.features import DAILY_SQL
from seasonflow.operators import features
from seasonflow.plans import reports
from seasonflow.sources import tables

P = f"WITH {PREDICTIONS}"
D = f"WITH {DAILY_SQL.strip()}"

_EVENTS = """ev AS (SELECT CAST(ts AS DATE) AS ds, event_type AS key, CAST(hour(ts) AS INTEGER) AS hour,
  CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS y FROM events GROUP BY 1, 2, 3)"""


@query(
    f"""WITH {_EVENTS}, grid AS (SELECT key, CAST(range AS INTEGER) AS hour_of_day FROM (SELECT DISTINCT key FROM ev), range(0, 24))
SELECT g.key, g.hour_of_day, """
    + ", ".join(f"round(coalesce(avg(y) FILTER (WHERE isodow(ds) = {d + 1}), 0), 6) AS dow_{d}" for d in range(7))
    + " FROM grid g LEFT JOIN ev ON ev.key = g.key AND ev.hour = g.hour_of_day GROUP BY 1, 2"
)
def demand_heatmap(spark, folder):
    events = features.add_calendar(tables.events_hourly(spark, folder), trend_base=2024)
    return rounded(reports.heatmap(events, range(24)), 6, *[f"dow_{d}" for d in range(7)])


@query(D + " SELECT key, round(sum(y) / 1e6, 6) AS millions FROM daily GROUP BY key ORDER BY millions")
def totals_by_key(spark, folder):
    return rounded(reports.totals_by_key(tables.orders_daily(spark, folder)), 6, "millions")


@query(D + " SELECT key, round(sum(y), 2) AS total FROM daily GROUP BY key ORDER BY sum(y) DESC, key LIMIT 3")
def top_keys(spark, folder):
    return rounded(reports.top_keys(tables.orders_daily(spark, folder)), 2, "total")


@query(
    D
    + """, d AS (SELECT ds, sum(y) AS total FROM daily GROUP BY ds)
SELECT ds, round(total, 2) AS total, round(avg(total) OVER (ORDER BY ds ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 3) AS ma7 FROM d"""
)
def daily_system_total(spark, folder):
    return rounded(rounded(reports.daily_total(tables.orders_daily(spark, folder)), 2, "total"), 3, "ma7")


@query(
    D
    + """, a AS (SELECT CAST(year(ds) AS INTEGER) AS year, sum(y) / 1e6 AS millions FROM daily WHERE month(ds) BETWEEN 1 AND 9 GROUP BY 1)
SELECT year, round(millions, 6) AS millions, round((millions / lag(millions) OVER (ORDER BY year) - 1) * 100, 6) AS change_pct FROM a"""
)
def annual_totals(spark, folder):
    found = reports.annual_totals(tables.orders_daily(spark, folder))
    return rounded(rounded(found, 6, "millions"), 6, "change_pct")


_MONTHLY = (
    D
    + """, mo AS (SELECT strftime(ds, '%Y-%m') AS month, round_even(CAST(sum(CAST(y AS DECIMAL(18,2))) AS DOUBLE), 0) AS total FROM daily GROUP BY 1)"""
)


def _monthly(spark, folder):
    exact = tables.orders_daily(spark, folder).withColumn("y", F.col("y").cast("decimal(18,2)"))
    return reports.monthly_totals(exact, y="y")


@query(_MONTHLY + " SELECT * FROM mo")
def monthly_totals(spark, folder):
    return _monthly(spark, folder)


@query(
    _MONTHLY
    + """, x AS (SELECT *, row_number() OVER (ORDER BY month) - 1 AS x FROM mo), fit AS (SELECT regr_slope(total, x) AS s, regr_intercept(total, x) AS i FROM x)
SELECT month, total, round(i + s * x, 2) AS trend FROM x, fit"""
)
def monthly_trend(spark, folder):
    return rounded(reports.linear_trend(_monthly(spark, folder)), 2, "trend")


# ------------------------------------------------------------------ predictions


@query(P + " SELECT ds, key, round(sum(real), 6) AS real, round(sum(pred), 6) AS pred FROM preds GROUP BY ds, key")
def daily_sums(spark, folder):
    return rounded(reports.daily_sums(predictions(spark, folder)), 6, "real", "pred")


@query(P + " SELECT ds, key, round(avg(real), 6) AS real, round(avg(pred), 6) AS pred FROM preds GROUP BY ds, key")
def daily_means(spark, folder):
    return rounded(reports.daily_means(predictions(spark, folder)), 6, "real", "pred")


@query(
    P
    + """, best AS (SELECT key FROM long GROUP BY key ORDER BY sum(y) DESC, key LIMIT 3)
SELECT ds, key, round(sum(real), 6) AS real, round(sum(pred), 6) AS pred FROM preds
WHERE model = 'Baseline' AND key IN (SELECT key FROM best) GROUP BY ds, key"""
)
def real_against_predicted(spark, folder):
    found = reports.real_against_predicted(predictions(spark, folder), tables.line_long(spark, folder), "Baseline")
    return rounded(found, 6, "real", "pred")


@query(
    P
    + """, e AS (SELECT kind, abs_err, max(abs_err) OVER () AS top FROM preds WHERE model = 'Baseline')
SELECT kind, CAST(least(floor(abs_err / top * 50), 49) AS INTEGER) AS bin, count(*) AS n FROM e WHERE kind IS NOT NULL GROUP BY 1, 2"""
)
def error_histogram(spark, folder):
    long = tables.line_long(spark, folder)
    return reports.error_histogram(predictions(spark, folder), long.select("key", "kind").distinct(), "Baseline")


@query(
    P
    + """, f AS (SELECT * FROM preds WHERE model = 'Roll7')
SELECT round(avg(abs_err), 6) AS mae, round(sum(real), 2) AS total,
  (SELECT hour FROM f GROUP BY hour ORDER BY avg(real) DESC, hour LIMIT 1) AS peak_hour,
  (SELECT key FROM f GROUP BY key ORDER BY sum(real) DESC, key LIMIT 1) AS busiest_key FROM f"""
)
def key_performance(spark, folder):
    found = reports.key_performance(predictions(spark, folder).where("model = 'Roll7'"))
    return rounded(rounded(found, 6, "mae"), 2, "total")


# ------------------------------------------------------------------ holidays


@query(P + " SELECT ds, holiday, model, round(avg(abs_err), 6) AS mae, round(sum(real), 2) AS total FROM preds WHERE is_holiday = 1 GROUP BY ds, holiday, model")
def holiday_mae(spark, folder):
    found = reports.holiday_mae(predictions(spark, folder), holidays(spark))
    return rounded(rounded(found, 6, "mae"), 2, "total")


@query(
    P
    + """, h AS (SELECT ds, holiday, avg(abs_err) FILTER (WHERE model = 'Baseline') AS b, avg(abs_err) FILTER (WHERE model = 'Roll7') AS m
  FROM preds WHERE is_holiday = 1 GROUP BY ds, holiday)
SELECT strftime(ds, '%d/%m/%Y') AS date, holiday, CAST(round_even(b, 0) AS INTEGER) AS baseline_mae,
  CAST(round_even(m, 0) AS INTEGER) AS model_mae, round_even((b - m) / b * 100, 1) AS gain_pct FROM h"""
)
def holiday_comparison(spark, folder):
    by_holiday = reports.holiday_mae(predictions(spark, folder), holidays(spark))
    return reports.holiday_comparison(by_holiday, "Roll7")


@query(
    P
    + """ SELECT model, round(avg(abs_err) FILTER (WHERE is_holiday = 0), 6) AS normal_mae,
  round(avg(abs_err) FILTER (WHERE is_holiday = 1), 6) AS holiday_mae FROM preds WHERE model IN ('Baseline', 'Roll7') GROUP BY model"""
)
def normal_and_holiday_mae(spark, folder):
    found = reports.normal_and_holiday_mae(predictions(spark, folder), holidays(spark), ["Baseline", "Roll7"])
    return rounded(found, 6, "normal_mae", "holiday_mae")


@query(
    P
    + """, nm AS (SELECT avg(real) AS v FROM preds WHERE is_holiday = 0),
d AS (SELECT ds, holiday, count(*) FILTER (WHERE model = 'Baseline') AS n, avg(real) FILTER (WHERE model = 'Baseline') AS r,
  avg(abs_err) FILTER (WHERE model = 'Baseline') AS b, avg(abs_err) FILTER (WHERE model = 'Roll7') AS m
  FROM preds WHERE is_holiday = 1 GROUP BY ds, holiday)
SELECT strftime(ds, '%d/%m') || ' ' || substring(holiday, 1, 25) AS day, round(b, 6) AS baseline_mae, round(m, 6) AS model_mae,
  CASE WHEN r / v * 100 >= 60 THEN 'active' ELSE 'quiet' END AS day_class FROM d, nm WHERE n >= 5"""
)
def holiday_day_table(spark, folder):
    found = reports.holiday_day_table(predictions(spark, folder), holidays(spark), "Roll7")
    return rounded(found, 6, "baseline_mae", "model_mae")
