"""Registry, shared inputs, and the SQL building blocks of the checks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seasonflow.functions.holidays import COLOMBIA, holiday_table
from seasonflow.operators import features
from seasonflow.operators.baseline import SeasonalMean
from seasonflow.operators.split import temporal_split
from seasonflow.session import settle
from seasonflow.sources import tables
from seasonflow.sources.tables import RETAIL

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    """Registers a query under its function name, with its check if SQL can say it."""

    def register(f):
        label = name or f.__name__
        QUERIES[label] = f
        if sql is not None:
            SQL[label] = sql
        return f

    return register


def rounded(df: DataFrame, places: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), places) for c in columns})


def long_count(column: str) -> Column:
    return F.col(column).cast("long")


# ------------------------------------------------------------------ shared inputs


def holidays(spark: SparkSession) -> DataFrame:
    return holiday_table(spark, RETAIL.years)


def history(spark: SparkSession, folder: str) -> DataFrame:
    """Calendar parts, lags and rolling statistics; (ds, key, hour) is unique."""
    dated = features.add_calendar(tables.line_long(spark, folder), trend_base=RETAIL.trend_base)
    return features.add_history(dated, bounded=True)


def split_rows(spark: SparkSession, folder: str) -> DataFrame:
    return temporal_split(history(spark, folder), RETAIL.test_from, RETAIL.test_until, RETAIL.val_from)


def scored_rows(spark: SparkSession, folder: str) -> DataFrame:
    rows = settle(split_rows(spark, folder))  # fitted on and scored: computed once
    model = SeasonalMean().fit(rows.where("split <> 'test'"))
    return model.transform(rows.where("split = 'test'"))


def predictions(spark: SparkSession, folder: str) -> DataFrame:
    """Test rows forecast by the seasonal mean and by two persistence forecasts,
    unrolled from one scored row rather than from one scan per model."""
    scored = features.add_holidays(scored_rows(spark, folder), holidays(spark))
    each = F.array(
        F.struct(F.lit("Baseline").alias("model"), F.col("pred").alias("pred")),
        F.struct(F.lit("Lag7").alias("model"), F.col("lag_7d").alias("pred")),
        F.struct(F.lit("Roll7").alias("model"), F.col("rolling_7d").alias("pred")),
    )
    rows = scored.select("ds", "key", "hour", "kind", "is_holiday", F.col("y").alias("real"), F.inline(each))
    return rows.withColumn("abs_err", F.abs(F.col("real") - F.col("pred")))


# ------------------------------------------------------------------ SQL blocks

_KINDS = ", ".join(f"('{k}', '{v}')" for k, v in RETAIL.types.items())
_RULES = ", ".join(f"('{n}', '{r}', {m}, {d}, {o})" for n, r, m, d, o in COLOMBIA)

CELLS = """
cells AS (
  SELECT CAST(l_shipdate AS DATE) AS ds, l_returnflag || l_linestatus AS key,
         CAST(l_linenumber AS INTEGER) AS hour,
         CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS y
  FROM lineitem GROUP BY 1, 2, 3)"""

LONG = f"""{CELLS},
kinds(key, kind) AS (VALUES {_KINDS}),
days AS (SELECT DISTINCT ds, key FROM cells),
slots AS (SELECT CAST(range AS INTEGER) AS hour FROM range(1, 8)),
long AS (
  SELECT d.ds, d.key, s.hour, c.y, k.kind
  FROM days d CROSS JOIN slots s
  LEFT JOIN cells c ON c.ds = d.ds AND c.key = d.key AND c.hour = s.hour
  LEFT JOIN kinds k ON k.key = d.key)"""

HISTORY = f"""{LONG},
hist AS (
  SELECT *, isodow(ds) - 1 AS weekday,
    lag(y, 1) OVER w AS lag_1d, lag(y, 7) OVER w AS lag_7d, lag(y, 14) OVER w AS lag_14d,
    CASE WHEN count(y) OVER w7 >= 3 THEN avg(y) OVER w7 END AS rolling_7d,
    CASE WHEN count(y) OVER w28 >= 14 THEN avg(y) OVER w28 END AS rolling_28d,
    CASE WHEN count(y) OVER w7 >= 3 THEN stddev_samp(y) OVER w7 END AS rolling_7d_std
  FROM long
  WINDOW w AS (PARTITION BY key, hour ORDER BY ds),
    w7 AS (PARTITION BY key, hour ORDER BY ds ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING),
    w28 AS (PARTITION BY key, hour ORDER BY ds ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING))"""

SPLIT = f"""{HISTORY},
usable AS (
  SELECT *, CASE WHEN ds BETWEEN DATE '{RETAIL.test_from}' AND DATE '{RETAIL.test_until}' THEN 'test'
                 WHEN ds >= DATE '{RETAIL.val_from}' THEN 'val' ELSE 'train' END AS split
  FROM hist
  WHERE y IS NOT NULL AND lag_1d IS NOT NULL AND lag_7d IS NOT NULL AND rolling_7d IS NOT NULL)"""

HOLIDAYS = f"""
years AS (SELECT CAST(range AS INTEGER) AS y FROM range({RETAIL.years[0]}, {RETAIL.years[-1] + 1})),
rules(name, rule, m, d, shift) AS (VALUES {_RULES}),
e1 AS (SELECT y, y % 19 AS a, y // 100 AS b, y % 100 AS c FROM years),
e2 AS (SELECT *, (19 * a + b - b // 4 - (b - (b + 8) // 25 + 1) // 3 + 15) % 30 AS h FROM e1),
e3 AS (SELECT *, (32 + 2 * (b % 4) + 2 * (c // 4) - h - c % 4) % 7 AS l FROM e2),
e4 AS (SELECT y, h + l - 7 * ((a + 11 * h + 22 * l) // 451) + 114 AS t FROM e3),
easter AS (SELECT y, make_date(y, t // 31, t % 31 + 1) AS sunday FROM e4),
named AS (
  SELECT CASE rule WHEN 'easter' THEN CAST(sunday + CAST(shift AS INTEGER) AS DATE)
           ELSE make_date(e.y, greatest(m, 1), greatest(d, 1)) END AS nominal, rule, name
  FROM easter e CROSS JOIN rules),
moved AS (
  SELECT CASE WHEN rule = 'monday' THEN CAST(nominal + CAST((8 - isodow(nominal)) % 7 AS INTEGER) AS DATE)
           ELSE nominal END AS ds, name FROM named),
hol AS (SELECT ds, string_agg(name, '; ' ORDER BY name) AS holiday,
               CAST(isodow(ds) = 1 AS INTEGER) AS is_bridge FROM moved GROUP BY ds)"""

PREDICTIONS = f"""{SPLIT},
means AS (SELECT key, hour, weekday, avg(y) AS m FROM usable WHERE split <> 'test' GROUP BY 1, 2, 3),
scored AS (
  SELECT u.*, greatest(coalesce(m.m, (SELECT avg(m) FROM means)), 0) AS base
  FROM usable u LEFT JOIN means m ON m.key = u.key AND m.hour = u.hour AND m.weekday = u.weekday
  WHERE split = 'test'),
{HOLIDAYS.strip()},
three AS (
  SELECT ds, key, hour, kind, y AS real, 'Baseline' AS model, base AS pred FROM scored
  UNION ALL SELECT ds, key, hour, kind, y, 'Lag7', lag_7d FROM scored
  UNION ALL SELECT ds, key, hour, kind, y, 'Roll7', rolling_7d FROM scored),
preds AS (
  SELECT t.*, abs(real - pred) AS abs_err, CAST(h.ds IS NOT NULL AS INTEGER) AS is_holiday, h.holiday
  FROM three t LEFT JOIN hol h ON h.ds = t.ds)"""

METRICS = """
CASE WHEN count(*) > 0 THEN round_even(avg(abs(real - pred)), 2) END AS mae,
round_even(sqrt(avg((real - pred) * (real - pred))), 2) AS rmse,
CASE WHEN count(*) < 2 THEN NULL
     WHEN min(real) = max(real) THEN CASE WHEN sum((real - pred) * (real - pred)) = 0 THEN 1.0 ELSE 0.0 END
     ELSE round_even(1 - sum((real - pred) * (real - pred)) / (var_pop(real) * count(*)), 4) END AS r2,
count(*) AS n"""
