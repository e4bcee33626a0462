"""Requests against stored predictions and history; one request per order."""

from __future__ import annotations

from pyspark.sql import functions as F

from seasonflow.catalog.base import LONG, PREDICTIONS, holidays, predictions, query, rounded
from seasonflow.operators import asof, features
from seasonflow.plans import scoring
from seasonflow.session import scratch_path, settle
from seasonflow.sources import tables
from seasonflow.sources.tables import RETAIL

_REQ = """
req AS (SELECT o_orderkey AS request_id, ' r' || lower(o_orderstatus) || ' ' AS line,
  CASE WHEN day(o_orderdate) = 29 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS ds,
  CAST(CASE WHEN o_orderpriority[1] = '5' THEN '50' ELSE o_orderpriority[1] END AS INTEGER) AS hour,
  CASE WHEN o_orderstatus = 'O' THEN NULL WHEN o_orderpriority[1] = '1' THEN 'Lag7' ELSE 'Baseline' END AS model FROM orders),
checked AS (SELECT r.*, k.key, CASE WHEN hour NOT BETWEEN 0 AND 23 THEN 'bad_hour' WHEN ds IS NULL THEN 'bad_date'
  WHEN k.key IS NULL THEN 'unknown_key' END AS error
  FROM req r LEFT JOIN (SELECT DISTINCT key FROM cells) k ON upper(trim(k.key)) = upper(trim(r.line)))"""

_CELL = f"WITH {LONG}, {_REQ.strip()}, cell AS (SELECT DISTINCT ds, key, hour FROM checked WHERE error IS NULL)"

_STATS = """, known AS (SELECT key, hour, ds, y FROM long WHERE y IS NOT NULL),
past AS (SELECT c.ds, c.key, c.hour, k.y, row_number() OVER (PARTITION BY c.ds, c.key, c.hour ORDER BY k.ds DESC) AS back
  FROM cell c JOIN known k ON k.key = c.key AND k.hour = c.hour AND k.ds < c.ds),
st AS (SELECT ds, key, hour, count(*) AS n, avg(y) AS whole, avg(y) FILTER (WHERE back <= 7) AS m7,
  avg(y) FILTER (WHERE back <= 28) AS m28, stddev_pop(y) FILTER (WHERE back <= 7) AS s7 FROM past GROUP BY 1, 2, 3),
roll AS (SELECT c.ds, c.key, c.hour, coalesce(n, 0) AS n_before,
  CASE WHEN n >= 3 THEN m7 ELSE coalesce(whole, 0) END AS rolling_7d,
  CASE WHEN n >= 14 THEN m28 ELSE coalesce(whole, 0) END AS rolling_28d,
  CASE WHEN n >= 3 THEN s7 ELSE 0 END AS rolling_7d_std
  FROM cell c LEFT JOIN st ON st.ds = c.ds AND st.key = c.key AND st.hour = c.hour)"""

_LAGS = ", ".join(
    f"l{k}.y AS lag_{k}d, l{k}.ds IS NOT NULL AS has_{k}d" for k in asof.DAYS
)
_LAG_JOINS = " ".join(
    f"LEFT JOIN long l{k} ON l{k}.key = c.key AND l{k}.hour = c.hour AND l{k}.ds = c.ds - {k}" for k in asof.DAYS
)


def _codes(spark, folder):
    return features.label_codes(tables.line_cells(spark, folder), "key")


def _valid(spark, folder):
    checked = scoring.validate(tables.order_requests(spark, folder), _codes(spark, folder))
    return scoring.accepted(checked)


@query(f"WITH {LONG}, {_REQ.strip()} SELECT request_id, key, ds, hour, error FROM checked")
def request_validation(spark, folder):
    checked = scoring.validate(tables.order_requests(spark, folder), _codes(spark, folder))
    return checked.select("request_id", "key", "ds", "hour", "error")


@query(f"WITH {LONG}, {_REQ.strip()} SELECT error, count(*) AS n FROM checked WHERE error IS NOT NULL GROUP BY error")
def rejected_requests(spark, folder):
    checked = scoring.validate(tables.order_requests(spark, folder), _codes(spark, folder))
    return scoring.rejected(checked).groupBy("error").agg(F.count(F.lit(1)).alias("n"))


@query(_CELL + f" SELECT c.ds, c.key, c.hour, {_LAGS} FROM cell c {_LAG_JOINS}")
def calendar_lookup(spark, folder):
    return asof.calendar_lookup(_valid(spark, folder), tables.line_long(spark, folder))


@query(
    _CELL + _STATS + """ SELECT ds, key, hour, n_before, round(rolling_7d, 7) AS rolling_7d, round(rolling_28d, 7) AS rolling_28d,
  round(rolling_7d_std, 7) AS rolling_7d_std FROM roll"""
)
def asof_history(spark, folder):
    stats = asof.history_stats(tables.line_long(spark, folder), bounded=True)
    found = asof.asof_stats(_valid(spark, folder), stats)
    return rounded(found, 7, "rolling_7d", "rolling_28d", "rolling_7d_std")


@query(
    f"""WITH {LONG} SELECT key, hour, CAST(isodow(ds) - 1 AS INTEGER) AS weekday, round(CAST(sum(CAST(y AS DECIMAL(18,2))) AS DOUBLE) / count(*), 7) AS weekday_mean
FROM long WHERE y IS NOT NULL GROUP BY 1, 2, 3"""
)
def weekday_means(spark, folder):
    exact = tables.line_long(spark, folder).withColumn("y", F.col("y").cast("decimal(18,2)"))
    return rounded(asof.weekday_means(exact), 7, "weekday_mean")


@query(f"WITH {LONG}, p AS (SELECT DISTINCT key, kind FROM long) SELECT key, kind, (SELECT count(*) FROM p) AS total FROM p ORDER BY key")
def line_listing(spark, folder):
    return scoring.lines(tables.line_long(spark, folder))


@query(
    f"""WITH {PREDICTIONS}, {_REQ.strip()},
ranked AS (SELECT *, CASE model WHEN 'Roll7' THEN 1 WHEN 'Baseline' THEN 2 ELSE 3 END AS rk FROM preds),
hit AS (SELECT r.request_id, p.key, p.model, p.pred, p.real, p.abs_err, row_number() OVER (PARTITION BY r.request_id ORDER BY p.rk) AS pos
  FROM req r JOIN ranked p ON upper(trim(p.key)) = upper(trim(r.line)) AND p.ds = r.ds AND p.hour = r.hour
    AND (r.model IS NULL OR r.model = p.model))
SELECT r.request_id, coalesce(h.key, r.line) AS line, r.ds, r.hour, round_even(h.pred, 2) AS pred, round_even(h.real, 2) AS real,
  round_even(h.abs_err, 2) AS abs_err, h.model,
  CASE WHEN r.hour NOT BETWEEN 0 AND 23 THEN 'bad_hour' WHEN r.ds IS NULL THEN 'bad_date' WHEN h.key IS NULL THEN 'not_found' ELSE 'ok' END AS status
FROM req r LEFT JOIN hit h ON h.request_id = r.request_id AND h.pos = 1"""
)
def prediction_lookup(spark, folder):
    return scoring.lookup(tables.order_requests(spark, folder), predictions(spark, folder), ["Roll7", "Baseline", "Lag7"])


def serving_state(spark, folder, laid_out: bool = False) -> scoring.ServingState:
    long = settle(tables.line_long(spark, folder))
    lines = settle(long.select("key", "kind").distinct())
    stats = settle(asof.history_stats(long, bounded=True))
    return scoring.ServingState(
        history=long,
        stats=stats,
        dated=asof.lay_out(long, stats, scratch_path(spark, "dated")) if laid_out else None,
        # sums of cents are exact, so a mean does not depend on the order of the rows
        means=settle(asof.weekday_means(long.withColumn("y", F.col("y").cast("decimal(18,2)")))),
        lines=lines,
        keys=features.label_codes(lines, "key"),
        kinds=features.label_codes(lines, "kind"),
        holidays=holidays(spark),
        rail_kind=RETAIL.rail_kind,
        trend_base=RETAIL.trend_base,
    )


_FEATURES = (
    _CELL + _STATS + f""", wm AS (SELECT key, hour, isodow(ds) - 1 AS weekday, CAST(sum(CAST(y AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS m FROM long WHERE y IS NOT NULL GROUP BY 1, 2, 3),
lg AS (SELECT c.ds, c.key, c.hour, {_LAGS} FROM cell c {_LAG_JOINS})
SELECT r.request_id, r.key, r.ds, r.hour, """
    + ", ".join(f"round(CASE WHEN has_{k}d THEN lag_{k}d ELSE coalesce(wm.m, 0) END, 7) AS lag_{k}d" for k in asof.DAYS)
    + """, has_1d AND has_7d AND has_14d AS lags_available, round(rolling_28d, 7) AS rolling_28d,
  CAST(isodow(r.ds) - 1 AS INTEGER) AS weekday, CAST(dayofyear(r.ds) AS INTEGER) AS day_of_year
FROM checked r JOIN lg ON lg.ds = r.ds AND lg.key = r.key AND lg.hour = r.hour
JOIN roll ON roll.ds = r.ds AND roll.key = r.key AND roll.hour = r.hour
LEFT JOIN wm ON wm.key = r.key AND wm.hour = r.hour AND wm.weekday = isodow(r.ds) - 1 WHERE r.error IS NULL"""
)


def _features(spark, folder, state):
    valid = scoring.accepted(scoring.validate(tables.order_requests(spark, folder), state.keys))
    found = scoring.request_features(valid, state)
    lags = [f"lag_{k}d" for k in asof.DAYS]
    kept = found.select("request_id", "key", "ds", "hour", *lags, "lags_available", "rolling_28d", "weekday", "day_of_year")
    return rounded(kept, 7, *lags, "rolling_28d")


@query(_FEATURES)
def request_features(spark, folder):
    return _features(spark, folder, serving_state(spark, folder))


@query(_FEATURES)
def dated_request_features(spark, folder):
    """The same from a state that is laid out by date: only the asked dates and months are opened."""
    return _features(spark, folder, serving_state(spark, folder, laid_out=True))
