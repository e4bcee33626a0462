"""History, calendar, encoding, split and fold queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from seasonflow.catalog.base import (
    HISTORY,
    HOLIDAYS,
    LONG,
    SPLIT,
    history,
    holidays,
    query,
    rounded,
    split_rows,
)
from seasonflow.operators import features, split
from seasonflow.operators.ordering import with_global_position
from seasonflow.session import settle
from seasonflow.sources import tables
from seasonflow.sources.tables import RETAIL
from seasonflow.spec import DAILY, SeriesSpec

ROLLED = ("rolling_7d", "rolling_28d", "rolling_7d_std")
FOLDS = ", ".join(f"('{n}', DATE '{a}', DATE '{b}', DATE '{c}', DATE '{d}')" for n, a, b, c, d in RETAIL.folds)
FOLD_CTE = f"folds(fold, train_first, train_last, test_first, test_last) AS (VALUES {FOLDS})"

DAILY_SQL = """
daily AS (SELECT CAST(o_orderdate AS DATE) AS ds, o_orderpriority AS key,
  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS y FROM orders GROUP BY 1, 2)"""


# ------------------------------------------------------------------ history


@query(
    f"""WITH {HISTORY} SELECT ds, key, hour, y, lag_1d, lag_7d, lag_14d, round(rolling_7d, 6) AS rolling_7d,
  round(rolling_28d, 6) AS rolling_28d, round(rolling_7d_std, 4) AS rolling_7d_std FROM hist"""
)
def history_features(spark, folder):
    df = history(spark, folder).select("ds", "key", "hour", "y", "lag_1d", "lag_7d", "lag_14d", *ROLLED)
    return rounded(rounded(df, 6, "rolling_7d", "rolling_28d"), 4, "rolling_7d_std")


@query(
    f"""WITH {DAILY_SQL} SELECT ds, key, lag(y, 1) OVER w AS lag_1d, lag(y, 7) OVER w AS lag_7d, lag(y, 14) OVER w AS lag_14d,
  round(CASE WHEN count(y) OVER w7 >= 3 THEN avg(y) OVER w7 END, 4) AS rolling_7d,
  round(CASE WHEN count(y) OVER w28 >= 14 THEN avg(y) OVER w28 END, 4) AS rolling_28d,
  round(CASE WHEN count(y) OVER w7 >= 3 THEN stddev_samp(y) OVER w7 END, 4) AS rolling_7d_std
FROM daily
WINDOW w AS (PARTITION BY key ORDER BY ds), w7 AS (PARTITION BY key ORDER BY ds ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING),
  w28 AS (PARTITION BY key ORDER BY ds ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING)"""
)
def orders_history(spark, folder):
    df = features.add_history(tables.orders_daily(spark, folder), DAILY, bounded=True)
    return rounded(df.select("ds", "key", "lag_1d", "lag_7d", "lag_14d", *ROLLED), 4, *ROLLED)


ITEM_ORDER = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
ITEM_SPEC = SeriesSpec(key="flag", ds="ds", hour="status", y="y")


@query(
    f"""SELECT flag, status, ds, l_orderkey, l_linenumber, l_partkey, y, lag(y, 1) OVER w AS lag_1d, lag(y, 7) OVER w AS lag_7d,
  lag(y, 14) OVER w AS lag_14d,
  round(CASE WHEN count(y) OVER w7 >= 3 THEN avg(y) OVER w7 END, 4) AS rolling_7d,
  round(CASE WHEN count(y) OVER w28 >= 14 THEN avg(y) OVER w28 END, 4) AS rolling_28d,
  round(CASE WHEN count(y) OVER w7 >= 3 THEN stddev_samp(y) OVER w7 END, 4) AS rolling_7d_std
FROM (SELECT *, l_returnflag AS flag, l_linestatus AS status, CAST(l_shipdate AS DATE) AS ds, l_quantity AS y FROM lineitem)
WINDOW w AS (PARTITION BY flag, status ORDER BY ds, {', '.join(ITEM_ORDER)}),
  w7 AS (PARTITION BY flag, status ORDER BY ds, {', '.join(ITEM_ORDER)} ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING),
  w28 AS (PARTITION BY flag, status ORDER BY ds, {', '.join(ITEM_ORDER)} ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING)"""
)
def item_history_in_blocks(spark, folder):
    """Six series hold all line items; their rows are cut into blocks of bounded size."""
    items = tables.table(spark, folder, "lineitem").select(
        F.col("l_returnflag").alias("flag"),
        F.col("l_linestatus").alias("status"),
        F.col("l_shipdate").cast("date").alias("ds"),
        *ITEM_ORDER,
        F.col("l_quantity").alias("y"),
    )
    df = features.add_history(items, ITEM_SPEC, order=ITEM_ORDER, block_rows=8192)
    kept = df.select("flag", "status", "ds", *ITEM_ORDER[:3], "y", "lag_1d", "lag_7d", "lag_14d", *ROLLED)
    return rounded(kept, 4, *ROLLED)


@query(
    f"""WITH {LONG} SELECT ds, key, hour, """
    + ", ".join(
        f"max(y) OVER (PARTITION BY key, hour ORDER BY ds RANGE BETWEEN INTERVAL {k} DAY PRECEDING"
        f" AND INTERVAL {k} DAY PRECEDING) AS calendar_lag_{k}d"
        for k in (1, 7, 14)
    )
    + " FROM long"
)
def calendar_lags(spark, folder):
    df = features.add_calendar_lags(tables.line_long(spark, folder), unique=True)
    return df.select("ds", "key", "hour", "calendar_lag_1d", "calendar_lag_7d", "calendar_lag_14d")


# Every hour of every day on which a type of event occurs; hours without events are null.
_EVENT_GRID = """
cells AS (SELECT CAST(ts AS DATE) AS ds, event_type AS key, CAST(hour(ts) AS INTEGER) AS hour,
  CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS y FROM events GROUP BY 1, 2, 3),
ev AS (SELECT d.ds, d.key, h.hour, c.y FROM (SELECT DISTINCT ds, key FROM cells) d
  CROSS JOIN (SELECT CAST(range AS INTEGER) AS hour FROM range(0, 24)) h
  LEFT JOIN cells c ON c.ds = d.ds AND c.key = d.key AND c.hour = h.hour)"""


@query(
    f"""WITH {_EVENT_GRID}, ops AS (SELECT key, hour, count(y) AS n FROM ev GROUP BY key, hour)
SELECT ev.ds, ev.key, ev.hour, CASE WHEN n = 0 THEN 0.0 ELSE y END AS y
FROM ev JOIN ops ON ops.key = ev.key AND ops.hour = ev.hour"""
)
def zero_fill(spark, folder):
    return features.zero_fill(tables.events_long(spark, folder))


@query(f"WITH {_EVENT_GRID} SELECT key, hour, count(y) AS n FROM ev GROUP BY key, hour HAVING count(y) > 0")
def operating_cells(spark, folder):
    return features.operating_cells(tables.events_long(spark, folder))


# ------------------------------------------------------------------ calendar

_DATES = "SELECT DISTINCT CAST(o_orderdate AS DATE) AS ds FROM orders"


@query(
    f"""SELECT ds, CAST(isodow(ds) - 1 AS INTEGER) AS weekday, CAST(month(ds) AS INTEGER) AS month, CAST(year(ds) AS INTEGER) AS year,
  CAST(dayofyear(ds) AS INTEGER) AS day_of_year, CAST(isodow(ds) >= 6 AS INTEGER) AS is_weekend,
  CAST(weekofyear(ds) AS INTEGER) AS iso_week, CAST(year(ds) - 1995 AS INTEGER) AS year_trend FROM ({_DATES})"""
)
def calendar_parts(spark, folder):
    dates = tables.orders_daily(spark, folder).select("ds").distinct()
    return features.add_calendar(dates, DAILY, RETAIL.trend_base)


@query(f"WITH {HOLIDAYS} SELECT ds, holiday, is_bridge FROM hol WHERE ds IN ({_DATES})")
def holiday_calendar(spark, folder):
    dates = tables.orders_daily(spark, folder).select("ds").distinct()
    return holidays(spark).join(dates, "ds", "left_semi")


@query(
    f"""WITH {HOLIDAYS}, {DAILY_SQL.strip()} SELECT d.ds, d.key, CAST(h.ds IS NOT NULL AS INTEGER) AS is_holiday,
  coalesce(h.is_bridge, 0) AS is_bridge FROM daily d LEFT JOIN hol h ON h.ds = d.ds"""
)
def holiday_flags(spark, folder):
    df = features.add_holidays(tables.orders_daily(spark, folder), holidays(spark), DAILY)
    return df.select("ds", "key", "is_holiday", "is_bridge")


_CYCLE = ", ".join(
    f"round({f}(2 * pi() * {c} / {p}), 6) + 0.0 AS {n}_{f}"
    for n, c, p in (("hour", "hour", 24), ("weekday", "(isodow(ds) - 1)", 7), ("month", "month(ds)", 12))
    for f in ("sin", "cos")
)


@query(
    f"""WITH {LONG} SELECT ds, key, hour, {_CYCLE}, CAST(hour * (isodow(ds) - 1) AS INTEGER) AS hour_x_weekday,
  CAST(hour BETWEEN 6 AND 9 AS INTEGER) AS is_morning_peak, CAST(hour BETWEEN 17 AND 19 AS INTEGER) AS is_evening_peak FROM long"""
)
def cyclic_and_peaks(spark, folder):
    dated = features.add_calendar(tables.line_long(spark, folder), trend_base=RETAIL.trend_base)
    df = features.add_interactions(features.add_cyclic(dated))
    waves = [f"{n}_{f}" for n in ("hour", "weekday", "month") for f in ("sin", "cos")]
    kept = rounded(df, 6, *waves).withColumns({w: F.col(w) + F.lit(0.0) for w in waves})
    return kept.select("ds", "key", "hour", *waves, "hour_x_weekday", "is_morning_peak", "is_evening_peak")


# ------------------------------------------------------------------ encoding


@query("SELECT DISTINCT o_orderpriority AS value, CAST(dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS INTEGER) AS code FROM orders")
def label_codes(spark, folder):
    return features.label_codes(tables.table(spark, folder, "orders"), "o_orderpriority")


_CODED = f"""WITH {LONG},
kk AS (SELECT key, row_number() OVER (ORDER BY key) - 1 AS code FROM (SELECT DISTINCT key FROM long)),
kt AS (SELECT kind, row_number() OVER (ORDER BY kind) - 1 AS code FROM (SELECT DISTINCT kind FROM long WHERE kind IS NOT NULL))"""


@query(
    f"""{_CODED} SELECT l.ds, l.key, l.hour, CAST(kk.code AS INTEGER) AS key_code, CAST(kt.code AS INTEGER) AS kind_code,
  CAST(coalesce(l.kind = 'accepted', false) AS INTEGER) AS is_rail
FROM long l JOIN kk ON kk.key = l.key LEFT JOIN kt ON kt.kind = l.kind"""
)
def label_encoding(spark, folder):
    df, _, _ = features.add_encoding(tables.line_long(spark, folder), RETAIL.rail_kind)
    return df.select("ds", "key", "hour", "key_code", "kind_code", "is_rail")


@query(
    f"""{_CODED} SELECT 'key' AS encoder, key AS value, CAST(code AS INTEGER) AS code FROM kk
UNION ALL SELECT 'kind', kind, CAST(code AS INTEGER) FROM kt"""
)
def encoder_maps(spark, folder):
    long = tables.line_long(spark, folder)
    return features.encoder_table(features.label_codes(long, "key"), features.label_codes(long, "kind"))


@query("SELECT o_orderkey AS id, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) - 1 AS position FROM orders")
def distributed_row_number(spark, folder):
    """Positions over a whole table from a range sort, not from one task."""
    orders = tables.table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"), (-F.col("o_totalprice")).alias("v")
    )
    return with_global_position(orders, ["v", "id"]).select("id", "position")


# ------------------------------------------------------------------ features in full


def featured(spark, folder):
    return features.build_features(
        tables.line_long(spark, folder), holidays(spark), RETAIL.rail_kind, RETAIL.trend_base, bounded=True
    )[0]


@query(
    f"""WITH {HISTORY}, {HOLIDAYS.strip()},
kk AS (SELECT key, row_number() OVER (ORDER BY key) - 1 AS code FROM (SELECT DISTINCT key FROM long)),
kt AS (SELECT kind, row_number() OVER (ORDER BY kind) - 1 AS code FROM (SELECT DISTINCT kind FROM long WHERE kind IS NOT NULL)),
ops AS (SELECT key, hour, count(y) AS n FROM long GROUP BY key, hour)
SELECT f.ds, f.key, f.hour, CASE WHEN ops.n = 0 THEN 0.0 ELSE f.y END AS y, lag_1d, lag_7d, round(rolling_28d, 6) AS rolling_28d,
  CAST(f.weekday AS INTEGER) AS weekday, CAST(h.ds IS NOT NULL AS INTEGER) AS is_holiday, coalesce(h.is_bridge, 0) AS is_bridge,
  CAST(kk.code AS INTEGER) AS key_code, CAST(kt.code AS INTEGER) AS kind_code,
  CAST(f.hour * f.weekday AS INTEGER) AS hour_x_weekday
FROM hist f JOIN ops ON ops.key = f.key AND ops.hour = f.hour JOIN kk ON kk.key = f.key
LEFT JOIN kt ON kt.kind = f.kind LEFT JOIN hol h ON h.ds = f.ds"""
)
def featured_table(spark, folder):
    df = featured(spark, folder).select(
        "ds", "key", "hour", "y", "lag_1d", "lag_7d", "rolling_28d", "weekday", "is_holiday", "is_bridge",
        "key_code", "kind_code", "hour_x_weekday",
    )
    return rounded(df, 6, "rolling_28d")


_CORR = ("lag_1d", "lag_7d", "lag_14d", "rolling_7d", "rolling_28d", "rolling_7d_std", "weekday", "hour", "month", "year")


@query(
    f"WITH {HISTORY}, f AS (SELECT *, month(ds) AS month, year(ds) AS year FROM hist) SELECT feature, round(r, 4) AS r FROM ("
    + " UNION ALL ".join(f"SELECT '{c}' AS feature, corr({c}, y) AS r FROM f" for c in _CORR)
    + ") WHERE r IS NOT NULL AND NOT isnan(r) ORDER BY abs(r) DESC, feature LIMIT 5"
)
def feature_correlations(spark, folder):
    return rounded(features.correlations(history(spark, folder), features=_CORR, top=5), 4, "r")


@query(
    f"""WITH {HISTORY} SELECT count(*) AS rows, count(*) FILTER (WHERE lag_1d IS NULL OR lag_7d IS NULL OR lag_14d IS NULL
  OR rolling_7d IS NULL OR rolling_28d IS NULL) AS rows_with_null,
  round(count(*) FILTER (WHERE lag_1d IS NULL OR lag_7d IS NULL OR lag_14d IS NULL
  OR rolling_7d IS NULL OR rolling_28d IS NULL) * 100.0 / count(*), 6) AS null_pct FROM hist"""
)
def null_history_rows(spark, folder):
    return rounded(features.null_history(history(spark, folder)), 6, "null_pct")


@query(f"WITH {LONG} SELECT CAST(year(ds) AS VARCHAR) AS year, count(y) AS n FROM long GROUP BY 1")
def log_target(spark, folder):
    """log1p and back leaves every value: counted by year."""
    long = tables.line_long(spark, folder)
    back = F.greatest(F.expm1(F.greatest(F.log1p("y"), F.lit(0.0))), F.lit(0.0))
    same = F.abs(back - F.col("y")) < 1e-6
    return long.groupBy(F.year("ds").cast("string").alias("year")).agg(F.count_if(same).alias("n"))


# ------------------------------------------------------------------ split and folds


@query(f"WITH {SPLIT} SELECT split, count(*) AS rows, min(ds) AS first, max(ds) AS last FROM usable GROUP BY split")
def temporal_split_report(spark, folder):
    return split.split_report(split_rows(spark, folder))


@query(f"WITH {SPLIT} SELECT ds, key, hour, split FROM usable")
def temporal_split_rows(spark, folder):
    return split_rows(spark, folder).select("ds", "key", "hour", "split")


@query(
    f"""WITH {SPLIT}, {FOLD_CTE} SELECT fold, 'train' AS part, count(*) AS rows, count(DISTINCT ds) AS days
FROM usable JOIN folds ON ds BETWEEN train_first AND train_last GROUP BY fold
UNION ALL SELECT fold, 'test', count(*), count(DISTINCT ds) FROM usable JOIN folds ON ds BETWEEN test_first AND test_last GROUP BY fold"""
)
def fold_rows(spark, folder):
    rows = split.usable(history(spark, folder)).select("ds")
    parts = [split.fold_rows(rows, RETAIL.folds, p).withColumn("part", F.lit(p)) for p in ("train", "test")]
    return parts[0].unionByName(parts[1]).groupBy("fold", "part").agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("ds").alias("days")
    )


@query(
    f"""WITH {SPLIT}, {FOLD_CTE}, sized AS (
  SELECT fold, CAST(count(*) FILTER (WHERE ds BETWEEN train_first AND train_last) AS BIGINT) AS train_rows,
    CAST(count(*) FILTER (WHERE ds BETWEEN test_first AND test_last) AS BIGINT) AS test_rows
  FROM folds LEFT JOIN usable ON true GROUP BY fold)
SELECT *, train_rows >= 500 AND test_rows >= 100 AS kept FROM sized"""
)
def fold_sizes(spark, folder):
    return split.fold_sizes(split.usable(history(spark, folder)), RETAIL.folds)


@query(
    f"""WITH {SPLIT}, {FOLD_CTE}, placed AS (
  SELECT fold, ds, key, hour, row_number() OVER (PARTITION BY fold ORDER BY ds, key, hour) - 1 AS pos,
    count(*) OVER (PARTITION BY fold) AS n
  FROM usable JOIN folds ON ds BETWEEN train_first AND train_last)
SELECT fold, ds, key, hour, pos >= floor(n * 0.8) AS is_val FROM placed"""
)
def positional_tail(spark, folder):
    rows = settle(split.usable(history(spark, folder)).select("ds", "key", "hour"))
    return split.tail_split(rows, RETAIL.folds)


@query(
    f"""WITH {SPLIT}, sized AS (SELECT key, count(*) FILTER (WHERE split = 'train') AS train_rows,
  count(*) FILTER (WHERE split = 'val') AS val_rows FROM usable GROUP BY key)
SELECT *, train_rows >= 100 AND val_rows >= 10 AS kept FROM sized"""
)
def key_sizes(spark, folder):
    return split.key_sizes(split_rows(spark, folder))
