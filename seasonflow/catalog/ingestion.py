"""Sources, cleaning, reshaping and the quality audit."""

from __future__ import annotations

from pyspark.sql import functions as F

from seasonflow.catalog.base import CELLS, LONG, PREDICTIONS, long_count, predictions, query, rounded
from seasonflow.functions import cleaning
from seasonflow.operators import audit, ingest
from seasonflow.session import scratch_path
from seasonflow.sources import readers, sinks, tables
from seasonflow.sources.tables import RETAIL

STATED = """
stated AS (SELECT ds, key, SUM(CAST(y AS DECIMAL(18,2))) + CASE WHEN day(ds) = 1 THEN 50 ELSE 0 END AS total
           FROM cells GROUP BY ds, key)"""
DAYS = f"WITH {CELLS},{STATED}"
SWAPPED = """CASE WHEN year(ds) >= 2000 AND day(ds) <= 12 THEN make_date(year(ds), day(ds), month(ds)) ELSE ds END"""


# ------------------------------------------------------------------ scans


@query("SELECT o_orderpriority AS key, count(*) AS rows FROM orders GROUP BY 1")
def parquet_scan(spark, folder):
    return readers.read_parquet(spark, f"{folder}/orders.parquet").groupBy(
        F.col("o_orderpriority").alias("key")
    ).agg(F.count(F.lit(1)).alias("rows"))


@query("SELECT l_returnflag AS flag, CAST(sum(l_quantity) AS DOUBLE) AS quantity FROM lineitem GROUP BY 1")
def column_pruned_scan(spark, folder):
    df = readers.read_parquet(spark, f"{folder}/lineitem.parquet", ["l_returnflag", "l_quantity"])
    return df.groupBy(F.col("l_returnflag").alias("flag")).agg(F.sum("l_quantity").alias("quantity"))


@query(DAYS + " SELECT key, count(*) AS days, CAST(sum(total) AS DOUBLE) AS total FROM stated GROUP BY key")
def wide_csv_scan(spark, folder):
    path = scratch_path(spark, "wide-csv")
    sinks.write_csv(tables.wide_raw(spark, folder), path)
    wide = readers.read_wide_csv(spark, path, RETAIL)
    total = cleaning.number(F.col("TOTAL")).cast("decimal(18,2)")
    return wide.groupBy(F.col("LINE").alias("key")).agg(
        F.count(F.lit(1)).alias("days"), F.sum(total).cast("double").alias("total")
    )


@query(
    f"WITH {PREDICTIONS} SELECT ds, key, hour, model, round(real, 4) AS real, round(pred, 4) AS pred, "
    "strftime(ds, '%Y-%m') AS month FROM preds"
)
def predictions_csv_scan(spark, folder):
    path = scratch_path(spark, "predictions-csv")
    kept = predictions(spark, folder).select("ds", F.concat(F.lit(" "), "key").alias("key"), "hour", "real", "pred", "abs_err", "model")
    sinks.write_csv(kept, path)
    back = readers.read_predictions_csv(spark, path).drop("abs_err")
    return rounded(back, 4, "real", "pred")


@query(f"WITH {LONG} SELECT ds, key, kind, hour, y, year(ds) AS year_part FROM long")
def trusted_parquet_round_trip(spark, folder):
    path = scratch_path(spark, "trusted")
    sinks.write_by_year(tables.line_long(spark, folder), path)
    back = readers.read_parquet(spark, path)
    return back.select("ds", "key", "kind", "hour", "y", long_count("year_part").alias("year_part"))


@query(f"WITH {PREDICTIONS} SELECT model, count(*) AS rows, round(sum(abs_err), 2) AS abs_err FROM preds GROUP BY model")
def predictions_parquet_round_trip(spark, folder):
    path = scratch_path(spark, "predictions")
    sinks.write_predictions(predictions(spark, folder), path)
    back = readers.read_parquet(spark, path, ["model", "abs_err"])
    return back.groupBy("model").agg(
        F.count(F.lit(1)).alias("rows"), F.round(F.sum("abs_err"), 2).alias("abs_err")
    )


@query(f"WITH {LONG} SELECT key, hour, count(y) AS n FROM long GROUP BY key, hour")
def json_round_trip(spark, folder):
    counts = tables.line_long(spark, folder).groupBy("key", "hour").agg(F.count("y").alias("n"))
    return sinks.write_json(counts, scratch_path(spark, "json"))


@query(
    f"""WITH {LONG} SELECT 'trusted' AS name, count(*) AS rows, 'ok' AS status FROM long
UNION ALL SELECT 'featured', NULL, 'skip'
UNION ALL SELECT 'summary', count(DISTINCT key), 'ok' FROM long"""
)
def publish_manifest(spark, folder):
    long = tables.line_long(spark, folder)
    items = [
        sinks.Artefact("trusted", long.withColumn("year", F.year("ds")), "trusted", partition=["year"]),
        sinks.Artefact("featured", None, "refined/features"),
        sinks.Artefact("summary", audit.summary_by_key(long), "refined/summary", layout="csv"),
    ]
    report = sinks.publish(spark, items, scratch_path(spark, "published"))
    return report.select("name", "rows", "status")


# ------------------------------------------------------------------ cleaning


@query(DAYS + f" SELECT {SWAPPED} AS ds, key, CAST(total AS DOUBLE) AS total FROM stated")
def dates_two_pass(spark, folder):
    dated = ingest.parse_dates(tables.wide_raw(spark, folder), RETAIL, policy="two_pass")
    return ingest.clean_numbers(dated, ["TOTAL"]).select("ds", F.col("LINE").alias("key"), F.col("TOTAL").alias("total"))


@query(DAYS + " SELECT ds, key, CAST(total AS DOUBLE) AS total FROM stated")
def dates_by_rule(spark, folder):
    dated = ingest.parse_dates(tables.wide_raw(spark, folder), RETAIL)
    return ingest.clean_numbers(dated, ["TOTAL"]).select("ds", F.col("LINE").alias("key"), F.col("TOTAL").alias("total"))


@query(
    DAYS
    + """ SELECT count(*) AS rows,
  count(*) FILTER (WHERE year(ds) >= 2000 AND day(ds) > 12) AS null_after_first,
  CAST(0 AS BIGINT) AS null_after_second, CAST(0 AS BIGINT) AS null_by_rule,
  count(*) FILTER (WHERE day(ds) <= 12 AND day(ds) <> month(ds)) AS ambiguous,
  count(*) FILTER (WHERE year(ds) >= 2000 AND day(ds) <= 12 AND day(ds) <> month(ds)) AS exchanged
FROM stated"""
)
def date_parse_audit(spark, folder):
    return ingest.date_audit(tables.wide_raw(spark, folder), RETAIL)


@query(
    """SELECT DISTINCT CASE WHEN day(o_orderdate) = 29 THEN strftime(o_orderdate, '%Y-13-%d')
  ELSE strftime(o_orderdate, '%Y-%m-%d') END AS raw_date FROM orders"""
)
def unparsed_date_texts(spark, folder):
    texts = tables.order_requests(spark, folder).select(F.col("date").alias("DAY"))
    return ingest.unparsed_dates(texts, RETAIL)


@query(f"WITH {LONG} SELECT ds, key, hour, y FROM long")
def numbers_and_unpivot(spark, folder):
    return ingest.trusted_table(tables.wide_raw(spark, folder), RETAIL).select("ds", "key", "hour", "y")


@query(
    f"""WITH {LONG},{STATED}
SELECT l.ds, l.key, l.kind, l.hour, l.y, CAST(s.total AS DOUBLE) AS total,
  CASE WHEN year(l.ds) < 2000 THEN strftime(l.ds, '%-d/%-m/%Y') ELSE strftime(l.ds, '%-m/%-d/%Y ') END AS raw_date
FROM long l JOIN stated s ON s.ds = l.ds AND s.key = l.key"""
)
def trusted_table(spark, folder):
    return ingest.trusted_table(tables.wide_raw(spark, folder), RETAIL)


@query(f"WITH {LONG} SELECT ds, key, kind, hour FROM long WHERE y IS NOT NULL")
def type_lookup(spark, folder):
    return ingest.add_type(tables.line_cells(spark, folder), RETAIL.types).select("ds", "key", "kind", "hour")


@query(f"WITH {LONG} SELECT DISTINCT key FROM long WHERE kind IS NULL")
def unmapped_keys(spark, folder):
    return ingest.unmapped_keys(tables.line_cells(spark, folder), RETAIL.types)


@query(f"WITH {LONG} SELECT ds, key, hour, y FROM long WHERE y IS NOT NULL AND kind IS NOT NULL")
def drop_null_rows(spark, folder):
    return tables.line_long(spark, folder).na.drop(subset=["y", "kind"]).select("ds", "key", "hour", "y")


@query(
    f"""WITH {PREDICTIONS} SELECT ds, key, hour, real, round(pred, 4) AS pred FROM preds
WHERE key IN ('AF', 'RO', 'NO') AND ds BETWEEN DATE '2001-02-01' AND DATE '2001-09-30'
  AND hour BETWEEN 2 AND 6 AND model = 'Roll7'"""
)
def explorer_filter(spark, folder):
    kept = ingest.explore(predictions(spark, folder), ["AF", "RO", "NO"], "2001-02-01", "2001-09-30", (2, 6), "Roll7")
    return rounded(kept.select("ds", "key", "hour", "real", "pred"), 4, "pred")


@query("SELECT o_orderkey AS id, o_totalprice AS v FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')")
def membership_filter(spark, folder):
    orders = tables.table(spark, folder, "orders")
    return orders.where(ingest.in_any(F.col("o_orderpriority"), ["1-URGENT", "2-HIGH"])).select(
        F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("v")
    )


@query("SELECT o_orderkey AS id, upper(trim(' r' || lower(o_orderstatus) || ' ')) AS line FROM orders")
def key_normalise(spark, folder):
    return tables.order_requests(spark, folder).select(
        F.col("request_id").alias("id"), cleaning.match_key(F.col("line")).alias("line")
    )


@query("SELECT DISTINCT l_returnflag AS flag, l_linestatus AS status FROM lineitem")
def distinct_pairs(spark, folder):
    return (
        tables.table(spark, folder, "lineitem")
        .select(F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("status"))
        .distinct()
        .orderBy("flag", "status")
    )


@query(f"WITH {LONG} SELECT ds, key, hour, y FROM long ORDER BY ds, key, hour")
def sorted_trusted(spark, folder):
    return tables.line_long(spark, folder).select("ds", "key", "hour", "y").orderBy("ds", "key", "hour")


# ------------------------------------------------------------------ audit


@query(
    """SELECT CAST(y.year AS INTEGER) AS year, min(CAST(o_orderdate AS DATE)) AS first, max(CAST(o_orderdate AS DATE)) AS last,
  count(DISTINCT CAST(o_orderdate AS DATE)) AS days, min(o_orderdate) IS NULL AS no_data
FROM (SELECT range AS year FROM range(1994, 2002)) y
LEFT JOIN orders o ON year(o.o_orderdate) = y.year GROUP BY 1"""
)
def audit_dates_by_year(spark, folder):
    return audit.dates_by_year(tables.orders_daily(spark, folder), range(1994, 2002))


@query(
    """WITH q AS (SELECT quantile_cont(l_extendedprice, 0.999) AS q FROM lineitem)
SELECT round(q, 6) AS "limit", count(*) FILTER (WHERE l_extendedprice < 0) AS negative,
  count(*) FILTER (WHERE l_extendedprice > q) AS above,
  round(count(*) FILTER (WHERE l_extendedprice > q) * 100.0 / count(*), 6) AS above_pct
FROM lineitem, q GROUP BY q"""
)
def audit_value_outliers(spark, folder):
    found = audit.value_outliers(tables.table(spark, folder, "lineitem"), "l_extendedprice")
    return rounded(found, 6, "limit", "above_pct")


@query(f"WITH {LONG} SELECT ds, key, hour, y FROM long WHERE y > (SELECT quantile_cont(y, 0.999) FROM long) ORDER BY y DESC, ds, key, hour LIMIT 5")
def audit_top_outliers(spark, folder):
    return audit.top_outliers(tables.line_long(spark, folder))


@query(
    f"""WITH {LONG} SELECT key, round(avg(CAST(y IS NULL AS INTEGER)) * 100, 6) AS missing_pct,
  avg(CAST(y IS NULL AS INTEGER)) > 0.2 AS flagged FROM long GROUP BY key"""
)
def audit_missing_by_key(spark, folder):
    return rounded(audit.missing_by_key(tables.line_long(spark, folder)), 6, "missing_pct")


def _compared(spark, folder):
    wide = tables.wide_raw(spark, folder)
    trusted = ingest.trusted_table(wide, RETAIL)
    dated = ingest.clean_numbers(ingest.parse_dates(wide, RETAIL), ["TOTAL"])
    return audit.compare_totals(trusted, dated.select("ds", F.col("LINE").alias("key"), F.col("TOTAL").alias("total")))


_DIFF = """, summed AS (SELECT ds, key, sum(CAST(y AS DECIMAL(18,2))) AS computed FROM cells GROUP BY ds, key),
diffs AS (SELECT s.ds, s.key, CAST(computed AS DOUBLE) AS computed, CAST(total AS DOUBLE) AS total,
  CAST(abs(computed - total) AS DOUBLE) AS diff FROM summed s JOIN stated t ON t.ds = s.ds AND t.key = s.key)"""


@query(
    DAYS + _DIFF + """ SELECT count(*) AS compared, count(*) FILTER (WHERE diff > 10) AS mismatches,
  round(max(diff), 4) AS max_diff FROM diffs"""
)
def audit_total_mismatches(spark, folder):
    return rounded(audit.total_mismatches(_compared(spark, folder)), 4, "max_diff")


@query(
    DAYS + _DIFF + """ SELECT ds, key, round(computed, 2) AS computed, round(total, 2) AS total, round(diff, 2) AS diff
FROM diffs WHERE diff > 10 ORDER BY ds, key LIMIT 3"""
)
def audit_mismatch_sample(spark, folder):
    return rounded(audit.mismatch_sample(_compared(spark, folder)), 2, "computed", "total", "diff")


@query(f"WITH {CELLS} SELECT key, string_agg(DISTINCT CAST(year(ds) AS VARCHAR), ',' ORDER BY CAST(year(ds) AS VARCHAR)) AS years FROM cells GROUP BY key")
def audit_years_by_key(spark, folder):
    years = audit.years_by_key(tables.line_cells(spark, folder))
    return years.select("key", F.array_join(F.col("years").cast("array<string>"), ",").alias("years"))


@query(
    f"""WITH {LONG} SELECT count(*) FILTER (WHERE y = 0) AS zeros, round(count(*) FILTER (WHERE y = 0) * 100.0 / count(*), 6) AS zeros_pct,
  count(*) - count(y) AS missing, round((count(*) - count(y)) * 100.0 / count(*), 6) AS missing_pct FROM long"""
)
def audit_zeros_and_missing(spark, folder):
    return rounded(audit.zeros_and_missing(tables.line_long(spark, folder)), 6, "zeros_pct", "missing_pct")


@query(f"WITH {LONG} SELECT hour, count(*) AS missing FROM long WHERE y IS NULL GROUP BY hour ORDER BY missing DESC, hour LIMIT 5")
def audit_top_missing_hours(spark, folder):
    return audit.top_missing_hours(tables.line_long(spark, folder))


@query(
    """SELECT l_returnflag AS kind, round(avg(l_extendedprice), 4) AS mean, round(quantile_cont(l_extendedprice, 0.5), 4) AS median,
  max(l_extendedprice) AS max, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS sum FROM lineitem GROUP BY 1"""
)
def summary_by_kind(spark, folder):
    items = tables.table(spark, folder, "lineitem").withColumnRenamed("l_returnflag", "kind")
    return rounded(rounded(audit.summary_by_kind(items, y="l_extendedprice"), 4, "mean", "median"), 2, "sum")


@query(f"WITH {LONG} SELECT key, count(y) AS rows, round(avg(y), 4) AS mean, max(y) AS max FROM long GROUP BY key")
def summary_by_key(spark, folder):
    return rounded(audit.summary_by_key(tables.line_long(spark, folder)), 4, "mean")


@query(
    f"""WITH {LONG} SELECT count(*) AS rows, min(ds) AS first, max(ds) AS last, count(DISTINCT key) AS keys,
  string_agg(DISTINCT CAST(hour AS VARCHAR), ',' ORDER BY CAST(hour AS VARCHAR)) AS hours FROM long"""
)
def overview(spark, folder):
    found = audit.overview(tables.line_long(spark, folder))
    return found.withColumn("hours", F.array_join(F.col("hours").cast("array<string>"), ","))
