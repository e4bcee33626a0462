from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from seasonflow.functions import cleaning
from seasonflow.functions.holidays import holiday_table
from seasonflow.operators import audit, ingest
from seasonflow.spec import TRANSIT


def texts(spark, values):
    return spark.createDataFrame([(v,) for v in values], "DIA string")


def test_both_date_policies(spark):
    df = texts(spark, ["25/12/2024", "3/25/2025", "3/5/2025", "9/12/2025", "", "99/99/2025", "1/2/2024 "])
    got = {
        r["DIA"]: (r["two"], r["rule"])
        for r in df.select(
            "DIA",
            cleaning.two_pass_date(F.col("DIA")).alias("two"),
            cleaning.date_by_rule(F.col("DIA"), TRANSIT.date_rules).alias("rule"),
        ).collect()
    }
    assert got["25/12/2024"] == (date(2024, 12, 25), date(2024, 12, 25))
    assert got["3/25/2025"] == (date(2025, 3, 25), date(2025, 3, 25))
    assert got["3/5/2025"] == (date(2025, 5, 3), date(2025, 3, 5))
    assert got["9/12/2025"] == (date(2025, 12, 9), date(2025, 9, 12))
    assert got[""] == (None, None)
    assert got["99/99/2025"] == (None, None)
    assert got["1/2/2024 "] == (date(2024, 2, 1), date(2024, 2, 1))


def test_two_pass_exchanges_day_and_month(spark):
    days = [date(2025, 1, 1) + timedelta(days=i) for i in range(273)]
    df = texts(spark, [f"{d.month}/{d.day}/{d.year}" for d in days])
    audited = ingest.date_audit(df, TRANSIT).first()
    assert audited["rows"] == 273
    assert audited["null_after_second"] == 0 and audited["null_by_rule"] == 0
    assert audited["exchanged"] == audited["ambiguous"] == 99
    latest = ingest.parse_dates(df, TRANSIT, "two_pass").agg(F.max("ds")).first()[0]
    assert latest == date(2025, 12, 9)
    right = {r["ds"] for r in ingest.parse_dates(df, TRANSIT).select("ds").collect()}
    assert right == set(days)


def test_unknown_policy(spark):
    with pytest.raises(ValueError):
        ingest.parse_dates(texts(spark, ["1/1/2024"]), TRANSIT, "guess")


def test_numbers_become_null_never_nan(spark):
    df = spark.createDataFrame([(v,) for v in ["1,234", " 5 ", "", "nan", "None", "x", None, "-2.5", "NaN"]], "t string")
    got = [r["v"] for r in df.select(cleaning.number(F.col("t")).alias("v")).collect()]
    assert got == [1234.0, 5.0, None, None, None, None, None, -2.5, None]


def test_holidays_of_four_years(spark):
    rows = holiday_table(spark, [2023, 2024, 2025, 2026]).collect()
    per_year = {y: sum(r["ds"].year == y for r in rows) for y in (2023, 2024, 2025, 2026)}
    assert per_year == {2023: 18, 2024: 18, 2025: 17, 2026: 18}
    by_date = {r["ds"]: r for r in rows}
    assert by_date[date(2025, 6, 30)]["holiday"] == "Sagrado Corazón; San Pedro y San Pablo"
    assert by_date[date(2025, 4, 18)]["holiday"] == "Viernes Santo"
    assert by_date[date(2025, 1, 6)]["is_bridge"] == 1 and by_date[date(2025, 1, 1)]["is_bridge"] == 0
    assert by_date[date(2024, 1, 8)]["holiday"] == "Día de los Reyes Magos"


def test_unpivot_keeps_missing_and_types_unknown_keys(spark):
    columns = TRANSIT.raw_columns()
    row = {c: None for c in columns} | {"DIA": "2/1/2024", "LINEA": "LÍNEA A", "4:00": "1,000.5", "23:00": "nan", "TOTAL": "1,000.5"}
    other = {c: None for c in columns} | {"DIA": "2/1/2024", "LINEA": "LÍNEA Z", "TOTAL": "20", "5:00": "3"}
    wide = spark.createDataFrame(
        [tuple(r[c] for c in columns) for r in (row, other)], ", ".join(f"`{c}` string" for c in columns)
    )
    trusted = ingest.trusted_table(wide, TRANSIT)
    rows = trusted.collect()
    assert len(rows) == 2 * 20
    assert {r["hour"] for r in rows} == set(range(4, 24))
    cell = {(r["key"], r["hour"]): r for r in rows}
    assert cell["LÍNEA A", 4]["y"] == 1000.5 and cell["LÍNEA A", 23]["y"] is None
    assert cell["LÍNEA A", 4]["kind"] == "metro_ferreo" and cell["LÍNEA Z", 5]["kind"] is None
    assert [r["key"] for r in ingest.unmapped_keys(trusted, TRANSIT.types).collect()] == ["LÍNEA Z"]
    compared = audit.compare_totals(trusted, trusted.select("ds", "key", "total").distinct())
    found = audit.total_mismatches(compared).first()
    assert (found["compared"], found["mismatches"], found["max_diff"]) == (2, 1, 17.0)
    assert audit.mismatch_sample(compared).first()["key"] == "LÍNEA Z"


def test_audits_of_planted_defects(spark):
    days = [date(2024, 1, 1) + timedelta(days=i) for i in range(10)]
    rows = [(d, "A", "k", h, None if h == 5 else float(i * 10 + h)) for i, d in enumerate(days) for h in (4, 5, 6)]
    rows += [(days[0], "B", "k", 4, -1.0), (days[1], "B", "k", 4, 0.0), (days[2], "B", None, 4, None)]
    long = spark.createDataFrame(rows, "ds date, key string, kind string, hour int, y double")
    years = {r["year"]: r for r in audit.dates_by_year(long, [2023, 2024]).collect()}
    assert years[2023]["no_data"] and years[2023]["days"] == 0
    assert years[2024]["days"] == 10 and years[2024]["first"] == days[0]
    outliers = audit.value_outliers(long).first()
    assert outliers["negative"] == 1 and outliers["above"] == 1
    assert audit.top_outliers(long).first()["y"] == 96.0
    missing = {r["key"]: r for r in audit.missing_by_key(long).collect()}
    assert missing["A"]["flagged"] and missing["B"]["flagged"]
    both = audit.zeros_and_missing(long).first()
    assert (both["zeros"], both["missing"]) == (1, 11)
    assert audit.top_missing_hours(long).first().asDict() == {"hour": 5, "missing": 10}
    kinds = audit.summary_by_kind(long).collect()
    assert [r["kind"] for r in kinds] == ["k"]


def test_all_missing_group_sums(spark):
    long = spark.createDataFrame([("A", None), ("A", None)], "key string, y double").withColumn("kind", F.lit("k"))
    row = audit.summary_by_kind(long).first()
    assert row["sum"] == 0.0 and row["mean"] is None and row["median"] is None
