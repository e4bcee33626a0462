from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from seasonflow.session import scratch_path, scratch_scope, settle, shared_dir
from seasonflow.sources import readers, sinks
from seasonflow.spec import TRANSIT


def test_wide_csv_with_mark_and_other_column_order(spark, folder):
    names = ["LINEA", "TOTAL", *TRANSIT.hour_columns()[::-1], "DIA"]
    line = ["LÍNEA A", "1,234", *["7"] * 20, "1/2/2024"]
    quoted = ",".join(f'"{v}"' for v in line)
    Path(folder, "raw.csv").write_text("﻿" + ",".join(names) + "\n" + quoted + "\n", encoding="utf-8")
    wide = readers.read_wide_csv(spark, f"{folder}/raw.csv", TRANSIT)
    assert wide.columns == TRANSIT.raw_columns()
    row = wide.first()
    assert row["DIA"] == "1/2/2024" and row["LINEA"] == "LÍNEA A" and row["TOTAL"] == "1,234" and row["4:00"] == "7"


def test_mark_before_the_first_column(spark, folder):
    Path(folder, "raw.csv").write_text("﻿" + ",".join(TRANSIT.raw_columns()) + "\n" + "1/2/2024,L" + ",1" * 21 + "\n", encoding="utf-8")
    assert readers.read_wide_csv(spark, f"{folder}/raw.csv", TRANSIT).first()["DIA"] == "1/2/2024"


def test_files_whose_columns_are_in_another_order_are_refused(spark, folder):
    Path(folder, "raw").mkdir()
    for i, names in enumerate((TRANSIT.raw_columns(), TRANSIT.raw_columns()[::-1])):
        Path(folder, "raw", f"{i}.csv").write_text(",".join(names) + "\n" + ",".join("7" for _ in names) + "\n")
    with pytest.raises(Exception, match="CSV header"):
        readers.read_wide_csv(spark, f"{folder}/raw", TRANSIT).collect()


def test_scratch_goes_with_its_scope(spark):
    with scratch_scope(spark) as outer:
        kept = settle(spark.range(5))
        with scratch_scope(spark) as inner:
            assert inner.startswith(outer) and settle(spark.range(3)).count() == 3
        assert kept.count() == 5
        assert len(list(Path(outer.removeprefix("file:")).iterdir())) == 1
    assert not Path(outer.removeprefix("file:")).exists()
    assert not settle(spark.range(2)).inputFiles()[0].count("scope-")


def test_missing_columns(spark, folder):
    Path(folder, "raw.csv").write_text("DIA,LINEA,4:00\n1/2/2024,L,3\n")
    row = readers.read_wide_csv(spark, f"{folder}/raw.csv", TRANSIT).first()
    assert row["4:00"] == "3" and row["5:00"] is None and row["TOTAL"] is None
    Path(folder, "bad.csv").write_text("X,Y\n1,2\n")
    with pytest.raises(ValueError):
        readers.read_wide_csv(spark, f"{folder}/bad.csv", TRANSIT)


def test_year_partitions_prune(spark, folder):
    df = spark.createDataFrame(
        [(date(y, 1, d), "k", 4, float(d)) for y in (2023, 2024) for d in (1, 2, 3)], "ds date, key string, hour int, y double"
    )
    sinks.write_by_year(df, f"{folder}/t")
    assert {p.name for p in Path(folder, "t").glob("year_part=*")} == {"year_part=2023", "year_part=2024"}
    back = readers.read_parquet(spark, f"{folder}/t", ["ds", "y", "year_part"])
    assert back.where("year_part = 2024").count() == 3
    assert back.count() == 6


def test_json_is_read_back(spark, folder):
    df = spark.createDataFrame([("a", 1), ("b", None)], "v string, n int")
    assert sorted(map(tuple, sinks.write_json(df, f"{folder}/j").collect()), key=str) == [("a", 1), ("b", None)]
    assert readers.read_json(spark, f"{folder}/j", "v string, n int").count() == 2


def test_publish_goes_on_after_a_failure(spark, folder):
    good = spark.createDataFrame([(1, "x")], "n int, p string")
    bad = good.withColumn("n", F.raise_error(F.lit("broken")).cast("int"))
    report = sinks.publish(
        spark,
        [
            sinks.Artefact("bad", bad, "bad"),
            sinks.Artefact("none", None, "none"),
            sinks.Artefact("good", good, "good", partition=["p"]),
            sinks.Artefact("text", good, "text", layout="csv"),
        ],
        folder,
    )
    got = {r["name"]: (r["rows"], r["status"].split(":")[0]) for r in report.collect()}
    assert got == {"bad": (None, "error"), "none": (None, "skip"), "good": (1, "ok"), "text": (1, "ok")}
    assert spark.read.parquet(f"{folder}/good").first()["p"] == "x"


def test_predictions_csv(spark, folder):
    Path(folder, "p.csv").write_text("ds,key,hour,real,pred,abs_err,model\n2025-03-01, A ,5,1.5,2.0,0.5, XGBoost\n")
    row = readers.read_predictions_csv(spark, f"{folder}/p.csv").first()
    assert (row["ds"], row["key"], row["model"], row["month"]) == (date(2025, 3, 1), "A", "XGBoost", "2025-03")


def test_settled_table_is_computed_once(spark):
    drawn = settle(spark.range(50).withColumn("r", F.rand()))
    assert drawn.collect() == drawn.collect()
    assert shared_dir(spark) in scratch_path(spark, "x")
