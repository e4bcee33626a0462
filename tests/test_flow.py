"""The whole run on a small raw file, and batch against stream."""

from dataclasses import replace
from pathlib import Path

from pyspark.sql import functions as F

from seasonflow.functions.holidays import holiday_table
from seasonflow.operators import asof, features
from seasonflow.plans import flow, scoring
from seasonflow.plans.forecasters import SearchSpace
from seasonflow.sources import readers, sinks
from seasonflow.spec import TRANSIT
from seasonflow.streaming.scoring import score_stream


def raw_file(spark, path):
    """Two lines over seven months, one hour never open, some blanks."""
    days = spark.range(212).select(F.date_add(F.lit("2024-08-01").cast("date"), F.col("id").cast("int")).alias("d"))
    rows = days.select("d", F.explode(F.array(F.lit("LÍNEA A"), F.lit("LÍNEA K"))).alias("LINEA"))
    text = F.when(F.year("d") < 2025, F.date_format("d", "d/M/yyyy")).otherwise(F.date_format("d", "M/d/yyyy"))
    cells = []
    for h in TRANSIT.hours:
        base = (F.lit(1000) + F.weekday("d") * 150 + h * 20 + F.pmod(F.hash("d", F.lit(h)), F.lit(100))) * F.when(
            F.col("LINEA") == "LÍNEA A", 5
        ).otherwise(1)
        blank = F.lit(h == 23) | (F.pmod(F.hash("d", "LINEA", F.lit(h)), F.lit(40)) == 0)
        cells.append(F.when(blank, "").otherwise(F.format_number(base, 0)).alias(f"{h}:00"))
    rows.select(text.alias("DIA"), "LINEA", *cells, F.lit("99").alias("TOTAL")).coalesce(1).write.option("header", True).csv(path)


def test_whole_run_and_serving(spark, folder):
    raw_file(spark, f"{folder}/raw")
    effort = flow.Effort().shortened(rounds=4, depth=4, trees=4)
    report = flow.run(spark, f"{folder}/raw", f"{folder}/work", TRANSIT, effort, target=f"{folder}/out")
    got = {r["name"]: (r["status"], r["rows"]) for r in report.collect()}
    assert {s for s, _ in got.values()} == {"ok"}, got
    assert got["trusted"][1] == 212 * 2 * 20
    assert got["comparison"][1] == 6
    assert got["audit_total_mismatches"][1] >= 1 and got["null_history"][1] == 1 and got["feature_correlations"][1] == 15
    published = spark.read.parquet(f"{folder}/out/refined/features")
    assert {"fecha", "linea", "es_festivo", "año_trend", "lag_14d", "pasajeros"} <= set(published.columns)
    trusted, featured = flow.trusted(spark, f"{folder}/work"), flow.featured(spark, f"{folder}/work")
    assert featured.where("hour = 23 and y <> 0").count() == 0
    preds = flow.predictions(spark, f"{folder}/work")
    assert preds.where("pred < 0 or pred is null").count() == 0
    by_model = {r["model"]: r["mae"] for r in spark.read.json(f"{folder}/work/metrics").where("slice_type = 'global'").collect()}
    assert set(by_model) == {"Baseline", "RidgeBaseline", "RandomForest", "LightGBM", "XGBoost", "LGB_PerLinea"}
    assert spark.read.option("header", True).csv(f"{folder}/work/feature_importance").count() == 28
    assert sinks.load_models(spark, f"{folder}/work/models/per_key").select("key").distinct().count() == 2
    audits = flow.audit_tables(trusted, trusted.select("ds", "key", "total").distinct(), TRANSIT)
    assert audits["total_mismatches"].first()["mismatches"] == 424
    assert audits["overview"].first()["rows"] == got["trusted"][1]

    quick = replace(effort.light, rounds=2, depth=3)
    summary = {r["model"]: r["folds"] for r in flow.walk_forward_step(spark, f"{folder}/work", TRANSIT, quick).collect()}
    assert summary == {"Baseline": 1, "LightGBM": 1}  # only the last fold has rows to train on
    space = SearchSpace(depth=(2, 3), rounds=(2, 2), base=quick)
    trials, verdict = flow.tuning_step(spark, f"{folder}/work", TRANSIT, space, trials=1)
    assert trials.count() == 1 and {r["model"] for r in verdict.collect()} == {"default", "tuned"}
    ablation = flow.ablation_step(spark, f"{folder}/work", TRANSIT, quick)
    assert (ablation is None) == (by_model["LGB_PerLinea"] <= by_model["Baseline"])

    encoders = spark.read.json(f"{folder}/work/encoders")
    state = scoring.ServingState(
        history=trusted,
        stats=asof.history_stats(trusted, bounded=True),
        means=asof.weekday_means(trusted),
        lines=trusted.select("key", "kind").distinct(),
        keys=encoders.where("encoder = 'key'").select("value", F.col("code").cast("int").alias("code")),
        kinds=encoders.where("encoder = 'kind'").select("value", F.col("code").cast("int").alias("code")),
        holidays=holiday_table(spark, TRANSIT.years),
        rail_kind=TRANSIT.rail_kind,
        trend_base=TRANSIT.trend_base,
    )
    asked = [(1, "línea a", "2025-02-28", "8", None), (2, "LÍNEA K", "2025-03-20", "9", None), (3, "LÍNEA Q", "2025-02-01", "9", None), (4, "LÍNEA A", "x", "9", None)]
    requests = spark.createDataFrame(asked, readers.REQUESTS)
    model = sinks.load_trees(spark, f"{folder}/work/models/boosted")
    valid = scoring.accepted(scoring.validate(requests, state.keys))
    batch = sorted(map(tuple, scoring.live_scores(scoring.request_features(valid, state), model).collect()))
    assert len(batch) == 2 and batch[0][-1] is True and batch[1][-1] is False

    for i in range(2):  # two files that arrive one after the other
        requests.where(f"request_id % 2 = {i}").write.mode("append").parquet(f"{folder}/asked")
        stream = spark.readStream.schema(readers.REQUESTS).parquet(f"{folder}/asked")
        score_stream(stream, state, model, f"{folder}/answers", f"{folder}/offsets").awaitTermination()
    scored = spark.read.parquet(f"{folder}/answers/scored")
    assert scored.select("batch").distinct().count() == 2
    assert sorted(map(tuple, scored.drop("batch").collect())) == batch
    assert spark.read.parquet(f"{folder}/answers/rejected").count() == 2
    assert features.feature_columns(featured) and Path(folder, "work").exists()
