"""The whole run in one Spark application: ingest, features, models, reports.

Two tables are stored on the way, trusted and featured, because everything after
reads them many times. Each step is a plain function of tables.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seasonflow.functions.holidays import holiday_table
from seasonflow.operators import audit, evaluate, features, ingest, split
from seasonflow.operators.baseline import SeasonalMean
from seasonflow.plans import forecasters, reports
from seasonflow.session import scratch_scope, settle
from seasonflow.sources import readers, sinks
from seasonflow.sources.sinks import Artefact
from seasonflow.spec import Profile, SeriesSpec


@dataclass(frozen=True)
class Effort:
    """How hard the learners work."""

    trees: int = 200
    depth: int = 15
    light: forecasters.Boosting = forecasters.LIGHTGBM
    tuned: forecasters.Boosting = forecasters.XGBOOST
    per_key: forecasters.Boosting = forecasters.LIGHTGBM_PER_KEY

    def shortened(self, rounds: int, depth: int, trees: int) -> Effort:
        return Effort(
            trees=trees,
            depth=depth,
            light=replace(self.light, rounds=rounds, depth=depth, step=0.1),
            tuned=replace(self.tuned, rounds=rounds, depth=depth),
            per_key=replace(self.per_key, rounds=rounds, depth=depth, step=0.1),
        )


def ingest_step(spark: SparkSession, raw: str, root: str, profile: Profile, policy: str = "by_rule") -> DataFrame:
    """Raw wide CSV to the stored trusted table."""
    wide = readers.read_wide_csv(spark, raw, profile)
    sinks.write_by_year(ingest.trusted_table(wide, profile, policy), f"{root}/trusted")
    return trusted(spark, root)


def trusted(spark: SparkSession, root: str) -> DataFrame:
    return readers.read_parquet(spark, f"{root}/trusted")


def audit_tables(trusted_rows: DataFrame, wide_totals: DataFrame, profile: Profile) -> dict[str, DataFrame]:
    compared = audit.compare_totals(trusted_rows, wide_totals)
    return {
        "dates_by_year": audit.dates_by_year(trusted_rows, profile.years),
        "value_outliers": audit.value_outliers(trusted_rows),
        "top_outliers": audit.top_outliers(trusted_rows),
        "missing_by_key": audit.missing_by_key(trusted_rows),
        "total_mismatches": audit.total_mismatches(compared),
        "mismatch_sample": audit.mismatch_sample(compared),
        "years_by_key": audit.years_by_key(trusted_rows),
        "zeros_and_missing": audit.zeros_and_missing(trusted_rows),
        "top_missing_hours": audit.top_missing_hours(trusted_rows),
        "summary_by_kind": audit.summary_by_kind(trusted_rows),
        "summary_by_key": audit.summary_by_key(trusted_rows),
        "overview": audit.overview(trusted_rows),
        "unmapped_keys": ingest.unmapped_keys(trusted_rows, profile.types),
    }


def quality_tables(spark: SparkSession, root: str, profile: Profile) -> dict[str, DataFrame]:
    """The audit of the trusted table and the report on the featured one, by name."""
    rows, df = trusted(spark, root), featured(spark, root)
    audits = audit_tables(rows, rows.select("ds", "key", "total").distinct(), profile)
    found = {f"audit_{name}": table for name, table in audits.items()}
    return {**found, "feature_correlations": features.correlations(df), "null_history": features.null_history(df)}


def feature_step(spark: SparkSession, root: str, profile: Profile, spec: SeriesSpec = SeriesSpec()) -> DataFrame:
    """Trusted table to the stored featured table and label maps."""
    holidays = holiday_table(spark, profile.years)
    df, keys, kinds = features.build_features(
        trusted(spark, root).drop(split.YEAR_PART), holidays, profile.rail_kind, profile.trend_base, spec
    )
    sinks.write_json(features.encoder_table(keys, kinds), f"{root}/encoders")
    sinks.write_by_year(df, f"{root}/featured", spec)
    return featured(spark, root)


def featured(spark: SparkSession, root: str) -> DataFrame:
    return readers.read_parquet(spark, f"{root}/featured")


def model_step(
    spark: SparkSession, root: str, profile: Profile, effort: Effort = Effort(), threads: int = 4
) -> tuple[DataFrame, DataFrame]:
    """Fits all forecasters; stores models, predictions, importance and metrics."""
    df = featured(spark, root)
    names = features.feature_columns(df)
    rows = split.temporal_split(df, profile.test_from, profile.test_until, profile.val_from, later="later")
    train = split.learned_from(rows)
    marked = train.withColumn("is_val", F.col("split") == "val")
    test = split.part_rows(rows, "test", profile.test_from, profile.test_until, profile.val_from)

    mean = SeasonalMean().fit(train).transform(test)
    light = forecasters.fit_boosted(marked, names, effort.light)
    per_key = forecasters.fit_per_key(rows, names, effort.per_key, threads, f"{root}/models/per_key")
    sinks.save_model(light, f"{root}/models/boosted")
    scored: Mapping[str, DataFrame] = {
        "Baseline": mean,
        "RidgeBaseline": forecasters.predict(forecasters.fit_ridge(train, names), test),
        "RandomForest": forecasters.predict(forecasters.fit_forest(train, names, effort.trees, effort.depth), test),
        "LightGBM": forecasters.predict(light, test),
        "XGBoost": forecasters.predict(forecasters.fit_boosted(marked, names, effort.tuned), test),
        "LGB_PerLinea": forecasters.predict_per_key(per_key, test, mean),
    }
    preds = evaluate.stack([evaluate.prediction_rows(s, name) for name, s in scored.items()])
    sinks.write_predictions(preds, f"{root}/predictions")
    sinks.write_csv(forecasters.feature_importance(light, names), f"{root}/feature_importance")
    stored = predictions(spark, root)
    metrics = sinks.write_json(evaluate.metrics_document(stored, df), f"{root}/metrics")
    return stored, metrics


def ablation_step(
    spark: SparkSession, root: str, profile: Profile, settings: forecasters.Boosting, without: str = "day_of_year"
) -> DataFrame | None:
    """Where the per-key models do not beat the seasonal mean: does a feature leak?"""
    stored = predictions(spark, root).where(F.col("model").isin("Baseline", "LGB_PerLinea"))
    mae = {r["model"]: r["mae"] for r in evaluate.metrics_by(stored).collect()}  # two rows
    if mae["LGB_PerLinea"] <= mae["Baseline"]:
        return None
    df = featured(spark, root)
    rows = split.temporal_split(df, profile.test_from, profile.test_until, profile.val_from, later="later")
    return forecasters.ablation(rows, features.feature_columns(df), settings, without)


def walk_forward_step(spark: SparkSession, root: str, profile: Profile, settings: forecasters.Boosting) -> DataFrame:
    """Summary of the seasonal mean and a booster over the profile's folds."""
    df = featured(spark, root)
    found = forecasters.walk_forward(split.usable(df), profile.folds, features.feature_columns(df), settings)
    summary = evaluate.cv_summary(settle(found))
    return stored_report(spark, root, "walk_forward", summary)


def stored_report(spark: SparkSession, root: str, name: str, table: DataFrame) -> DataFrame:
    """Writes a report beside those of the run and reads it back."""
    path = f"{root}/reports/{name}"
    table.write.mode("overwrite").parquet(path)
    return spark.read.schema(table.schema).parquet(path)


def tuning_step(
    spark: SparkSession,
    root: str,
    profile: Profile,
    space: forecasters.SearchSpace = forecasters.SearchSpace(),
    trials: int = 50,
    seed: int = 42,
) -> tuple[DataFrame, DataFrame]:
    """Trials over the last two folds, and the default against the best settings."""
    df = featured(spark, root)
    names = features.feature_columns(df)
    table, best = forecasters.search(split.usable(df), profile.folds[-2:], names, space, trials, seed)
    rows = split.temporal_split(df, profile.test_from, profile.test_until, profile.val_from, later="later")
    holidays = holiday_table(spark, profile.years)
    answer = forecasters.verdict(rows, holidays, names, space.base, best)
    return stored_report(spark, root, "tuning_trials", table), stored_report(spark, root, "tuning_verdict", answer)


def predictions(spark: SparkSession, root: str) -> DataFrame:
    return readers.read_parquet(spark, f"{root}/predictions")


def report_tables(
    preds: DataFrame, demand: DataFrame, featured_rows: DataFrame, holidays: DataFrame, profile: Profile, model: str
) -> dict[str, DataFrame]:
    """Every report table, by name."""
    by_model = evaluate.metrics_by(preds)
    by_key = evaluate.metrics_by(preds, ["model", "key"])
    with_slices = preds.join(
        featured_rows.select("ds", "key", F.col("hour_of_day").alias("hour"), "kind", "is_holiday"), ["ds", "key", "hour"], "left"
    )
    monthly = reports.monthly_totals(preds.where(F.col("model") == model), profile.test_from, profile.test_until)
    by_holiday = reports.holiday_mae(preds, holidays)
    days = evaluate.holiday_day_metrics(preds, holidays)
    return {
        "kpis": evaluate.kpi_table(by_model),
        "comparison": evaluate.comparison_table(by_model),
        "slices": evaluate.metric_slices(with_slices),
        "equal_weight": evaluate.equal_weight_mae(by_key),
        "gain_by_key": evaluate.gain_by_key(by_key, model),
        "real_against_predicted": reports.real_against_predicted(preds, demand, model),
        "daily_means": reports.daily_means(preds),
        "heatmap": reports.heatmap(featured_rows, profile.hours),
        "error_histogram": reports.error_histogram(preds, demand.select("key", "kind").distinct(), model),
        "totals_by_key": reports.totals_by_key(demand),
        "daily_total": reports.daily_total(demand),
        "annual_totals": reports.annual_totals(demand),
        "monthly_trend": reports.linear_trend(monthly),
        "holiday_split": evaluate.holiday_split_metrics(preds, holidays),
        "holiday_days": days,
        "holiday_classes": evaluate.holiday_class_metrics(days),
        "holiday_mae": by_holiday,
        "holiday_comparison": reports.holiday_comparison(by_holiday, model),
        "holiday_day_table": reports.holiday_day_table(preds, holidays, model),
    }


def renamed(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """The columns under the names that users of the source know."""
    return df.withColumnsRenamed({a: b for a, b in names.items() if a in df.columns})


def publish_step(
    spark: SparkSession, root: str, target: str, profile: Profile, reports_made: Mapping[str, DataFrame]
) -> DataFrame:
    """Copies of the stored tables and the reports under the target's prefixes."""
    stored: Sequence[Artefact] = [
        Artefact("trusted", renamed(trusted(spark, root).drop(split.YEAR_PART), profile.names), "trusted"),
        Artefact("featured", renamed(featured(spark, root).drop(split.YEAR_PART), profile.names), "refined/features"),
        Artefact("predictions", renamed(predictions(spark, root), profile.names), "refined/predictions"),
    ]
    made = [Artefact(n, t, f"reports/{n}") for n, t in reports_made.items()]
    return sinks.publish(spark, [*stored, *made], target)


def run(
    spark: SparkSession,
    raw: str,
    root: str,
    profile: Profile,
    effort: Effort = Effort(),
    model: str = "XGBoost",
    policy: str = "by_rule",
    target: str | None = None,
) -> DataFrame:
    """All steps in order; returns the metrics, or the publishing report if ``target`` is given.

    The audit and the feature report are stored in the work folder, or published with the other
    reports. Scratch tables go when the run ends: what is returned reads stored tables only.
    """
    with scratch_scope(spark):
        return _steps(spark, raw, root, profile, effort, model, policy, target)


def _steps(
    spark: SparkSession, raw: str, root: str, profile: Profile, effort: Effort, model: str, policy: str, target: str | None
) -> DataFrame:
    ingest_step(spark, raw, root, profile, policy)
    df = feature_step(spark, root, profile)
    preds, metrics = model_step(spark, root, profile, effort)
    found = ablation_step(spark, root, profile, effort.light)
    leak = {} if found is None else {"ablation": found}
    if target is None:
        made = [Artefact(n, t, f"reports/{n}") for n, t in (quality_tables(spark, root, profile) | leak).items()]
        sinks.publish(spark, made, root)
        return metrics
    holidays = holiday_table(spark, profile.years)
    made = report_tables(preds, trusted(spark, root), df, holidays, profile, model)
    made |= quality_tables(spark, root, profile) | leak
    return publish_step(spark, root, target, profile, made)
