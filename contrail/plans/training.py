"""End-to-end training run (inventory H18, H21, A3, A4, A6, A8, L1/L2).

ingest -> validate -> join + features -> split -> train all -> gate ->
champion / challenger -> persist model, feature tables and reports.
Every stage is a lazy DataFrame plan; control returns to the driver only
for the small reports and the model fits.  Outputs go under ``out_dir``
(a shared folder on a cluster).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.functions.features import route_key
from contrail.operators import baseline, contracts, drift, joins, ml, quality
from contrail.operators import pointintime as P
from contrail.operators.feature_set import engineer
from contrail.operators.ordered import split_by_position
from contrail.plans.derived import SHIP_ROLES, SHIP_THRESHOLDS
from contrail.plans.features_in_time import attach_prior
from contrail.plans.learning import SPEC, SPLIT_KEYS
from contrail.plans.profile import FEED_COLS, daily_feed_wide
from contrail.plans.shipments import calendar_years, carriers, locations, shipments_materialized as shipments
from contrail.session import cut_lineage, path_exists
from contrail.sources.calendar import holiday_calendar
from contrail.sources.tables import Tables, quarantine_rows, report_sink, write_clustered, write_table

# What the run needs of its tables.
CONTRACTS = (
    contracts.Contract("shipments", ("order_key", "line_number", "carrier", "origin", "dest", "ship_date", "delay", "distance", "net_amount"), ("delay", "distance", "net_amount")),
    contracts.Contract("locations", ("loc_key", "loc_name", "loc_region")),
    contracts.Contract("carriers", ("carrier_key", "carrier_name")),
    contracts.Contract("holidays", ("date", "holiday_name", "is_holiday")),
    contracts.Contract("daily_feed", ("date", *FEED_COLS), tuple(FEED_COLS)),
)
PRIOR_KEYS = ("origin", "carrier", "route")
# The point-in-time statistics, the daily feed and the derived features are model inputs.
TRAIN_SPEC = ml.FeatureSpec(
    numeric=[*SPEC.numeric, *FEED_COLS, "DURATION_RATIO", "TEMP_RANGE", "is_holiday", "IS_WEEKEND", *[c for k in PRIOR_KEYS for c in P.prior_columns(k)]],
    categorical=[*SPEC.categorical, "DISTANCE_BIN"], label=SPEC.label)
DRIFT_COLUMNS = ["order_key", "distance", "discount", "tax", "delay", "sched_time", "priority"]


@dataclass
class RunResult:
    status_passed: bool
    best_model: str | None
    accepted: bool
    promoted: bool
    model_path: str | None
    report_path: str


def prior_tables(df: DataFrame) -> dict[str, DataFrame]:
    """Per key the statistics up to each date, for joins as of any later date."""
    df = df.withColumn("route", route_key("origin", "dest"))
    return {k: P.cumulative_stats(df, [k], "ship_date", "delay", k) for k in PRIOR_KEYS}


def build_features(t: Tables, rows: DataFrame, priors: dict[str, DataFrame]) -> DataFrame:
    """D1-D6, E4 / H21 and F15 on fact rows: carrier and both location roles, holidays, the daily
    feed with median fill, rows without a target dropped, point-in-time statistics, derived features."""
    s = joins.enrich_star(rows, carriers(t), locations(t))
    s = joins.join_holidays(s, holiday_calendar(calendar_years(t)), date_col="ship_date")
    s = joins.join_daily_and_fill(s, daily_feed_wide(t), "ship_date", "date", FEED_COLS)
    s = attach_prior(s.withColumn("route", route_key("origin", "dest")), priors)
    return engineer(s, SHIP_ROLES, SHIP_THRESHOLDS)


class ModelRejected(RuntimeError):
    pass


def run_training(spark: SparkSession, sf_dir: str, out_dir: str,
                 champion_path: str | None = None, fail_on_invalid: bool = False,
                 models: dict | None = None, fail_on_rejection: bool = False) -> RunResult:
    t = Tables(spark, sf_dir)
    out = out_dir.rstrip("/")

    # All contracts before any job; D1-D3: keys that would repeat fact rows
    s = shipments(t)
    frames = {"shipments": s, "locations": locations(t), "carriers": carriers(t), "holidays": holiday_calendar(calendar_years(t)), "daily_feed": daily_feed_wide(t)}
    contracts.check_all(frames, CONTRACTS)
    joins.require_unique_keys({"locations": (frames["locations"], "loc_key"), "carriers": (frames["carriers"], "carrier_key"), "holidays": (frames["holidays"], "date")})

    # validate (C6) -- the status is data; gating is optional
    checks = cut_lineage(quality.validation_status(
        presence=contracts.column_presence(spark, frames, {c.name: c.required for c in CONTRACTS}),
        nulls=quality.null_counts(s, columns=["delay", "net_amount"], only_missing=False),
        fk=quality.referential_check(s, ["origin", "dest"], t["nation"], "n_nationkey"),
        dates=quality.date_part_ranges(s),
        ranges=quality.range_violations(t["customer"], {"c_acctbal": (-1000.0, 10000.0)})))
    passed = bool(checks.where(F.col("check_name") == "overall").first()["passed"])
    report_sink(checks, f"{out}/reports/validation")
    if fail_on_invalid and not passed:
        raise ValueError("validation failed")

    # drift of the second half against the first
    ref, cur = split_by_position(s.select(*DRIFT_COLUMNS), "order_key")
    per_column = cut_lineage(drift.table_drift(ref.drop("order_key"), cur.drop("order_key"), ["priority"]))
    report_sink(per_column, f"{out}/reports/drift")
    report_sink(drift.drift_summary(per_column), f"{out}/reports/drift_summary")

    # A4: rows without a target or a date are set aside, counted by the job that writes them
    counts = quarantine_rows(s, {"target": F.col("delay").isNotNull() & F.col(SPEC.label).isNotNull(), "date": F.col("ship_date").isNotNull()}, f"{out}/shipments")
    report_sink(spark.createDataFrame(list(counts.items()), "rows string, n long"), f"{out}/reports/quarantine")
    valid = spark.read.parquet(f"{out}/shipments").where("quality = 'validated'").drop("quality", "broken")

    # features (A6: partitioned feature table; H21: statistic tables for scoring)
    for name, stats in prior_tables(valid).items():
        write_table(stats, f"{out}/feature_stats/{name}")
    same = joins.RowInvariant("features")
    feats = build_features(t, same.before(valid), stored_priors(spark, f"{out}/feature_stats"))
    write_clustered(feats, f"{out}/features", ["year", "month"], ["order_key"], same.after)
    same.check()
    feats = spark.read.parquet(f"{out}/features")

    # train all, gate, champion / challenger
    tr, te = ml.hash_split(feats, SPLIT_KEYS)
    rows, fitted, best = ml.train_and_evaluate(tr, te, TRAIN_SPEC, models)
    report = spark.createDataFrame([{k: (float(v) if isinstance(v, float) else v) for k, v in r.items()}
                                    for r in rows])
    report_sink(report, f"{out}/reports/training")
    best_row = next((r for r in rows if r["model"] == best), None)
    accepted = bool(best_row and best_row["accepted"])
    if fail_on_rejection and not accepted:      # H14: the reference fails the run
        raise ModelRejected(f"best model {best} failed the acceptance gates")
    promoted, model_path = False, None
    if accepted:
        champion = ml.load_model(champion_path) if champion_path and path_exists(spark, champion_path) else None
        decision = ml.champion_challenger(te, SPEC.label, fitted[best], champion)
        promoted = decision["accepted"]
        if promoted:
            model_path = ml.save_model(fitted[best], f"{out}/final_model")
            # Drift baseline of the training rows with the model's scores
            base = baseline.baseline_profile(tr, SPEC.numeric).withColumns({
                "baseline_r2": F.lit(best_row["test_r2"]).cast("double"),
                "baseline_mae": F.lit(best_row["test_mae"]).cast("double")})
            write_table(base, f"{out}/baseline")
    return RunResult(passed, best, accepted, promoted, model_path, f"{out}/reports")


def stored_priors(spark: SparkSession, stats_dir: str) -> dict[str, DataFrame]:
    return {k: spark.read.parquet(f"{stats_dir}/{k}") for k in PRIOR_KEYS}


def score_with_feature_tables(spark: SparkSession, sf_dir: str, model_path: str, raw: DataFrame, stats_dir: str) -> DataFrame:
    """Score raw fact rows; each takes the stored statistics as of the day before its date."""
    x = build_features(Tables(spark, sf_dir), raw, stored_priors(spark, stats_dir))
    return ml.score(ml.load_model(model_path), x)
