"""Threshold and week-over-week spike alerts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.functions.columns import percent_text
from cohortlens.operators.scoring import top_k
from cohortlens.params import RunParams


def snapshot_stats(snap: DataFrame) -> DataFrame:
    """High-risk share and row count, one row."""
    return snap.agg(F.avg("high_risk_flag").alias("high_risk_rate"), F.count("*").alias("snapshot_rows"))


def weekly_target_mean(panel: DataFrame) -> DataFrame:
    return panel.groupBy("week").agg(F.avg("dropout_risk_target").alias("mean_target"))


def spike(panel: DataFrame) -> DataFrame:
    """Relative change of the mean target from the week before the last to the last, one row.

    With fewer than two weeks the change is 0. Only two rows leave the weekly means.
    """
    last_two = weekly_target_mean(panel).orderBy(F.col("week").desc()).limit(2)
    row = last_two.agg(
        F.count("*").alias("weeks"),
        F.max_by("mean_target", "week").alias("current_mean"),
        F.min_by("mean_target", "week").alias("prior_mean"),
    )
    floor = F.when(F.col("prior_mean") < 1e-9, F.lit(1e-9)).otherwise(F.col("prior_mean"))
    change = (F.col("current_mean") - F.col("prior_mean")) / floor
    return row.select(
        "weeks",
        "prior_mean",
        "current_mean",
        F.when(F.col("weeks") >= 2, change).otherwise(F.lit(0.0)).alias("spike_pct"),
    )


def top_ids(snap: DataFrame, n: int = 10) -> DataFrame:
    """The ids at highest risk as text."""
    return top_k(snap, n).select(F.col("id_student").cast("string").alias("id_student"))


def alert_row(snap: DataFrame, panel: DataFrame, run_ts: str, params: RunParams = RunParams()) -> DataFrame:
    """The log row of one run; always exactly one row.

    The spike looks at the target of all features and always at the last two weeks, whatever
    week the snapshot shows.
    """
    rate, change = F.col("high_risk_rate"), F.col("spike_pct")
    over_rate = F.coalesce(rate > F.lit(params.risk_threshold), F.lit(False))
    over_spike = F.coalesce(change > F.lit(params.spike_threshold), F.lit(False))
    stats = snapshot_stats(snap).withColumn("spike_pct", spike(panel).select("spike_pct").scalar())
    # The wording of the log lines.
    rate_line = F.concat(
        F.lit("- Threshold alert: high-risk rate "),
        percent_text(rate),
        F.lit(" > configured "),
        percent_text(F.lit(params.risk_threshold)),
        F.lit("."),
    )
    spike_line = F.concat(
        F.lit("- Spike alert: mean risk increased "),
        percent_text(change),
        F.lit(" WoW > configured "),
        percent_text(F.lit(params.spike_threshold)),
        F.lit("."),
    )
    calm_line = F.lit("- No alert triggered; metrics remain within configured limits.")
    return stats.select(
        F.lit(run_ts).cast("timestamp").alias("run_ts"),
        F.when(over_rate & over_spike, F.lit("threshold_and_spike"))
        .when(over_rate, F.lit("threshold"))
        .when(over_spike, F.lit("spike"))
        .otherwise(F.lit("none"))
        .alias("alert_type"),
        "high_risk_rate",
        "spike_pct",
        F.concat_ws(
            " | ",
            F.when(over_rate, rate_line),
            F.when(over_spike, spike_line),
            F.when(~over_rate & ~over_spike, calm_line),
        ).alias("message"),
    )
