"""Experiment readout on observed outcomes, and the return-on-investment grid."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortlens.functions.columns import clip, erfc, uniform
from cohortlens.params import RunParams
from cohortlens.session import checkpointed

SCENARIO = "uplift_scenario"


def doubles(values: Sequence[float]) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def assign_arms(df: DataFrame, seed: int = RunParams.seed, keys: Sequence[str] = ("id_student",)) -> DataFrame:
    """Seeded 50/50 assignment by a hash of the keys; equal on every rerun and partitioning."""
    u = uniform(seed, *[F.col(k) for k in keys])
    return df.withColumn("arm", F.when(u < F.lit(0.5), F.lit("control")).otherwise(F.lit("treatment")))


def with_base_probability(assigned: DataFrame) -> DataFrame:
    return assigned.withColumn("base_pass_prob", clip(F.lit(1) - F.col("risk_score"), 0.05, 0.95))


def expand_scenarios(assigned: DataFrame, uplifts: Sequence[float] = RunParams.uplifts) -> DataFrame:
    """One copy per uplift; the treatment arm gains the uplift in expected pass probability."""
    expanded = with_base_probability(assigned).withColumn(SCENARIO, F.explode(doubles(uplifts)))
    raised = clip(F.col("base_pass_prob") + F.col(SCENARIO), 0.0, 1.0)
    return expanded.withColumn(
        "sim_pass_prob", F.when(F.col("arm") == "treatment", raised).otherwise(F.col("base_pass_prob"))
    )


def observed_outcomes(targeted: DataFrame, outcomes: DataFrame, keys: Sequence[str] = ("id_student", "code_module")) -> DataFrame:
    """Targeted students by scenario with the outcome observed in that scenario, null where none was.

    ``outcomes`` has the keys, the scenario and 0/1 outcomes; several rows of one key and scenario count as
    one, passed if one of them is.
    """
    on = [*keys, SCENARIO]
    once = outcomes.groupBy(*on).agg(F.max("outcome").alias("outcome"))
    return targeted.join(once, on, "left")


def union_scenarios(frames: Sequence[DataFrame]) -> DataFrame:
    """Observed outcome tables of several scenarios as one table."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def arm_rates(outcomes: DataFrame) -> DataFrame:
    """Size, successes and rate of both arms per scenario, from arm and 0/1 outcome columns.

    Rows whose outcome is not known belong to no arm; ``without_outcome`` counts them.
    """

    def count(arm: str, value: Column) -> Column:
        known = (F.col("arm") == arm) & F.col("outcome").isNotNull()
        return F.coalesce(F.sum(F.when(known, value)), F.lit(0)).cast("bigint")

    counted = outcomes.groupBy(SCENARIO).agg(
        count("control", F.lit(1)).alias("control_n"),
        count("control", F.col("outcome")).alias("control_success"),
        count("treatment", F.lit(1)).alias("treatment_n"),
        count("treatment", F.col("outcome")).alias("treatment_success"),
        F.count_if(F.col("outcome").isNull()).alias("without_outcome"),
    )
    return counted.withColumns(
        {
            "control_rate": F.try_divide("control_success", "control_n"),
            "treatment_rate": F.try_divide("treatment_success", "treatment_n"),
        }
    ).withColumn("rate_diff", F.col("treatment_rate") - F.col("control_rate"))


def z_test(rates: DataFrame) -> DataFrame:
    """Pooled two-proportion test, two-sided; without any variance the p-value is 1."""
    pooled = F.try_divide(
        F.col("control_success") + F.col("treatment_success"), F.col("control_n") + F.col("treatment_n")
    )
    error = F.sqrt(pooled * (1 - pooled) * (F.try_divide(F.lit(1), "control_n") + F.try_divide(F.lit(1), "treatment_n")))
    tested = rates.withColumn("_error", error).withColumn("_x", F.abs(F.try_divide("rate_diff", "_error")) / F.sqrt(F.lit(2.0)))
    p = F.when(F.col("_error") == 0, F.lit(1.0)).otherwise(erfc("_x"))
    return tested.withColumn("p_value", p).drop("_error", "_x")


def bootstrap_ci(
    rates: DataFrame, n_boot: int = RunParams.n_boot, seed: int = RunParams.seed, keep: Sequence[str] = ()
) -> DataFrame:
    """Percentile interval (2.5 %, 97.5 %) of the rate difference under resampling.

    For 0/1 outcomes the successes of a resampled arm are binomial in its size and share, so the
    input is the rates, one row per scenario, and no data row is copied. Each repeat draws both
    arms by inverting the distribution at a hash number; the same way at every size. The cost
    follows the square root of an arm (the support within 12 standard deviations; what lies outside is below
    double precision) and not rows times repeats. Columns of the scenario named in ``keep`` are passed on.
    """
    sizes = ["control_n", "control_success", "treatment_n", "treatment_success"]
    passed = [SCENARIO, *keep]
    # one row per scenario, read by several branches
    small = checkpointed(rates.select(*dict.fromkeys([*passed, *sizes])))
    pair = F.array(*[F.struct(F.lit(arm).alias("arm"), F.col(f"{arm}_n").alias("n"), F.col(f"{arm}_success").alias("s")) for arm in ("control", "treatment")])
    arms = small.filter((F.col("control_n") > 0) & (F.col("treatment_n") > 0)).select(SCENARIO, F.explode(pair).alias("_a")).select(SCENARIO, "_a.*")
    drawn = _binomial_draws(arms, n_boot, seed)
    share = F.col("drawn") / F.col("n")
    diffs = drawn.groupBy(SCENARIO, "rep").agg(
        (F.max(F.when(F.col("arm") == "treatment", share)) - F.max(F.when(F.col("arm") == "control", share))).alias("diff")
    )
    bounds = F.percentile("diff", F.array(F.lit(0.025), F.lit(0.975)))
    found = diffs.groupBy(SCENARIO).agg(bounds.alias("_ci"))
    return small.select(*passed).join(found, SCENARIO, "left").select(
        *passed, F.col("_ci")[0].alias("ci_low"), F.col("_ci")[1].alias("ci_high")
    )


def _binomial_draws(arms: DataFrame, n_boot: int, seed: int) -> DataFrame:
    """``drawn`` successes for every repeat of every arm (scenario, arm, n, s).

    The distribution function over the support and the hash numbers are put in one order; a number takes the
    first count whose share of the distribution reaches it.
    """
    p = F.col("s") / F.col("n")
    mean, reach = F.col("n") * p, 12 * F.sqrt(F.col("n") * p * (1 - p)) + 20
    low = F.greatest(F.lit(0), F.floor(mean - reach)).cast("bigint")
    high = F.least(F.col("n"), F.ceil(mean + reach)).cast("bigint")
    certain = (F.col("s") == 0) | (F.col("s") == F.col("n"))
    support = arms.filter(~certain).withColumn("low", low).withColumn("k", F.explode(F.sequence("low", high)))
    step = F.when(F.col("k") > F.col("low"), F.ln((F.col("n") - F.col("k") + 1) / F.col("k") * p / (1 - p))).otherwise(0.0)
    arm = W.partitionBy(SCENARIO, "arm")
    upward = arm.orderBy("k").rowsBetween(W.unboundedPreceding, 0)
    logs = support.withColumn("_log", F.sum(step).over(upward))
    mass = logs.withColumn("_mass", F.exp(F.col("_log") - F.max("_log").over(arm)))
    share = mass.withColumn("x", F.sum("_mass").over(upward) / F.sum("_mass").over(arm))
    reps = arms.withColumn("rep", F.explode(F.sequence(F.lit(0), F.lit(n_boot - 1))))
    numbers = reps.withColumn("x", uniform(seed, F.col("rep"), F.col("arm")))
    nothing = F.lit(None)
    points = share.select(SCENARIO, "arm", "n", "s", "low", "x", "k", nothing.cast("int").alias("rep")).unionByName(
        numbers.select(SCENARIO, "arm", "n", "s", nothing.cast("bigint").alias("low"), "x", nothing.cast("bigint").alias("k"), "rep")
    )
    before = arm.orderBy("x", F.col("rep").isNull()).rowsBetween(W.unboundedPreceding, 0)
    placed = points.withColumn("_below", F.max("k").over(before)).withColumn("_low", F.max("low").over(arm))
    drawn = F.when(certain, F.col("s")).otherwise(F.coalesce(F.col("_below") + 1, F.col("_low")))
    return placed.filter(F.col("rep").isNotNull()).select(SCENARIO, "arm", "n", "rep", drawn.alias("drawn"))


def experiment_readout(outcomes: DataFrame, run_ts: str, params: RunParams = RunParams()) -> DataFrame:
    """One row per scenario: rates, difference, p-value and interval."""
    tested = z_test(arm_rates(outcomes))
    keep = ["control_rate", "treatment_rate", "rate_diff", "p_value"]
    return bootstrap_ci(tested, params.n_boot, params.seed, keep=keep).select(
        F.lit(run_ts).cast("timestamp").alias("run_ts"),
        SCENARIO,
        "control_rate",
        "treatment_rate",
        "rate_diff",
        "p_value",
        "ci_low",
        "ci_high",
    )


def roi_grid(
    targeted: DataFrame, params: RunParams = RunParams(), by: Sequence[str] = (), reference: DataFrame | None = None
) -> DataFrame:
    """Uplift by cost grid for the targeted students, in all or per group.

    ``reference`` is an experiment readout; its 5 % row gives the reference difference.
    """
    counted = targeted.groupBy(*by).agg(F.count("*").alias("top_k_students"))
    grid = counted.withColumn("uplift_assumption", F.explode(doubles(params.roi_uplifts))).withColumn(
        "cost_per_student", F.explode(F.array(*[F.lit(c) for c in params.roi_costs]))
    )
    passes = F.col("top_k_students") * F.col("uplift_assumption")
    out = grid.select(
        *by,
        "top_k_students",
        "uplift_assumption",
        "cost_per_student",
        F.lit(params.value_per_pass).alias("value_per_pass"),
        passes.alias("incremental_passes"),
        (passes * F.lit(params.value_per_pass) - F.col("top_k_students") * F.col("cost_per_student")).alias("roi"),
    )
    if reference is not None:
        base = reference.filter(F.col(SCENARIO) == F.lit(0.05)).agg(F.max("rate_diff").alias("d")).scalar()
        out = out.withColumn("reference_diff_from_5pct_sim", base)
    return out


def best_roi(grid: DataFrame) -> DataFrame:
    """The cell with the highest return; the lower uplift and cost win a tie."""
    return grid.orderBy(F.col("roi").desc(), "uplift_assumption", "cost_per_student").limit(1)


def run_summary(metrics: DataFrame, grid: DataFrame) -> DataFrame:
    """One row with the model metrics and the best grid cell."""
    best = best_roi(grid).select(F.struct("uplift_assumption", "cost_per_student", "roi").alias("best")).scalar()
    return metrics.select("auc", "pr_auc", "precision_at_0_5", "recall_at_0_5", best.alias("best")).select(
        "auc",
        "pr_auc",
        "precision_at_0_5",
        "recall_at_0_5",
        F.col("best.uplift_assumption").alias("best_uplift"),
        F.col("best.cost_per_student").alias("best_cost"),
        F.col("best.roi").alias("best_roi"),
    )
