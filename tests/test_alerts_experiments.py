from __future__ import annotations

import math

import pytest
from conftest import rows
from pyspark.sql import functions as F

from cohortlens.functions.columns import erfc
from cohortlens.operators import alerts, experiments
from cohortlens.params import RunParams

TS = "2024-02-01 06:30:15"


def panel(spark, *means):
    return spark.createDataFrame([(w, m) for w, m in enumerate(means)], "week int, dropout_risk_target double")


def snap(spark, flags):
    return spark.createDataFrame([(i, "A", f / 2, f) for i, f in enumerate(flags)], "id_student long, code_module string, risk_score double, high_risk_flag int")


@pytest.mark.parametrize("means, change", [((0.5,), 0.0), ((0.4, 0.5), 0.25), ((0.9, 0.4, 0.5), 0.25), ((0.0, 0.5), 0.5 / 1e-9), ((0.5, 0.4), -0.2)])
def test_spike_uses_the_last_two_weeks(spark, means, change):
    assert alerts.spike(panel(spark, *means)).first().spike_pct == pytest.approx(change)


@pytest.mark.parametrize(
    "flags, means, kind",
    [
        ([1, 0, 0, 0], (0.5, 0.5), "none"),
        ([1, 1, 0, 0], (0.5, 0.5), "threshold"),
        ([0, 0, 0, 0], (0.4, 0.5), "spike"),
        ([1, 1, 0, 0], (0.4, 0.5), "threshold_and_spike"),
        ([], (0.4,), "none"),
    ],
)
def test_alert_type(spark, flags, means, kind):
    got = alerts.alert_row(snap(spark, flags), panel(spark, *means), TS).collect()
    assert len(got) == 1 and got[0].alert_type == kind


def test_alert_message_has_the_published_form(spark):
    # 187 of 300 flagged and a change of 1.75 %
    row = alerts.alert_row(snap(spark, [1] * 187 + [0] * 113), panel(spark, 0.4, 0.407), TS).first()
    assert row.message == "- Threshold alert: high-risk rate 62.33% > configured 25.00%."
    both = alerts.alert_row(snap(spark, [1]), panel(spark, 0.4, 0.5), TS).first()
    assert both.message.split(" | ")[1] == "- Spike alert: mean risk increased 25.00% WoW > configured 10.00%."


def test_erfc(spark):
    xs = [0.0, 1e-9, 0.3, 1.0, 2.0, 2.4999, 2.5, 3.0, 5.0, 9.0]
    got = spark.createDataFrame([(x,) for x in xs], "x double").select(erfc("x").alias("e")).collect()
    assert [r.e for r in got] == [pytest.approx(math.erfc(x), rel=1e-9, abs=1e-15) for x in xs]


def counts(spark, *cells):
    """Rates from (scenario, control successes, control n, treatment successes, treatment n)."""
    out = []
    for u, cs, cn, ts, tn in cells:
        out += [(u, "control", int(i < cs)) for i in range(cn)] + [(u, "treatment", int(i < ts)) for i in range(tn)]
    return experiments.arm_rates(spark.createDataFrame(out, "uplift_scenario double, arm string, outcome int"))


def test_published_p_values(spark):
    rates = counts(spark, (0.03, 1, 25, 0, 25), (0.05, 1, 25, 4, 25), (0.08, 1, 25, 5, 25))
    got = {r.uplift_scenario: (round(r.rate_diff, 4), round(r.p_value, 4)) for r in experiments.z_test(rates).collect()}
    assert got == {0.03: (-0.04, 0.3124), 0.05: (0.12, 0.1573), 0.08: (0.16, 0.0817)}


def test_equal_outcomes_give_p_1(spark):
    assert [r.p_value for r in experiments.z_test(counts(spark, (0.1, 0, 5, 0, 5), (0.2, 5, 5, 5, 5))).collect()] == [1.0, 1.0]


def test_empty_arm_gives_null(spark):
    row = experiments.z_test(counts(spark, (0.1, 2, 5, 0, 0))).first()
    assert row.p_value is None and row.treatment_rate is None


@pytest.mark.parametrize("size", [1, 10, 1000, 1_000_000])
def test_bootstrap_has_one_way_at_every_size(spark, size):
    """Near the normal interval below and above any row count, repeatable, without Python in the plan."""
    n, m = 200 * size, 220 * size
    rates = spark.createDataFrame([(0.05, n, 30 * size, m, 60 * size)], "uplift_scenario double, control_n long, control_success long, treatment_n long, treatment_success long")
    found = experiments.bootstrap_ci(rates, 2000)
    r = found.first()
    se = math.sqrt(0.15 * 0.85 / n + (60 / 220) * (160 / 220) / m)
    assert r.ci_low == pytest.approx(60 / 220 - 0.15 - 1.96 * se, abs=0.25 * se + 0.6 / n)
    assert r.ci_high == pytest.approx(60 / 220 - 0.15 + 1.96 * se, abs=0.25 * se + 0.6 / n)
    assert experiments.bootstrap_ci(rates.repartition(3), 2000).first() == r
    assert "Python" not in found._jdf.queryExecution().executedPlan().toString()


def test_bootstrap_of_certain_arms(spark):
    sure = experiments.bootstrap_ci(counts(spark, (0.1, 0, 50, 40, 40), (0.2, 5, 5, 0, 9)), 200).orderBy("uplift_scenario").collect()
    assert [(r.ci_low, r.ci_high) for r in sure] == [(1.0, 1.0), (-1.0, -1.0)]


def test_outcomes_belong_to_their_scenario_and_may_be_missing(spark):
    targeted = spark.createDataFrame([(k, "A", u, "control" if k % 2 else "treatment") for k in range(4) for u in (0.03, 0.05)], "id_student long, code_module string, uplift_scenario double, arm string")
    seen = spark.createDataFrame([(k, "A", u, int(u == 0.05)) for k in range(3) for u in (0.03, 0.05)] + [(0, "A", 0.03, 1)], "id_student long, code_module string, uplift_scenario double, outcome int")
    got = {r.uplift_scenario: r for r in experiments.arm_rates(experiments.observed_outcomes(targeted, seen)).collect()}
    assert [(r.control_n, r.control_success, r.treatment_n, r.treatment_success, r.without_outcome) for r in (got[0.03], got[0.05])] == [(1, 0, 2, 1, 1), (1, 1, 2, 2, 1)]


def test_arms_are_stable_and_about_even(spark):
    df = spark.range(2000).withColumnRenamed("id", "id_student")
    one = experiments.assign_arms(df)
    assert rows(one) == rows(experiments.assign_arms(df.repartition(11)))
    assert 900 < one.filter("arm = 'control'").count() < 1100


def test_scenarios(spark):
    df = spark.createDataFrame([(1, 0.99, "treatment"), (2, 0.02, "control")], "id_student long, risk_score double, arm string")
    got = rows(experiments.expand_scenarios(df, (0.03, 0.08)), "id_student", "uplift_scenario", "base_pass_prob", "sim_pass_prob")
    want = [(1, 0.03, 0.05, 0.08), (1, 0.08, 0.05, 0.13), (2, 0.03, 0.95, 0.95), (2, 0.08, 0.95, 0.95)]
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert [g[2:] for g in got] == [pytest.approx(w[2:]) for w in want]


def test_published_grid(spark):
    grid = experiments.roi_grid(spark.range(50))
    got = {(r.uplift_assumption, r.cost_per_student): r.roi for r in grid.collect()}
    assert len(got) == 20
    published = {(0.03, 50): -700, (0.03, 300): -13200, (0.05, 50): 500, (0.05, 200): -7000, (0.08, 50): 2300, (0.08, 100): -200, (0.1, 50): 3500, (0.1, 300): -9000}
    assert {k: got[k] for k in published} == pytest.approx(published)
    best = experiments.best_roi(grid).first()
    assert (best.uplift_assumption, best.cost_per_student, best.roi) == (0.1, 50, 3500.0)


def test_grid_takes_the_5_percent_difference(spark):
    rates = counts(spark, (0.03, 1, 25, 0, 25), (0.05, 1, 25, 4, 25))
    got = experiments.roi_grid(spark.range(50), RunParams(), reference=rates)
    assert {round(r.reference_diff_from_5pct_sim, 9) for r in got.collect()} == {0.12}


def test_union_of_scenarios(spark):
    frames = [spark.range(2).withColumn("uplift_scenario", F.lit(u)) for u in (0.03, 0.05)]
    assert experiments.union_scenarios(frames).count() == 4


def test_sixth_module_is_in_the_heatmap(spark):
    summary = spark.createDataFrame([(1, m, 0.5) for m in "ABCDEF"], "week int, code_module string, high_risk_rate double")
    from cohortlens.operators import reports

    assert reports.module_heatmap(summary).columns == ["week", *"ABCDEF"]
