from __future__ import annotations

from math import ceil

import pytest
from conftest import rows
from pyspark.sql import functions as F

from cohortlens.operators import scoring, split


@pytest.mark.parametrize("wanted, weeks, expected", [(7, range(1, 11), 7), (7, range(1, 5), 4), (0, range(1, 11), 7), (7, [3, 3, 3], 3)])
def test_split_week(spark, wanted, weeks, expected):
    df = spark.createDataFrame([(w,) for w in weeks], "week int")
    assert split.split_week(df, wanted).first()[0] == expected


def test_sides(spark):
    df = spark.createDataFrame([(w,) for w in range(1, 11)], "week int")
    sides = split.time_split(df, 7)
    assert sides.filter("side = 'train'").count() == 6
    assert sides.filter("side = 'test'").agg(F.min("week")).first()[0] == 7


@pytest.mark.parametrize("n, positives, buckets", [(1000, 300, 4096), (1000, 300, 3), (37, 11, 16), (10, 5, 1), (101, 100, 8)])
def test_stratified_split_sizes(spark, n, positives, buckets):
    df = spark.range(n).select(F.col("id").alias("k"), (F.col("id") < positives).cast("int").alias("y"))
    got = split.stratified_split(df, "y", ["k"], buckets=buckets)
    assert got.count() == n == got.select("k").distinct().count()
    test = {r["y"]: r["count"] for r in got.filter("side = 'test'").groupBy("y").count().collect()}
    assert sum(test.values()) == ceil(n * 0.2)
    assert abs(test.get(1, 0) - positives * 0.2) <= 1
    again = split.stratified_split(df.repartition(5), "y", ["k"], buckets=buckets)
    assert rows(got) == rows(again)


def test_seeded_sample_is_stable(spark):
    df = spark.range(100).withColumnRenamed("id", "k")
    one = rows(split.seeded_sample(df, 20, ["k"]))
    assert len(one) == 20 and one == rows(split.seeded_sample(df.repartition(9), 20, ["k"]))
    assert split.seeded_sample(df, 500, ["k"]).count() == 100


def snapshot_rows(spark):
    return spark.createDataFrame(
        [(1, "A", 1, 0.2), (2, "A", 2, 0.9), (3, "A", 2, 0.9), (4, "A", 2, 0.1)],
        "id_student long, code_module string, week int, risk_score double",
    )


@pytest.mark.parametrize("week, ids", [(None, [2, 3, 4]), (1, [1]), (2, [2, 3, 4]), (50, [2, 3, 4])])
def test_snapshot(spark, week, ids):
    assert [r[0] for r in rows(scoring.snapshot(snapshot_rows(spark), week), "id_student")] == ids


def test_empty_snapshot(spark):
    assert scoring.snapshot(snapshot_rows(spark).filter("week > 9")).count() == 0


def test_top_k_breaks_ties_by_id(spark):
    assert [r.id_student for r in scoring.top_k(snapshot_rows(spark), 3).collect()] == [2, 3, 1]


def test_flag_includes_the_threshold(spark):
    df = spark.createDataFrame([(0.25,), (0.2499,), (0.9,)], "risk_score double")
    assert [r.high_risk_flag for r in scoring.with_flag(df).collect()] == [1, 0, 1]


def test_zero_variance_feature_standardises_to_zero(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    got = rows(scoring.standardise(df, ["a", "b"]), "z_a", "z_b")
    assert got == [(-1.0, 0.0), (1.0, 0.0)]
