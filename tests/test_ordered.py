from __future__ import annotations

import numpy as np
import pytest
from conftest import rows

from cohortlens.functions import ordered


def values(n=3000, seed=0):
    rng = np.random.default_rng(seed)
    # a third of all rows share one value, another third crowds just below 1
    return np.concatenate([np.full(n // 3, 0.5), 1 - rng.random(n // 3) * 1e-9, rng.normal(0, 5, n - 2 * (n // 3))])


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("buckets", [2, 7, 64])
def test_running_sums_match_numpy(spark, descending, buckets):
    distinct, counts = np.unique(values(), return_counts=True)
    df = spark.createDataFrame([(float(v), int(n)) for v, n in zip(distinct, counts)], "v double, n long")
    got = rows(ordered.running_sums(df, "v", ["n"], descending=descending, buckets=buckets), "v", "cum_n", "total_n")
    running = np.cumsum(counts[::-1])[::-1] if descending else np.cumsum(counts)
    assert [g[1] for g in got] == running.tolist()
    assert {g[2] for g in got} == {int(counts.sum())}


def test_buckets_are_balanced_for_crowded_values(spark):
    distinct = np.unique(values())
    cut = ordered.with_buckets(spark.createDataFrame([(float(v),) for v in distinct], "v double"), "v", 10)
    sizes = [r["count"] for r in cut.groupBy("_bucket").count().collect()]
    assert max(sizes) < 2 * len(distinct) / 10


def test_exact_quantiles_match_numpy(spark):
    data = {"a": values(1000, 1), "b": values(500, 2), "c": np.array([3.0]), "d": np.full(50, 2.0)}
    df = spark.createDataFrame([(k, float(v)) for k, vs in data.items() for v in vs] + [("a", None)], "k string, v double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.7, 0.99, 1.0]
    got = {r[0]: r[1:] for r in rows(ordered.exact_quantiles(df, "v", probs, ["k"]))}
    for k, vs in data.items():
        assert got[k] == pytest.approx(np.quantile(vs, probs), abs=1e-12)


def test_shuffled_ranks_are_a_stable_permutation(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    one = rows(ordered.shuffled_ranks(df, ["k"], 7), "k", "_rank", "_rows")
    two = rows(ordered.shuffled_ranks(df.repartition(13), ["k"], 7, buckets=50), "k", "_rank", "_rows")
    assert one == two
    assert sorted(r[1] for r in one) == list(range(1000))
    assert [r[1] for r in one] != list(range(1000))
    assert {r[2] for r in one} == {1000}
