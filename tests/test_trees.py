"""Importances of the forests of the shadow test against Spark's learner, and the whole
shadow test of the registered query."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import frame
from tessera.operators import learn, select, trees
from tessera.plans import registry


def rows(n=900, seed=0):
    r = np.random.default_rng(seed)
    a, b, c = r.integers(0, 20, n), r.integers(0, 3, n), r.integers(0, 31, n) / 4
    return [(i, float(a[i]), int(b[i]), float(c[i]), float(a[i] ** 1.5 + 4 * (b[i] == 1) * c[i] + r.normal())) for i in range(n)]


SCHEMA, FEATURES = "id bigint, a double, b int, c double, y double", ["a", "b", "c"]


def grown(df, est, features=FEATURES):
    base, n = trees.binned(df, "id", features, "y", est.getMaxBins())
    return trees.importances(base, {trees.VALUES: range(len(features))}, n, est)


def spark_importances(df, est, features=FEATURES):
    return learn.fit(df, features, "y", est).stages[-1].featureImportances.toArray()


@pytest.mark.parametrize("extra", [{}, {"minInstancesPerNode": 40}, {"minInfoGain": 2.0}, {"maxDepth": 3}, {"minWeightFractionPerNode": 0.05}, {"maxDepth": 0}])
def test_one_unsampled_tree_is_sparks(spark, extra):
    df = frame(spark, rows(), SCHEMA).repartition(3)
    # in nodes of a few rows several features part the rows alike: any of them may win
    est = learn.forest(**{"numTrees": 1, "maxDepth": 12, "featureSubsetStrategy": "all", "minInstancesPerNode": 10, **extra}).setBootstrap(False)
    assert np.allclose(grown(df, est), spark_importances(df, est), rtol=0, atol=1e-9)


def test_sampled_forest_is_near_sparks(spark):
    df = frame(spark, rows(3000, 1), SCHEMA)
    for params in ({"featureSubsetStrategy": "sqrt"}, {"featureSubsetStrategy": "2", "subsamplingRate": 0.5, "maxDepth": 15}):
        est = learn.forest(**{"numTrees": 60, "maxDepth": 6, **params})
        assert np.allclose(grown(df, est), spark_importances(df, est), rtol=0, atol=0.05)


def test_large_nodes_are_split_by_passes(spark, monkeypatch):
    df = frame(spark, rows(2000, 2), SCHEMA).repartition(4)
    est = learn.forest(numTrees=7, maxDepth=9, featureSubsetStrategy="2")
    whole = grown(df, est)
    for most, at_once in ((300, 64), (5, 1 << 15)):
        monkeypatch.setattr(trees, "LOCAL_WEIGHT", most)
        monkeypatch.setattr(trees, "ROWS_AT_ONCE", at_once)
        assert np.allclose(grown(df, est), whole, rtol=0, atol=1e-9)


def test_bags_and_subsets():
    p = trees.Forest(3, 5, 32, 2, 1, 0.0, True, 0.7, 5)
    w = np.stack([trees.bag(np.arange(200_000), p, t) for t in range(3)])
    for k in range(6):
        assert abs((w == k).mean() - math.exp(-0.7) * 0.7 ** k / math.factorial(k)) < 2e-3
    assert abs(np.corrcoef(w.astype(float)) - np.eye(3)).max() < 0.01
    s = trees.subsets(np.arange(1, 20_001), p, 1, 5)
    assert s.shape == (20_000, 2) and (s[:, 0] != s[:, 1]).all()
    assert all(abs((s[:, j] == f).mean() - 0.2) < 0.02 for j in range(2) for f in range(5))
    none = trees.Forest(1, 5, 32, 2, 1, 0.0, False, 1.0, 5)
    assert trees.bag(np.arange(9), none, 0).tolist() == [1] * 9
    assert [trees.subset_size(s, 12, 9) for s in ("auto", "all", "sqrt", "log2", "onethird", "3", "0.5")] == [4, 12, 4, 4, 4, 3, 6]


def test_bins_of_few_and_many_values(spark):
    df = frame(spark, [(i, float(i % 5), i % 2, float(i), 1.0) for i in range(640)], SCHEMA).repartition(3)
    few, two, many = trees.split_points(df, FEATURES, 32)
    assert few.tolist() == [0.5, 1.5, 2.5, 3.5] and two.tolist() == [0.5]
    assert set(np.bincount(np.searchsorted(many, np.arange(640.0), "left"))) == {20}
    base, n = trees.binned(df, "id", FEATURES, "y", 32)
    assert n == 640 and {len(r[0]) for r in base.select(trees.VALUES).collect()} == {3}


@pytest.mark.parametrize("bad", [None, math.nan, math.inf])
@pytest.mark.parametrize("at", [1, 4])
def test_missing_values_are_an_error(spark, bad, at):
    data = [list(r) for r in rows(30)]
    data[7][at] = bad
    with pytest.raises(ValueError, match="a" if at == 1 else "y"):
        trees.binned(frame(spark, data, SCHEMA), "id", FEATURES, "y", 32)


def test_other_learners_are_fitted_by_spark(spark):
    df = frame(spark, rows(200), SCHEMA)
    est = learn.gbt(maxIter=2, maxDepth=2)
    assert not trees.supported(est, df, FEATURES) and trees.supported(learn.forest(), df, FEATURES)
    assert not trees.supported(learn.forest(maxBins=300), df, FEATURES) and not trees.supported(learn.forest(), df.withColumn("a", F.array("a")), FEATURES)
    out = {r.feature: r for r in select.shadow_selection(df, "id", FEATURES, "y", iterations=2, estimator=est).collect()}
    assert out["a"].hits == out["a"].rounds == 2


def test_shadow_query_is_whole(spark, monkeypatch):
    """100 rounds of 100 trees of depth 15 on all train rows, while a feature is undecided."""
    data = [(i, *[float(i * (k + 2) % 7) for k in range(len(registry.LEARN_FEATURES))], float(i % 9), "test" if i % 5 == 0 else "train") for i in range(60)]
    df = frame(spark, data, "o_orderkey bigint, " + ", ".join(f"{c} double" for c in registry.LEARN_FEATURES) + ", o_totalprice double, split string")
    monkeypatch.setattr(registry, "learn_frame", lambda spark, d: df)
    seen = []

    def importances(d, values, n, est):
        seen.append((n, est.getNumTrees(), est.getMaxDepth()))
        out = np.zeros(sum(map(len, values.values())))
        out[len(values[trees.VALUES])] = 1.0
        out[0] = 2.0 * (len(seen) % 2)             # the first feature beats the copies every other time
        return out
    monkeypatch.setattr(trees, "importances", importances)
    got = registry.QUERIES["select_shadow"](spark, "").collect()
    assert seen == [(48, 100, 15)] * 100
    assert (got[0].hits, got[0].rounds, got[0].decision) == (50, 100, "tentative")
    assert all(r.decision == "rejected" and r.hits == 0 and r.rounds == 13 for r in got[1:])
