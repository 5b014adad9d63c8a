import math

import pytest

from helpers import frame
from tessera.operators import ensemble, evaluate, select


def test_mutual_information_identity(spark):
    df = frame(spark, [(0, 0.0, 0.0), (1, 0.0, 0.0), (2, 1.0, 1.0), (3, 1.0, 1.0)],
               "id int, x double, y double")
    mi = select.mutual_information(df, "y", ["x"], bins=2).first()["score"]
    assert math.isclose(mi, math.log(2))
    const = frame(spark, [(i, 1.0, float(i % 2)) for i in range(8)], "id int, x double, y double")
    assert abs(select.mutual_information(const, "y", ["x"], bins=2).first()["score"]) < 1e-12


def test_threshold_strict(spark):
    s = frame(spark, [(f"f{i}", float(i)) for i in range(1, 6)], "feature string, score double")
    got = select.threshold_select(s, 75).collect()
    assert [(r.feature, r.threshold) for r in got] == [("f5", 4.0)]


@pytest.mark.parametrize("n_feat,expected", [(15, 15), (100, 50), (600, 200)])
def test_vote_size(spark, n_feat, expected):
    feats = [f"f{i}" for i in range(n_feat)]
    sel = frame(spark, [("m", "f3", 1.0)], "method string, feature string, score double")
    v = select.vote(sel, feats, 20, 200)
    assert v.where("selected").count() == expected
    assert v.where("rank = 1").first()["feature"] == "f3"


def test_importance_ranking(spark):
    sel = frame(spark, [("Mutual Information", "a", 0.2), ("Permutation", "a", 0.4),
                        ("Boruta", "b", None)], "method string, feature string, score double")
    r = {x.Feature: (x.Importance, x.Reason) for x in select.importance_ranking(sel, ["a", "b", "c"]).collect()}
    assert r["a"][1] == "Permutation" and math.isclose(r["a"][0], 0.3)
    assert r["b"] == (0.0, "Boruta") and r["c"] == (0.0, "Unknown")


def test_weighted_average(spark):
    p = frame(spark, [("m1", 1, 100.0), ("m2", 1, 200.0)], "model string, id int, p double")
    w = ensemble.weighted_average(p, "id", {"m1": 0.15, "m2": 0.25}).first()["prediction"]
    assert math.isclose(w, 162.5)
    p3 = frame(spark, [("m1", 1, 100.0), ("m2", 1, 200.0), ("m3", 1, 300.0)], "model string, id int, p double")
    w3 = ensemble.weighted_average(p3, "id", {"m1": 0.5, "m2": 0.5}, models=["m1", "m2", "m3"])
    assert math.isclose(w3.first()["prediction"], 187.5)
    assert math.isclose(ensemble.mean_vote(p3, "id").first()["prediction"], 200.0)


def test_metrics(spark):
    df = frame(spark, [(1.0, 1.0), (2.0, 3.0), (4.0, 2.0)], "y double, p double")
    m = evaluate.metrics(df).first()
    assert math.isclose(m.rmse, math.sqrt(5 / 3)) and math.isclose(m.mae, 1.0)
    assert math.isclose(m.r2, -1 / 14) and math.isclose(m.mape, 1 / 3)
    z = evaluate.metrics(frame(spark, [(0.0, 1.0), (2.0, 1.0)], "y double, p double")).first()
    assert math.isclose(z.mape, 0.5)


def test_error_analysis_histogram_box(spark):
    df = frame(spark, [("m", float(e), 0.0) for e in (-1, 0, 1, 2)], "model string, y double, p double")
    ea = evaluate.error_analysis(df).first()
    assert (ea.mean_error, ea.min_error, ea.max_error, ea.median_abs_error) == (0.5, -1.0, 2.0, 1.0)
    assert math.isclose(ea.std_error, math.sqrt(1.25))
    assert math.isclose(ea.percentile_90_error, 1.7) and math.isclose(ea.percentile_95_error, 1.85)
    h = frame(spark, [("m", float(e), 0.0) for e in (0, 1, 2, 4)], "model string, y double, p double")
    hist = [r.n for r in evaluate.error_histogram(h, bins=4).orderBy("bin").collect()]
    assert hist == [1, 1, 1, 1]
    b = frame(spark, [("m", float(e), 0.0) for e in (1, 2, 3, 4, 100)], "model string, y double, p double")
    box = evaluate.error_box(b).first()
    assert (box.q1, box.median, box.q3, box.whisker_low, box.whisker_high) == (2, 3, 4, 1, 4)


def test_ranking_report_pivot(spark):
    m = frame(spark, [("a", 2.0, 1.0), ("b", 1.0, 3.0)], "model string, rmse double, mae double")
    r = {x.model: (x.rank, x.is_best) for x in evaluate.rank_models(m).collect()}
    assert r == {"b": (1, True), "a": (2, False)}
    rep = evaluate.metric_report(m, metrics_=["rmse", "mae"])
    assert rep.count() == 4
    pv = evaluate.metric_pivot(rep.where("NOT (Model = 'a' AND Metric = 'mae')"), ["rmse", "mae"])
    assert {x.Model: x.mae for x in pv.collect()} == {"a": None, "b": 3.0}


def test_correlation_and_compare(spark):
    df = frame(spark, [(float(i), 2.0 * i + 1, None if i == 2 else -float(i)) for i in range(6)],
               "a double, b double, c double")
    r = {(x.feature_a, x.feature_b): x.r for x in evaluate.correlation_matrix(df).collect()}
    assert math.isclose(r[("a", "b")], 1.0) and math.isclose(r[("a", "c")], -1.0)
    pred = frame(spark, [(1, 10.0), (2, 5.0)], "id int, y double")
    truth = frame(spark, [(1, 8.0), (3, 1.0)], "id int, y double")
    c = evaluate.compare_with_truth(pred, truth, "id", "y").collect()
    assert len(c) == 1 and c[0].Absolute_Error == 2.0 and math.isclose(c[0].Relative_Error, 0.25)


def test_comparison_bars_and_none_imputer(spark):
    from tessera.operators import clean
    rep = frame(spark, [("a", "rmse", 2.0), ("b", "mae", 1.0)], "Model string, Metric string, Value double")
    bars = {r.Model: r.rmse for r in evaluate.comparison_bars(rep, "rmse").collect()}
    assert bars == {"a": 2.0, "b": 0.0}
    df = frame(spark, [(0, None), (1, 2.0)], "id int, x double")
    assert clean.Imputer("none").fit(df).transform(df).where("x IS NULL").count() == 1
