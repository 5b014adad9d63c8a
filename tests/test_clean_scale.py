import math

import pytest

from helpers import frame
from tessera.operators import clean, evaluate, profile, scale


def col(df, c):
    return [r[c] for r in df.orderBy("id").collect()]


def test_missing_summary(spark):
    df = frame(spark, [(1, None, 1, None), (2, 1.0, 2, 1.0), (3, 3.0, 3, 1.0), (4, None, 4, 1.0)],
               "id int, a double, b int, c double")
    ms = profile.missing_summary(df.drop("id")).collect()
    assert [(r.Feature, r.Missing_Count, r.Missing_Percent) for r in ms] == [("a", 2, 50.0), ("c", 1, 25.0)]


def test_absence_fill(spark):
    df = frame(spark, [(1, None), (2, "NA"), (3, "Gd")], "id int, PoolQC string")
    assert col(clean.fill_absence(df), "PoolQC") == ["None", "None", "Gd"]


def test_median_impute(spark):
    df = frame(spark, [(1, 1.0), (2, None), (3, 3.0), (4, 10.0)], "id int, x double")
    f = clean.Imputer("median", cols=["x"]).fit(df)
    assert col(f.transform(df), "x") == [1.0, 3.0, 3.0, 10.0]


def test_mode_impute_tie_smallest(spark):
    df = frame(spark, [(1, "b"), (2, "b"), (3, "a"), (4, "a"), (5, None)], "id int, s string")
    f = clean.Imputer("most_frequent", cols=["s"], kind="categorical").fit(df)
    assert col(f.transform(df), "s")[-1] == "a"


def test_unknown_strategy():
    with pytest.raises(ValueError):
        clean.Imputer("bogus")


def test_iqr_clip_and_frozen_bounds(spark):
    df = frame(spark, [(i, float(v)) for i, v in enumerate([1, 2, 3, 4, 100])], "id int, x double")
    f = clean.OutlierClipper("iqr", 1.5, cols=["x"]).fit(df)
    assert f.bounds["x"] == (-1.0, 7.0)
    assert col(f.transform(df), "x") == [1, 2, 3, 4, 7]
    other = frame(spark, [(0, -50.0), (1, 5.0), (2, None)], "id int, x double")
    assert col(f.transform(other), "x") == [-1.0, 5.0, None]
    once = f.transform(df)
    assert col(f.transform(once), "x") == col(once, "x")          # idempotent


def test_zscore_replace(spark):
    df = frame(spark, [(i, float(v)) for i, v in enumerate([0, 0, 0, 0, 10])], "id int, x double")
    f = clean.OutlierClipper("zscore", 1.5, cols=["x"]).fit(df)
    assert col(f.transform(df), "x") == [0, 0, 0, 0, 2.0]


def test_outlier_counts(spark):
    df = frame(spark, [(i, float(v)) for i, v in enumerate([1, 2, 3, 4, 100])], "id int, x double")
    f = clean.OutlierClipper("iqr", 1.5, cols=["x"]).fit(df)
    r = clean.outlier_counts(df, f).first()
    assert (r.lower, r.upper, r.n_outliers) == (-1.0, 7.0, 1)


def test_forward_fill_chunked_equals_plain(spark):
    rows = [(i, i % 3, i // 2, None if i % 4 else float(i)) for i in range(40)]
    df = frame(spark, rows, "id int, u int, t int, v double")
    from pyspark.sql import functions as F
    a = clean.forward_fill(df, ["v"], ["u"], ["t", "id"])
    b = clean.forward_fill(df, ["v"], ["u"], ["t", "id"], chunk_by=F.floor(F.col("t") / 3))
    assert col(a, "v") == col(b, "v")
    assert col(a, "v")[:4] == [0.0, None, None, 0.0]      # row 3 shares key 0 with row 0


def test_scalers(spark):
    two = frame(spark, [(0, 1.0), (1, 3.0)], "id int, x double")
    assert col(scale.Scaler("standard", cols=["x"]).fit(two).transform(two), "x") == [-1.0, 1.0]
    five = frame(spark, [(i, float(i + 1)) for i in range(5)], "id int, x double")
    assert col(scale.Scaler("robust", cols=["x"]).fit(five).transform(five), "x") == [-1, -.5, 0, .5, 1]
    three = frame(spark, [(0, 10.0), (1, 20.0), (2, 30.0)], "id int, x double")
    mm = scale.Scaler("minmax", cols=["x"]).fit(three)
    assert col(mm.transform(three), "x") == [0.0, 0.5, 1.0]
    assert mm.numbers()["x"] == {"min": 10.0, "scale": 0.05}
    same = frame(spark, [(0, 7.0), (1, 7.0)], "id int, x double")
    for s in ("standard", "robust", "minmax"):
        assert col(scale.Scaler(s, cols=["x"]).fit(same).transform(same), "x") == [0.0, 0.0]
    with pytest.raises(ValueError):
        scale.Scaler("bogus")


def test_inverse_is_identity(spark):
    df = frame(spark, [(i, float(i * i % 17), None if i == 3 else float(i)) for i in range(20)],
               "id int, x double, y double")
    for s in ("standard", "robust", "minmax"):
        f = scale.Scaler(s, cols=["x", "y"]).fit(df)
        back = f.inverse_transform(f.transform(df))
        for c in ("x", "y"):
            for a, b in zip(col(back, c), col(df, c)):
                assert (a is None and b is None) or math.isclose(a, b, abs_tol=1e-9)


def test_label_stats_and_match(spark):
    ids = frame(spark, [(1,), (2,), (3,)], "id int")
    labels = frame(spark, [(1, 10.0, 0), (1, 11.0, 1), (3, 30.0, 2)], "id int, y double, pos int")
    m = profile.match_labels(ids, labels, "id", "y", order="pos")
    assert [(r.id, r.y) for r in m.orderBy("id").collect()] == [(1, 11.0), (2, None), (3, 30.0)]
    u = profile.unmatched_ids(ids, labels, "id").collect()
    assert [(r.rank, r.id, r.n_unmatched) for r in u] == [(1, 2, 1)]
    v = {r.check: r.violations for r in profile.validate_labels(m, "id", "y", ["id", "y"]).collect()}
    assert v == {"columns_match": 0, "null_key": 0, "numeric_label": 0, "null_label": 1,
                 "non_positive_label": 0}


def test_contract_faults_have_a_check_each(spark):
    good = frame(spark, [(1, 10.0), (2, 20.0)], "id int, y double")
    contract = [("id", "int"), ("y", "double")]

    def failed(df):
        v = profile.validate_labels(df, "id", "y", contract=contract).collect()
        return {r.check: r.violations for r in v if not r.passed}

    assert failed(good) == {}
    assert failed(good.select("y", "id")) == {"columns_match": 1}
    assert failed(good.selectExpr("cast(id as bigint) id", "y")) == {"column_types": 1}
    assert failed(good.selectExpr("id", "cast(y as string) y")) == {"numeric_label": 1, "column_types": 1}
    assert failed(good.selectExpr("id", "y as z")) == {
        "columns_match": 1, "numeric_label": 1, "null_label": 2, "column_set": 2}
    assert failed(frame(spark, [(None, 1.0), (2, None), (2, -1.0), (2, 3.0), (None, 0.0)], "id int, y double")) == {
        "null_key": 2, "null_label": 1, "non_positive_label": 2, "duplicate_key": 2}
    assert failed(good.selectExpr("y")) == {"columns_match": 1, "null_key": 2, "column_set": 1}
    assert failed(good.limit(0)) == {}


def test_label_order_is_required_and_its_ties_are_settled(spark):
    labels = frame(spark, [(1, 10.0, 1), (1, 12.0, 1), (1, 99.0, 0), (2, None, 5)], "id int, y double, pos int")
    assert sorted((r.id, r.y) for r in profile.dedupe_last(labels, "id", "y", "pos").collect()) == [(1, 12.0), (2, None)]
    with pytest.raises(TypeError):
        profile.dedupe_last(labels, "id", "y")


def test_bundle_joins_fold_scores(spark):
    df = frame(spark, [("a", "train", 1.0, 2.0), ("a", "test", 3.0, 3.0), ("b", "train", 1.0, 1.0)],
               "model string, split string, y double, p double")
    folds = frame(spark, [("a", 1, 4.0), ("a", 0, 2.0)], "model string, fold int, rmse double")
    got = {r.model: r for r in evaluate.metric_bundle(df, folds=folds).collect()}
    assert (got["a"].cv_scores, got["a"].cv_mean, got["a"].cv_std, got["a"].cv_folds) == ([2.0, 4.0], 3.0, 1.0, 2)
    assert got["a"].train_rmse == 1.0 and got["b"].cv_scores is None
    with pytest.raises(ValueError):
        evaluate.metric_bundle(df, by=(), folds=folds)


def test_forward_fill_null_key_matches_plain(spark):
    from pyspark.sql import functions as F
    rows = [(i, None if i % 4 == 0 else i % 2, i, None if i % 3 else float(i)) for i in range(30)]
    df = frame(spark, rows, "id int, u int, t int, v double")
    a = clean.forward_fill(df, ["v"], ["u"], ["t", "id"])
    b = clean.forward_fill(df, ["v"], ["u"], ["t", "id"], chunk_by=F.floor(F.col("t") / 4))
    assert col(a, "v") == col(b, "v")
