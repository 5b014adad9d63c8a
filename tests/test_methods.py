"""Out-of-fold stacking, sequential shadow test, early stopping, pairwise sums,
quantiles of many groups and columns, rewritten predictions."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import frame
from tessera.functions import gram, quantiles
from tessera.operators import ensemble, evaluate, learn, select
from tessera.sources import sinks


def numbers(n, seed=0):
    r = np.random.default_rng(seed)
    a, b, noise = r.normal(size=(3, n))
    return [(i, float(a[i]), float(b[i]), float(r.normal()), "abc"[i % 3], float(4 * a[i] - 2 * b[i] + 0.3 * noise[i])) for i in range(n)]


SCHEMA = "id int, a double, b double, noise double, g string, y double"


def test_no_row_sees_its_own_label(spark):
    rows = numbers(120)
    moved = [(*r[:5], 1e6) if r[0] == 17 else r for r in rows]
    members = {"small": learn.forest(numTrees=3, maxDepth=3), "tree": learn.forest(numTrees=1, maxDepth=2)}
    for make in (lambda d: ensemble.out_of_fold(d, ["a", "b"], "y", members, "id", k=3),
                 lambda d: ensemble.group_mean_oof(d, "id", "y", {"m": "g"}, k=3)):
        one, two = ({(r["model"], r["id"]): r["p"] for r in make(frame(spark, x, SCHEMA)).collect()} for x in (rows, moved))
        assert len(one) == len(two) and {k[1] for k in one} == set(range(120))
        # group means take a row's fold off the group's sums: equal up to that rounding
        assert all(one[k] == pytest.approx(two[k], rel=1e-8) for k in one if k[1] == 17)
        assert any(abs(one[k] - two[k]) > 100 for k in one if k[1] != 17)  # rows of other folds learn from it


def test_out_of_fold_ridge(spark):
    df = frame(spark, numbers(200), SCHEMA)
    oof = ensemble.out_of_fold(df, ["a", "b", "noise"], "y", {"f": learn.forest(numTrees=4, maxDepth=4), "s": learn.forest(numTrees=2, maxDepth=2)}, "id", k=4)
    assert oof.columns == ["model", "id", "fold", "y", "p"] and oof.count() == 400
    ridge = ensemble.fit_ridge(oof, "id", ["f", "s"], alpha=2.0)
    t = oof.groupBy("id").pivot("model", ["f", "s"]).agg(F.first("p")).join(df.select("id", "y"), "id").orderBy("id").toPandas()
    x, y = t[["f", "s"]].to_numpy(), t["y"].to_numpy()
    xc, yc = x - x.mean(0), y - y.mean()
    w = np.linalg.solve(xc.T @ xc + 2.0 * np.eye(2), xc.T @ yc)
    assert np.allclose(ridge.coefficients, w, rtol=1e-9) and ridge.n == 200
    got = ridge.predict(oof, "id").orderBy("id").toPandas()["prediction"].to_numpy()
    assert np.allclose(got, y.mean() + xc @ w, rtol=1e-9)
    missing = ridge.predict(oof.where("not (id = 3 and model = 's')"), "id").where("id = 3").first()
    assert missing["prediction"] is None
    assert ensemble.fit_ridge(oof.where("false"), "id", ["f", "s"]).coefficients == [0.0, 0.0]
    with pytest.raises(ValueError):
        ensemble.out_of_fold(df.where("id = 1"), ["a"], "y", {"f": learn.forest(numTrees=1, maxDepth=1)}, "id")


def test_shadow_test_decides(spark):
    df = frame(spark, numbers(300, 3), SCHEMA)
    out = {r.feature: r for r in select.shadow_selection(df, "id", ["a", "noise"], "y",
                                                         estimator=learn.forest(numTrees=5, maxDepth=4)).collect()}
    assert out["a"].selected and out["a"].decision == "accepted" and out["a"].hits == out["a"].rounds < 100
    assert not out["noise"].selected and out["noise"].decision in ("rejected", "tentative")
    assert out["a"].p_value == 0.5 ** out["a"].rounds
    # 2 features, alpha 0.01: the first round at which 2 ** -n < 0.01 / (2 n)
    assert out["a"].rounds == next(n for n in range(1, 100) if 0.5 ** n < 0.01 / (2 * n))
    assert select.shadow_decision(0, 12, 2, 0.01) == "rejected" and select.shadow_decision(6, 12, 2, 0.01) == "tentative"


def test_best_round():
    errors = [5, 4, 3, 3.5, 3.2, 3.1, 3.4, 1.0]
    assert learn.best_round(errors, 3) == (3, True)       # three rounds without a smaller error: the later one is not seen
    assert learn.best_round(errors, 5) == (8, False) and learn.best_round(errors[:5], 3) == (3, False)
    assert learn.best_round([], 3) == (0, False) and learn.best_round([math.nan, 2.0], 3) == (2, False)


def test_early_stopping_cuts_the_model(spark):
    df = frame(spark, numbers(400, 5), SCHEMA).withColumn("val", F.col("id") % 4 == 0)
    est = learn.gbt("xgboost", maxIter=40, maxDepth=3, stepSize=0.5)
    model, errors = learn.fit_early(df, ["a", "b", "noise"], "y", est, F.col("val"), patience=3)
    at, _ = learn.best_round(errors, 3)
    assert model.stages[-1].getNumTrees == at < 40 and errors[at - 1] == min(errors[:at])
    val = df.where("val")
    mse = learn.predict(model, val, "id", keep=["y"]).agg(F.avg((F.col("prediction") - F.col("y")) ** 2)).first()[0]
    assert mse == pytest.approx(errors[at - 1], rel=1e-9)
    # labels of the validation rows that training can only get wrong: the first round is the best
    wrong = df.withColumn("y", F.when(F.col("val"), -F.col("y")).otherwise(F.col("y")))
    model, errors = learn.fit_early(wrong, ["a", "b", "noise"], "y", est, F.col("val"), patience=3)
    assert model.stages[-1].getNumTrees == 1 and len(errors) == 6
    whole, errors = learn.fit_early(df, ["a"], "y", learn.gbt("xgboost", maxIter=2, maxDepth=2), F.lit(False))
    assert errors == [] and whole.stages[-1].getNumTrees == 2


def test_pair_sums(spark):
    r = np.random.default_rng(2)
    x = r.normal(size=(500, 5)) * [1, 10, 1e-3, 1, 1] + [0, 1e6, 5, 0, 7]
    x[r.random(x.shape) < 0.2] = np.nan
    x[:, 4] = 7.1
    df = frame(spark, [[None if v != v and i % 2 else float(v) for v in row] for i, row in enumerate(x)],
               "a double, b double, c double, d double, e double").repartition(5)
    got = {(t["feature_a"], t["feature_b"]): t["r"] for t in evaluate.correlation_matrix(df).collect()}
    for i, a in enumerate("abcde"):
        for j, b in enumerate("abcde"):
            ok = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
            if "e" in (a, b):
                assert got[a, b] is None
            else:
                assert got[a, b] == pytest.approx(np.corrcoef(x[ok, i], x[ok, j])[0, 1], abs=1e-8)
    assert gram.pair_sums(df, ["a", "b"])["n"][0, 1] == (~np.isnan(x[:, :2]).any(axis=1)).sum()
    assert all(t["r"] is None for t in evaluate.correlation_matrix(df.where("false")).collect())
    assert evaluate.correlation_matrix(df, []).count() == 0


def test_quantiles_of_many_groups(spark):
    """10,000 groups, one of them hot with a value that is half of it; null groups and values."""
    r = np.random.default_rng(4)
    rows = [(int(g), float(v)) for g, v in zip(r.integers(0, 10_000, 30_000), r.normal(size=30_000))]
    rows += [(77, float(v)) for v in r.integers(0, 3, 4000)] + [(77, 1.0)] * 4000 + [(None, 2.0), (None, 5.0), (None, None), (20_000, None), (20_001, math.nan)]
    df = spark.createDataFrame(rows, "g int, x double")
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    groups: dict = {}
    for g, v in rows:
        if v is not None and v == v:
            groups.setdefault(g, []).append(v)
    for how, method in (("linear", "linear"), ("inverted_cdf", "inverted_cdf")):
        got = {t["g"]: t[1:] for t in quantiles.group_quantiles(df, "x", probs, ["g"], how).collect()}
        assert set(got) == set(groups)
        for g in [*list(groups)[:300], 77, None]:
            assert np.allclose(got[g], np.quantile(groups[g], probs, method=method), rtol=1e-12, atol=1e-12), g
    ea = evaluate.error_analysis(df.select("g", F.col("x").alias("y"), F.lit(0.0).alias("p")), by=["g"])
    assert ea.count() == len(groups) + (20_001 not in groups)  # a NaN error is an error without quantiles
    assert quantiles.group_quantiles(df.where("false"), "x", [0.5], ["g"]).count() == 0


def test_quantiles_by_digits(spark):
    r = np.random.default_rng(6)
    cols = [r.normal(size=700) * 1e6, -np.abs(r.normal(size=700)), r.integers(0, 3, 700).astype(float), np.full(700, -0.0),
            np.where(np.arange(700) == 9, np.inf, r.normal(size=700) * 1e-300), r.normal(size=700)]
    cols[5][::3] = np.nan
    names = [f"c{i}" for i in range(6)]
    df = frame(spark, [[float(v) for v in row] for row in zip(*cols)], ", ".join(f"{n} double" for n in names)).repartition(4)
    probs = [0.0, 0.1, 0.5, 0.75, 1.0]
    for how in ("linear", "inverted_cdf"):
        got = quantiles.column_quantiles(df, names, probs, interpolation=how)
        for n, x in zip(names, cols):
            with np.errstate(invalid="ignore"):
                want = np.quantile(x[~np.isnan(x)], probs, method=how)
            assert np.allclose(got[n][:4], want[:4], rtol=1e-12, atol=0) and got[n][4] == x[~np.isnan(x)].max()
    none = quantiles.column_quantiles(df.where("false"), names, probs)
    assert all(v == [None] * 5 for v in none.values())


def test_rewritten_predictions(spark, tmpdir_path):
    rows = [(m, i, float(i)) for m in ("a", "b") for i in range(4)]
    df = frame(spark, rows, "model string, id int, prediction double")
    for fmt in ("parquet", "json", "csv"):
        path = f"{tmpdir_path}/{fmt}"
        sinks.write_predictions(df, path, fmt)
        for _ in range(2):
            sinks.write_predictions(df.where("model = 'a'").withColumn("prediction", F.lit(9.0)), path, fmt)
        back = sinks.read_predictions(spark, path, fmt, "id int, prediction double, model string")
        assert {(r["model"], r["n_rows"], r["max_prediction"]) for r in sinks.prediction_summary(back).collect()} == {("a", 4, 9.0), ("b", 4, 3.0)}
    sinks.write_predictions(df.where("model = 'a'"), path, "csv", replace_all=True)
    assert sinks.read_predictions(spark, path, "csv", "id int, prediction double, model string").count() == 4


def test_digit_counters_are_bounded(monkeypatch):
    """Counters of later digits go on while rows still come; a task held all its rows before."""
    import pyarrow as pa
    from tessera.functions import quantiles as Q
    monkeypatch.setattr(Q, "HELD", 1000)
    x = np.random.default_rng(5).uniform(1.0, 1.06, 20_000)
    bits = Q._order_bits(x)
    known = [np.unique(bits >> np.uint64(48))]
    read = []

    def batches():
        for a in range(0, len(x), 500):
            read.append(a)
            yield pa.RecordBatch.from_arrays([pa.array(x[a:a + 500])], ["c0"])

    total, first, most = {}, None, 0
    for b in Q._digit_counter(known, 24, 24)(batches()):
        first, most = first or len(read), max(most, b.num_rows)
        for _, p, d, n in zip(*[c.to_pylist() for c in b.columns]):
            total[p, d] = total.get((p, d), 0) + n
    assert first <= 3 and most <= 1500
    keys, n = np.unique(bits >> np.uint64(24), return_counts=True)
    assert total == {(int(np.searchsorted(known[0], k >> np.uint64(24))), int(k) & 0xFFFFFF): int(c) for k, c in zip(keys, n)}


def test_search_reads_rows_kept_for_it(spark, monkeypatch):
    """All fits of a search read vectors kept in memory, every trial is fitted on every fold,
    and the values are those of a cross-validation; nothing is left in memory."""
    df = frame(spark, numbers(300), SCHEMA)
    fits, one = [], learn.fit_assembled

    def fit(data, label, estimator):
        assert data.storageLevel.useMemory or "InMemoryTableScan" in data._jdf.queryExecution().executedPlan().toString()
        fits.append(estimator.getMaxDepth())
        return one(data, label, estimator)

    monkeypatch.setattr(learn, "fit_assembled", fit)
    make = lambda maxDepth: learn.forest(numTrees=3, maxDepth=maxDepth)
    hist = learn.random_search(df, ["a", "b"], "y", make, {"maxDepth": ("choice", [1, 3])}, "id", n_trials=5, k=3).collect()
    assert [r.trial for r in hist] == list(range(5)) and len(fits) == 15
    for depth in (1, 3):
        mine = {r.value for r in hist if f": {depth}}}" in r.params}
        cv = learn.cross_validate(df, ["a", "b"], "y", make(depth), "id", k=3).first()
        assert len(mine) == 1 and mine.pop() == pytest.approx(cv["cv_mean"], rel=1e-12)
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == 0
