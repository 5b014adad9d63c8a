"""Missing values, un-grouped reports and edge cases of earlier operators."""

import math

import pytest
from pyspark.sql import functions as F

from tessera.operators import clean, encode, ensemble, evaluate, features, learn, profile, scale
from tessera.sources import scan

NAN = float("nan")


def frame(spark):
    return spark.createDataFrame([(1.0, "a"), (NAN, "b"), (3.0, None), (3.0, "a"), (None, "a")], "x double, c string")


def test_nan_is_null_in_fits(spark):
    df = frame(spark)
    assert profile.missing_summary(df).where("Feature = 'x'").first()["Missing_Count"] == 2
    for strategy, want in (("mean", 7 / 3), ("median", 3.0), ("mode", 3.0)):
        got = [r[0] for r in clean.Imputer(strategy, cols=["x"]).fit(df).transform(df).select("x").collect()]
        assert got == [1.0, pytest.approx(want), 3.0, 3.0, pytest.approx(want)], strategy
    for how in ("standard", "minmax"):
        got = [r[0] for r in scale.Scaler(how, cols=["x"]).fit(df).transform(df).select("x").collect()]
        assert not math.isnan(got[0]) and not math.isnan(got[2])


def test_target_code_of_category_without_labels(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", None)], "c string, y double")
    got = encode.Encoder("target", cols=["c"], label="y").fit(df).transform(df).select("c").collect()
    assert [r[0] for r in got] == [2.0, 2.0, 2.0]


def test_reports_without_groups(spark):
    df = spark.createDataFrame([(float(i), i + 0.5 * (i % 3)) for i in range(40)], "y double, p double")
    assert evaluate.scatter_bins(df, by=()).agg(F.sum("n")).first()[0] == 40
    assert evaluate.error_histogram(df, by=(), bins=5).agg(F.sum("n"), F.count("*")).first() == (40, 5)
    assert evaluate.error_box(df, by=()).first()["median"] == -0.5


def test_all_columns_and_degree(spark):
    cols = [f"c{i}" for i in range(12)]
    df = spark.createDataFrame([tuple(float(i) for i in range(12))], ", ".join(f"{c} double" for c in cols))
    assert len(features.polynomial_features(df).columns) == 12 + 12 + 66
    assert features.polynomial_features(df, degree=1).columns == cols
    assert len(features.polynomial_features(df, max_squares=2, max_pairs_cols=3).columns) == 12 + 2 + 3


def test_quoted_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,t\n1,"a ""b"", c"\n2,"x\ny"\n')
    got = scan.read_csv(spark, str(tmp_path / "a.csv"), multi_line=True).collect()
    assert [r["t"] for r in got] == ['a "b", c', "x\ny"]


def test_stacking_keeps_keys(spark):
    rows = [(k, m, k + d, float(k)) for k in range(20) for m, d in (("a", 0.1), ("b", -0.2)) if (k, m) != (3, "b")]
    df = spark.createDataFrame(rows, "id int, model string, p double, y double")
    va, model = ensemble.fit_stacking(df, "id", "y", ["a", "b"])
    got = {r["id"]: r["prediction"] for r in ensemble.predict_stacking(va, model, df, "id", ["a", "b"]).collect()}
    assert len(got) == 20 and got[3] is None and abs(got[10] - 10) < 1


def test_search_raises_other_errors(spark):
    df = spark.createDataFrame([(i, float(i), float(i)) for i in range(30)], "id int, x double, y double")

    def broken(**_):
        raise OSError("lost")

    with pytest.raises(OSError):
        learn.random_search(df, ["x"], "y", broken, {"maxDepth": ("int", 2, 3)}, "id", n_trials=1)
    with pytest.raises(ValueError):
        learn.random_search(df, ["x"], "y", lambda **_: (_ for _ in ()).throw(ValueError("bad")),
                            {"maxDepth": ("int", 2, 3)}, "id", n_trials=2)


def test_balanced_flag_needs_no_refinement(spark, monkeypatch):
    from tessera.functions import quantiles as qs
    df = spark.range(4000).select((F.col("id") % 2).cast("double").alias("x"))
    monkeypatch.setattr(qs, "_refine", lambda *a: pytest.fail("a bracket without inner values was refined"))
    assert qs.column_quantiles(df, ["x"], [0.25, 0.5, 0.75], max_bracket=10)["x"] == [0.0, 0.5, 1.0]


@pytest.mark.parametrize("bracket", [5, 50000])
def test_grouped_quantiles_by_join(spark, bracket):
    import numpy as np
    from tessera.functions.quantiles import quantiles
    rng = np.random.default_rng(5)
    rows = [(None if g == 0 else f"g{g}", g % 2, float(v), float(rng.integers(0, 3)))
            for g in range(12) for v in np.concatenate([rng.normal(size=200), [1e308, -1e308]])]
    df = spark.createDataFrame(rows, "g string, h int, x double, y double")
    got = quantiles(df, ["x", "y"], [0.1, 0.5, 0.9], by=["g", "h"], max_bracket=bracket, accuracy=20)
    for (g, h), i, c in {((r[0], r[1]), i, c) for r in rows for i, c in ((2, "x"), (3, "y"))}:
        want = np.quantile([r[i] for r in rows if (r[0], r[1]) == (g, h)], [0.1, 0.5, 0.9])
        assert got[((g, h), c)] == pytest.approx(list(want), rel=1e-12)


def test_equal_hot_rows_get_several_salts(spark):
    from tessera.functions.joins import lookup_join
    big = spark.range(300).repartition(8).select(F.lit("hot").alias("k"))
    small = spark.createDataFrame([("hot", 1.0), ("cold", 2.0)], "c string, v double")
    out = lookup_join(big, small, F.col("k"), "c", broadcast=False, hot=["hot"])
    assert out.agg(F.count("*"), F.sum("v")).first() == (300, 300.0)
    salts = big.select(F.pmod(F.xxhash64(F.spark_partition_id(), "k"), F.lit(64))).distinct().count()
    assert salts > 1


def test_group_mean_cv_salted_equals_broadcast(spark, monkeypatch):
    rows = [(i, None if i % 11 == 0 else ("hot" if i % 3 else f"c{i % 40}"), i % 2,
             None if i % 13 == 0 else float(i % 7)) for i in range(400)]
    df = spark.createDataFrame(rows, "id int, g string, h int, y double")
    for groups in (["g"], ["g", "h"]):
        def run():
            return sorted(map(tuple, ensemble.group_mean_cv(df, "id", "y", groups, k=4, method="modulo").collect()), key=repr)
        with monkeypatch.context() as m:
            want = run()
            m.setattr(ensemble, "BROADCAST_LIMIT", 0)
            got = run()
        assert len(got) == 400 and [r[:3] for r in got] == [r[:3] for r in want]
        assert [r[3] for r in got] == pytest.approx([r[3] for r in want])


def test_encoder_reads_its_input_once(spark):
    acc = spark.sparkContext.accumulator(0)

    def count(parts):
        for b in parts:
            acc.add(b.num_rows)
            yield b
    base = spark.createDataFrame([(f"c{i % 90}", float(i)) for i in range(360)], "c string, y double")
    for how in ("label", "target", "frequency", "onehot"):
        before = acc.value
        df = base.mapInArrow(count, base.schema)
        encode.Encoder(how, cols=["c"], label="y", broadcast_limit=0).fit(df)
        assert acc.value - before == 360, how


def test_job_ranks_and_saves_the_ensemble(spark, tmpdir_path):
    from tessera.plans.jobs import train_and_score
    df = spark.createDataFrame([(i, float(i % 37), float(i % 5), float(i % 37) * 3 + i % 5) for i in range(300)],
                               "id int, a double, b double, y double")
    out = train_and_score(df.where("id % 5 <> 0"), df.where("id % 5 = 0"), "id", "y",
                          learners=("random_forest", "xgboost"), select_features=False,
                          forest_params={"numTrees": 5, "maxDepth": 4},
                          gbt_params={"maxIter": 4, "maxDepth": 3}, out_dir=f"{tmpdir_path}/preds")
    rank = out["ranking"].orderBy("rank").collect()
    assert {r.model for r in rank} == {"random_forest", "xgboost", "ensemble"} and rank[0].is_best
    assert rank[0].rmse <= rank[1].rmse <= rank[2].rmse
    assert spark.read.parquet(f"{tmpdir_path}/preds_ensemble").count() == 60
