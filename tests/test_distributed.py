"""Properties of the distributed building blocks: exact quantiles, the keyed
shuffle, folds, the chain, sinks, save/load, streaming, learners."""

import math
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import frame
from tessera.functions.quantiles import column_quantiles, quantiles
from tessera.functions.shuffle import donor_values
from tessera.operators import clean, ensemble, learn, scale, select, split
from tessera.operators.encode import Encoder
from tessera.plans.chain import Chain
from tessera.sources import scan, sinks


@pytest.mark.parametrize("method", ["linear", "inverted_cdf"])
def test_quantiles_match_numpy(spark, method):
    rng = random.Random(7)
    vals = [float(rng.choice([1, 2, 2, 3, 5, 8, 13])) if i % 3 else rng.gauss(0, 10) for i in range(3000)]
    df = frame(spark, [(i, v) for i, v in enumerate(vals)], "id int, x double")
    probs = [0, 0.01, 0.1, 0.25, 0.5, 0.75, 0.9, 0.99, 1]
    for mb in (50000, 10):          # the second forces histogram refinement
        got = column_quantiles(df, ["x"], probs, max_bracket=mb, bins=8, interpolation=method)["x"]
        want = np.quantile(np.array(vals), probs, method=method)
        assert got == pytest.approx(list(want), rel=1e-12, abs=1e-12)


def test_grouped_quantiles(spark):
    df = frame(spark, [("a" if i % 2 else "b", float(i)) for i in range(101)], "g string, x double")
    got = quantiles(df, ["x"], [0.25, 0.5], by=["g"])
    # a = 1, 3, …, 99 (50 values); b = 0, 2, …, 100 (51 values)
    assert got[(("a",), "x")] == [25.5, 50.0] and got[(("b",), "x")] == [25.0, 50.0]


def test_keyed_shuffle_is_a_permutation(spark):
    df = frame(spark, [(i, float(i)) for i in range(500)], "id int, x double")
    d = donor_values(df, "id", ["x"], seed=3, buckets=7)
    rows = d.collect()
    assert len(rows) == 500
    assert sorted(r["__d_x"] for r in rows) == [float(i) for i in range(500)]
    assert sum(r["__d_x"] == r["x"] for r in rows) < 50


def test_keyed_shuffle_is_one_exchange(spark):
    from pyspark.sql import Window
    rows = [(f"k{i}", None if i % 9 == 0 else float(i), i % 3 == 0, f"t{i % 7}") for i in range(400)]
    df = spark.createDataFrame(rows, "id string, x double, b boolean, t string")
    d = donor_values(df, "id", ["x", "t"], seed=3, buckets=5, prefix="p_")
    assert d.columns == ["id", "x", "b", "t", "p_x", "p_t"] and [t for _, t in d.dtypes] == ["string", "double", "boolean", "string", "double", "string"]
    assert d._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    # the row at slot i of a bucket has the values of its i-th donor
    bucket = F.pmod(F.xxhash64("id", F.lit("b"), F.lit(3)), F.lit(5))

    def rank(by):
        return F.row_number().over(Window.partitionBy(bucket).orderBy(F.xxhash64("id", F.lit(by), F.lit(3)))).alias("i")
    donors = df.select(bucket.alias("g"), rank("d"), F.col("x").alias("p_x"), F.col("t").alias("p_t"))
    want = df.select("*", bucket.alias("g"), rank("s")).join(donors, ["g", "i"]).drop("g", "i")
    assert sorted(map(tuple, d.collect())) == sorted(map(tuple, want.collect()))


def test_keyed_shuffle_of_equal_and_missing_keys(spark):
    rows = [(None if i % 4 == 0 else i % 4, float(i)) for i in range(100)]
    d = donor_values(spark.createDataFrame(rows, "id int, x double"), "id", ["x"], buckets=2)
    got = [tuple(r) for r in d.collect()]
    assert sorted(r[1] for r in got) == sorted(r[2] for r in got) == [float(i) for i in range(100)]


def test_buckets_are_bounded_by_rows_and_cells(spark):
    from tessera.functions.shuffle import bucket_count
    df = spark.range(1)
    assert bucket_count(df, 10, 3) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert bucket_count(df, 2_000_000_000, 3) == 1000
    assert bucket_count(df, 1 << 30, 1 << 10) == 1 << 16


def test_folds_partition_keys(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    f = split.with_folds(df, "k", 5)
    counts = {r.fold: r["count"] for r in f.groupBy("fold").count().collect()}
    assert sum(counts.values()) == 1000 and set(counts) == set(range(5))
    assert split.holdout(df, "k", 0.2, method="modulo").where("split = 'test'").count() == 200


def test_chain_fits_on_previous_output(spark):
    df = frame(spark, [(i, None if i == 0 else float(i), "a" if i % 2 else None, float(10 * i))
                       for i in range(10)], "id int, x double, c string, y double")
    chain = Chain([clean.Imputer("median", exclude=["id", "y"]),
                   clean.Imputer("most_frequent", kind="categorical"),
                   Encoder("target", cols=["c"], label="y"),
                   scale.Scaler("minmax", exclude=["id", "y"])])
    out = chain.fit(df).transform(df)
    xs = [r.x for r in out.orderBy("id").collect()]
    assert min(xs) == 0.0 and max(xs) == 1.0
    cs = {r.c for r in out.collect()}
    assert cs == {0.0}        # one category after imputation → constant → scaled to 0


def test_stacking_equals_closed_form_ridge(spark):
    rng = np.random.default_rng(1)
    n = 200
    y = rng.normal(100, 20, n)
    p1 = y + rng.normal(0, 5, n)
    p2 = 0.5 * y + rng.normal(0, 10, n)
    rows = [("m1", i, float(y[i]), float(p1[i])) for i in range(n)] + \
           [("m2", i, float(y[i]), float(p2[i])) for i in range(n)]
    preds = frame(spark, rows, "model string, id int, y double, p double")
    va, model = ensemble.fit_stacking(preds, "id", "y", ["m1", "m2"], alpha=1.0)
    X = np.column_stack([p1, p2])
    Xc, yc = X - X.mean(0), y - y.mean()
    w = np.linalg.solve(Xc.T @ Xc + 1.0 * np.eye(2), Xc.T @ yc)
    assert np.allclose(model.coefficients.toArray(), w, rtol=1e-6)


def test_sinks_roundtrip(spark, tmpdir_path):
    preds = frame(spark, [("a", 1, 1.0), ("a", 2, 3.0), ("b", 1, 2.0)], "model string, id int, prediction double")
    for fmt in ("parquet", "csv", "json"):
        path = os.path.join(tmpdir_path, fmt)
        sinks.write_predictions(preds, path, fmt)
        back = sinks.read_predictions(spark, path, fmt)
        s = {r.model: (r.n_rows, r.min_prediction, r.max_prediction)
             for r in sinks.prediction_summary(back).collect()}
        assert s == {"a": (2, 1.0, 3.0), "b": (1, 2.0, 2.0)}


def test_csv_na_tokens(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "in.csv")
    with open(path, "w") as fh:
        fh.write("Id,Alley,LotArea\n1,NA,8450\n2,None,abc\n3,Grvl,\n")
    df = scan.read_csv(spark, path, "Id int, Alley string, LotArea double")
    rows = [tuple(r) for r in df.orderBy("Id").collect()]
    assert rows == [(1, None, 8450.0), (2, None, None), (3, "Grvl", None)]
    assert scan.load_ids(spark, path, "Id", fmt="csv").columns == ["Id"]
    assert scan.contract_of(df) == [("Id", "int"), ("Alley", "string"), ("LotArea", "double")]
    assert scan.split_roles(df, "Id", "LotArea") == (["Alley"], "Id", "LotArea")
    inferred = scan.read_csv(spark, path)           # NA tokens do not force text
    assert dict(inferred.dtypes) == {"Id": "bigint", "Alley": "string", "LotArea": "string"}
    with open(os.path.join(tmpdir_path, "num.csv"), "w") as fh:
        fh.write("Id,LotArea,Frontage\n1,8450,65.5\n2,NA,\n3,9600,80\n")
    num = scan.read_csv(spark, os.path.join(tmpdir_path, "num.csv"))
    assert dict(num.dtypes) == {"Id": "bigint", "LotArea": "bigint", "Frontage": "double"}


def test_model_and_stats_save_load(spark, tmpdir_path):
    from pyspark.ml import PipelineModel
    df = frame(spark, [(i, float(i), float(2 * i)) for i in range(50)], "id int, x double, y double")
    f = scale.Scaler("standard", cols=["x"]).fit(df)
    f.save(os.path.join(tmpdir_path, "scaler"))
    from tessera.operators.base import load_meta, stats_to_numbers
    meta, stats = load_meta(spark, os.path.join(tmpdir_path, "scaler"))
    assert meta["params"]["strategy"] == "standard"
    assert stats.count() == 2
    m = learn.fit(df, ["x"], "y", learn.forest(numTrees=3, maxDepth=3))
    m.write().overwrite().save(os.path.join(tmpdir_path, "model"))
    m2 = PipelineModel.load(os.path.join(tmpdir_path, "model"))
    a = [r.prediction for r in m.transform(df).orderBy("id").collect()]
    b = [r.prediction for r in m2.transform(df).orderBy("id").collect()]
    assert a == b
    search = frame(spark, [(0, '{"a": 1}', 2.0), (1, '{"a": 2}', 1.0)], "trial int, params string, value double")
    sinks.write_search_results(search, os.path.join(tmpdir_path, "search"))
    assert learn.best_params(spark.read.json(os.path.join(tmpdir_path, "search")), {"b": 3}) == {"a": 2, "b": 3}


def test_forest_beats_mean_and_is_seeded(spark):
    rng = np.random.default_rng(3)
    rows = [(i, float(a), float(b), float(3 * a - 2 * b + rng.normal(0, 0.1)))
            for i, (a, b) in enumerate(rng.normal(size=(400, 2)))]
    df = frame(spark, rows, "id int, a double, b double, y double")
    est = learn.forest(numTrees=10, maxDepth=5)
    m = learn.fit(df, ["a", "b"], "y", est)
    assert learn.train_score(m, df, "y").first()["r2"] > 0.5
    m2 = learn.fit(df, ["a", "b"], "y", est)
    p1 = [r.prediction for r in m.transform(df).orderBy("id").collect()]
    p2 = [r.prediction for r in m2.transform(df).orderBy("id").collect()]
    assert p1 == p2
    cv = learn.cross_validate(df, ["a", "b"], "y", est, "id", k=3)
    assert cv.count() == 3


def test_permutation_ranks_informative_feature(spark):
    rng = np.random.default_rng(5)
    rows = [(i, float(a), float(n), float(4 * a + rng.normal(0, 0.1)))
            for i, (a, n) in enumerate(rng.normal(size=(300, 2)))]
    df = frame(spark, rows, "id int, signal double, noise double, y double")
    imp = {r.feature: r.score for r in select.permutation_importance(
        df, "id", ["signal", "noise"], "y", learn.forest(numTrees=10, maxDepth=5), n_repeats=2).collect()}
    assert imp["signal"] > imp["noise"]


def test_group_mean_cv_matches_refit(spark):
    rows = [(i, "a" if i % 3 else "b", float(i % 7)) for i in range(60)]
    df = frame(spark, rows, "id int, g string, y double")
    p = {r.id: r.p for r in ensemble.group_mean_cv(df, "id", "y", ["g"], k=5, method="modulo").collect()}
    for i in (0, 7, 13):
        f = i % 5
        train = [r for r in rows if r[0] % 5 != f and r[1] == rows[i][1]]
        assert math.isclose(p[i], sum(r[2] for r in train) / len(train))


def test_streaming_transform(spark, tmpdir_path):
    from tessera.streaming import score
    df = frame(spark, [(i, float(i), "a" if i % 2 else "b") for i in range(20)], "id int, x double, c string")
    fitted = Chain([scale.Scaler("minmax", cols=["x"]), Encoder("frequency", cols=["c"])],
                   materialize=False).fit(df)
    src = os.path.join(tmpdir_path, "src")
    df.write.parquet(src)
    stream = spark.readStream.schema(df.schema).parquet(src)
    q = score.start(score.transform_stream(fitted, stream), "tessera_stream_test", sink="memory")
    q.awaitTermination(60)
    got = spark.sql("SELECT * FROM tessera_stream_test").orderBy("id").collect()
    assert len(got) == 20 and got[-1].x == 1.0 and got[0].c == 0.5
    with pytest.raises(ValueError):
        score.transform_stream(fitted, df)              # batch input is refused
    batch = fitted.transform(df).withColumn("y", F.col("x") * 2)
    model = learn.fit(batch, ["x", "c"], "y", learn.forest(numTrees=3, maxDepth=3))
    q2 = score.start(score.predict_stream(fitted, model, stream, "id"), "tessera_pred_test",
                     sink="memory")
    q2.awaitTermination(60)
    assert spark.sql("SELECT * FROM tessera_pred_test").count() == 20


def test_train_and_score_job(spark, tmpdir_path):
    from tessera.plans.jobs import train_and_score
    rng = np.random.default_rng(11)
    rows = []
    for i in range(400):
        a, b = rng.normal(size=2)
        c = "x" if i % 3 else "y"
        rows.append((i, float(a), float(b), c, None if i % 17 == 0 else "NA" if i % 19 == 0 else "Gd",
                     float(5 * a + (2 if c == "x" else -2) + rng.normal(0, 0.2))))
    df = frame(spark, rows, "Id int, a double, b double, c string, PoolQC string, SalePrice double")
    train, test = df.where("Id % 5 <> 0"), df.where("Id % 5 = 0")
    out = train_and_score(train, test, "Id", "SalePrice", learners=("random_forest", "xgboost"),
                          forest_params={"numTrees": 10, "maxDepth": 5},
                          gbt_params={"maxIter": 10, "maxDepth": 3}, min_features=2,
                          selection=("Mutual Information",),
                          out_dir=os.path.join(tmpdir_path, "preds"))
    assert out["ensemble"].count() == 80
    m = {r.model: r.r2 for r in out["score_metrics"].collect()}
    assert set(m) == {"random_forest", "xgboost"} and min(m.values()) > 0.5
    assert spark.read.parquet(os.path.join(tmpdir_path, "preds")).count() == 160


def test_dense_index_matches_sorted_order(spark):
    from tessera.functions.rank import dense_index
    rng = random.Random(4)
    rows = {(f"f{rng.randint(0, 3)}", f"v{rng.randint(0, 400):04d}") for _ in range(1500)}
    df = frame(spark, sorted(rows), "feature string, category string").repartition(13)
    got = {(r.feature, r.category): r.code for r in dense_index(df, "feature", "category").collect()}
    for f in {r[0] for r in rows}:
        cats = sorted(c for g, c in rows if g == f)
        assert [got[(f, c)] for c in cats] == list(range(len(cats)))


@pytest.mark.parametrize("limit", [20000, 0])
def test_fitted_chain_save_load(spark, tmpdir_path, limit):
    from tessera.operators.base import load
    df = frame(spark, [(i, None if i == 0 else float(i), "a" if i % 3 else "b",
                        None if i == 5 else "NA", float(10 * i)) for i in range(12)],
               "id int, x double, c string, PoolQC string, y double")
    from tessera.plans.jobs import default_chain
    chain = Chain([*default_chain("id", "y").stages[:4], Encoder("label", cols=["c"], literal_limit=limit),
                   Encoder("target", cols=["PoolQC"], label="y", literal_limit=limit),
                   scale.Scaler("standard", exclude=["id", "y"])], materialize=False)
    fitted = chain.fit(df)
    path = os.path.join(tmpdir_path, f"chain{limit}")
    fitted.save(path)
    back = load(spark, path)
    a = [tuple(r) for r in fitted.transform(df).orderBy("id").collect()]
    b = [tuple(r) for r in back.transform(df).orderBy("id").collect()]
    assert a == b


def test_gbt_split_counts(spark):
    rows = [(i, float(i % 7), float(i % 3), 0.0, float(i % 7) * 2 + (i % 3)) for i in range(300)]
    df = frame(spark, rows, "id int, a double, b double, dead double, y double")
    m = learn.fit(df, ["a", "b", "dead"], "y", learn.gbt("xgboost", maxIter=3, maxDepth=2))
    got = {r.feature: r.splits for r in learn.split_counts(m, ["a", "b", "dead"]).collect()}
    assert got["dead"] == 0 and got["a"] > 0
    internal = sum(t.numNodes // 2 for t in m.stages[-1].trees)     # binary trees
    assert sum(got.values()) == internal
