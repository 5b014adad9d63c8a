"""The job on a wide table, its saved artifact, sparse one-hot, data-driven fill chunks."""

import numpy as np
from pyspark.sql import functions as F

from helpers import frame
from tessera.operators import clean, learn
from tessera.operators.base import load
from tessera.operators.encode import Encoder
from tessera.plans import jobs
from tessera.plans.artifact import load_scorer
from tessera.session import cut_lineage


def test_job_on_a_wide_table(spark, tmpdir_path):
    """43 categorical and 36 numeric columns: generated columns stay within the declared
    limits, all three methods vote, boosting stops early, the ensemble is stacked, the
    artifact scores the same in another session."""
    r = np.random.default_rng(1)
    n = 150
    num = r.normal(size=(n, 34)).round(3)
    rows = []
    for i in range(n):
        cats = [f"v{(i * (k + 3) + k) % 3}" if (i + k) % 23 else None for k in range(43)]
        rows.append((i, *cats, *map(float, num[i]), 2000 + i % 9, 1950 + i % 40, float(8 * num[i, 0] - 5 * num[i, 1] + 0.2 * r.normal())))
    names = [f"cat{k}" for k in range(43)] + [f"num{k}" for k in range(30)] + ["FirstSF", "GrLivArea", "OverallQual", "OverallCond", "YrSold", "YearBuilt"]
    df = spark.createDataFrame(rows, ["Id", *names, "SalePrice"])
    train, test = df.where("Id % 5 <> 0"), df.where("Id % 5 = 0")
    path = f"{tmpdir_path}/artifact"
    small = learn.forest(numTrees=3, maxDepth=3)
    out = jobs.train_and_score(train, test.drop("SalePrice"), "Id", "SalePrice", learners=("random_forest", "xgboost"),
                               forest_params={"numTrees": 5, "maxDepth": 4}, gbt_params={"maxIter": 8, "maxDepth": 2, "stepSize": 0.5},
                               patience=2, stacking=2, save_to=path, min_features=10, max_features=12,
                               selection_params={"Boruta": {"estimator": small, "iterations": 1}, "Permutation": {"estimator": small, "n_repeats": 1}})
    votes = {t["feature"]: t for t in out["selected"].collect()}
    made = set(votes) - set(names)
    assert {"Total_Area", "Quality_Score", "House_Age"} <= made
    crosses = {c for c in made if c.startswith("cat")}
    products = made - crosses - {"Total_Area", "Quality_Score", "House_Age"}
    assert len(crosses) >= 10 and {c for c in crosses if c.count("cat") == 2 and "_x_" not in c and not c.endswith("_squared")} == {
        f"cat{a}_cat{b}" for a in range(5) for b in range(a + 1, 5)}
    assert len([c for c in made if c.endswith("_squared") or "_x_" in c]) == 38 and len(votes) <= 79 + 3 + 10 + 38 and products is not None
    assert sum(t["selected"] for t in votes.values()) == 12
    scorer = load_scorer(spark.newSession(), path)
    assert scorer.stack is not None and set(scorer.models) == {"random_forest", "xgboost"}
    assert scorer.models["xgboost"].stages[-1].getNumTrees <= 8
    members = cut_lineage(scorer.members(test.drop("SalePrice")))
    one = {(t["model"], t["Id"]): t["prediction"] for t in out["predictions"].collect()}
    assert {(t["model"], t["Id"]): t["prediction"] for t in members.collect()} == one and len(one) == 60
    first = {t["Id"]: t["prediction"] for t in out["ensemble"].collect()}
    again = {t["Id"]: t["prediction"] for t in scorer.combined(members).collect()}
    assert set(first) == set(again) and all(abs(first[k] - again[k]) < 1e-9 for k in first)


def test_job_search_and_cv(spark):
    df = spark.createDataFrame([(i, float(i % 37), float(i % 5), float(i % 37) * 3 + i % 5) for i in range(90)], "id int, a double, b double, y double")
    space, learn.SEARCH_SPACES["random_forest"] = learn.SEARCH_SPACES["random_forest"], {"maxDepth": ("int", 2, 4)}
    try:
        out = jobs.train_and_score(df.where("id % 3 <> 0"), df.where("id % 3 = 0"), "id", "y", learners=("random_forest",),
                                   select_features=False, forest_params={"numTrees": 2}, cv_folds=2, search_trials=2, search_folds=2)
    finally:
        learn.SEARCH_SPACES["random_forest"] = space
    assert out["search"].count() == 2 and {t["model"] for t in out["search"].collect()} == {"random_forest"}
    assert out["cv"].select("model", "fold").distinct().count() == 2 and out["ranking"].count() == 2


def test_sparse_onehot(spark, tmpdir_path):
    fit = frame(spark, [(i, f"c{i % 1500:04d}" if i % 1501 else None, "x" if i % 2 else "y") for i in range(3002)], "id int, many string, two string")
    new = frame(spark, [(1, "c0000", "x"), (2, "c1499", "y"), (3, "unseen", "z"), (4, None, None)], "id int, many string, two string")
    for limit in (200_000, 0):
        fitted = Encoder("onehot_sparse", cols=["many", "two"], broadcast_limit=limit).fit(fit)
        fitted.save(f"{tmpdir_path}/e{limit}")
        for enc in (fitted, load(spark, f"{tmpdir_path}/e{limit}")):
            out = {t["id"]: t for t in enc.transform(new).collect()}
            assert out[1]["many"] == "c0000" and out[1]["many_onehot"].size == 1501 and out[1]["two_onehot"].size == 2
            place = {i: (t["many_onehot"].indices.tolist(), t["two_onehot"].indices.tolist()) for i, t in out.items()}
            assert place == {1: ([0], [0]), 2: ([1499], [1]), 3: ([], []), 4: ([1500], [])}
    assert Encoder("onehot_sparse", cols=[]).fit(fit).transform(new).columns == new.columns


def test_fill_cuts_hot_keys(spark):
    """A third of all rows under one key, ties and nulls in the order: as the plain window, with bounded chunks."""
    rows = [(None if i % 50 == 0 else 1 if i % 3 == 0 else i % 40, None if i % 97 == 0 else float(i // 4), i, float(i) if i % 5 == 0 else None, None if i % 7 else f"s{i}")
            for i in range(3000)]
    df = frame(spark, rows, "k int, t double, id int, x double, s string").repartition(6)
    plain = sorted(map(tuple, clean.forward_fill(df, ["x", "s"], ["k"], ["t", "id"]).collect()), key=str)
    cut = clean.forward_fill(df, ["x", "s"], ["k"], ["t", "id"], chunk_rows=100)
    assert cut.columns == df.columns and sorted(map(tuple, cut.collect()), key=str) == plain
    with_cuts, chunk = clean._cut_hot_keys(df, ["k"], "t", 100)
    sizes = [t["count"] for t in with_cuts.select("k", chunk.alias("c")).groupBy("k", "c").count().collect()]
    hot = sorted(t["count"] for t in with_cuts.select("k", chunk.alias("c")).where("k = 1").groupBy("c").count().collect())
    assert max(sizes) <= 200 and len(hot) >= 8 and hot[-1] <= 2 * hot[len(hot) // 2]
    text = clean.forward_fill(df.withColumn("t", F.lpad(F.col("id").cast("string"), 6, "0")), ["x"], ["k"], ["t"], chunk_rows=100)
    assert text.count() == 3000
