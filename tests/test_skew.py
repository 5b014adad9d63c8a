"""Skewed inputs: one key / category holds a third of all rows. The skew-aware
paths must give exactly the brute-force answers (computed here in Python)."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import frame
from tessera.functions.quantiles import column_quantiles
from tessera.functions.shuffle import donor_values
from tessera.operators import clean, ensemble, select
from tessera.operators.encode import Encoder

N = 3000


def skewed_rows(seed=1):
    """(id, user, day, cat, x, y): user 0 and category 'hot' hold a third of rows."""
    rng = random.Random(seed)
    rows = []
    for i in range(N):
        hot = i % 3 == 0
        user = 0 if hot else rng.randint(1, 200)
        cat = "hot" if hot else f"c{rng.randint(0, 2000)}"
        x = None if rng.random() < 0.2 else round(rng.gauss(50, 20), 2)
        y = round((x or 0) * 2 + (10 if hot else 0) + rng.gauss(0, 1), 3)
        rows.append((i, user, i // 40, cat, x, y))
    return rows


SCHEMA = "id int, user int, day int, cat string, x double, y double"


def test_forward_fill_hot_user(spark):
    rows = skewed_rows()
    df = frame(spark, rows, SCHEMA)
    out = clean.forward_fill(df, ["x"], ["user"], ["day", "id"], chunk_by=F.floor(F.col("day") / 5))
    got = {r.id: r.x for r in out.collect()}
    last = {}
    for i, user, day, cat, x, y in sorted(rows, key=lambda r: (r[1], r[2], r[0])):
        if x is not None:
            last[user] = x
        assert got[i] == last.get(user)


@pytest.mark.parametrize("broadcast_limit", [10 ** 6, 0])    # broadcast / salted sort-merge
def test_target_encoding_hot_category_join_path(spark, broadcast_limit):
    rows = skewed_rows(2)
    df = frame(spark, rows, SCHEMA)
    f = Encoder("target", cols=["cat"], label="y", literal_limit=0,
                broadcast_limit=broadcast_limit).fit(df)
    assert f.literal is None
    assert (f.hot == {}) if broadcast_limit else (f.hot["cat"] == ["hot"] or "hot" in f.hot["cat"])
    got = {r.id: r.cat for r in f.transform(df).collect()}
    sums = {}
    for _, _, _, cat, _, y in rows:
        s = sums.setdefault(cat, [0.0, 0])
        s[0] += y
        s[1] += 1
    for i, _, _, cat, _, _ in rows:
        assert math.isclose(got[i], sums[cat][0] / sums[cat][1], rel_tol=1e-12)


def test_mode_and_quantiles_with_hot_value(spark):
    rows = skewed_rows(3)
    df = frame(spark, rows, SCHEMA)
    assert clean.most_frequent(df, ["cat"])["cat"] == "hot"
    xs = np.array([r[4] for r in rows if r[4] is not None])
    got = column_quantiles(df, ["x", "user"], [0.1, 0.5, 0.9], max_bracket=50)
    assert got["x"] == pytest.approx(list(np.quantile(xs, [0.1, 0.5, 0.9])), abs=1e-12)
    users = np.array([r[1] for r in rows])
    assert got["user"] == pytest.approx(list(np.quantile(users, [0.1, 0.5, 0.9])), abs=1e-12)


def test_group_mean_predictions_hot_group(spark):
    rows = skewed_rows(4)
    df = frame(spark, rows, SCHEMA)
    p = ensemble.group_mean_predictions(df, "id", "y", {"by_cat": "cat", "by_user": "user"})
    got = {(r.model, r.id): r.p for r in p.collect()}
    for model, g in (("by_cat", 3), ("by_user", 1)):
        sums = {}
        for r in rows:
            s = sums.setdefault(r[g], [0.0, 0])
            s[0] += r[5]
            s[1] += 1
        for r in rows:
            assert math.isclose(got[(model, r[0])], sums[r[g]][0] / sums[r[g]][1], rel_tol=1e-12)


def test_mutual_information_hot_value_and_shuffle(spark):
    rows = skewed_rows(5)
    df = frame(spark, [(r[0], float(r[1]), r[5]) for r in rows], "id int, u double, y double")
    mi = select.mutual_information(df, "y", ["u"], bins=4).first()["score"]
    assert mi > 0
    d = donor_values(df, "id", ["u"], seed=9)
    got = d.collect()
    assert len(got) == N and sorted(r["__d_u"] for r in got) == sorted(float(r[1]) for r in rows)


def test_group_mean_predictions_salted_path(spark, monkeypatch):
    monkeypatch.setattr(ensemble, "BROADCAST_LIMIT", 0)     # force the salted sort-merge join
    rows = skewed_rows(6)
    df = frame(spark, rows, SCHEMA)
    p = ensemble.group_mean_predictions(df, "id", "y", {"by_cat": "cat"})
    got = {r.id: r.p for r in p.collect()}
    sums = {}
    for r in rows:
        s = sums.setdefault(r[3], [0.0, 0])
        s[0] += r[5]
        s[1] += 1
    assert len(got) == N
    for r in rows:
        assert math.isclose(got[r[0]], sums[r[3]][0] / sums[r[3]][1], rel_tol=1e-12)


def test_lookup_join_paths_agree(spark):
    from tessera.functions.joins import hot_keys, lookup_join, small_side
    rows = skewed_rows(7) + [(N, 1, 0, None, 1.0, 1.0), (N + 1, 1, 0, "unseen", 1.0, 1.0)]
    big = frame(spark, rows, SCHEMA)
    small = frame(spark, [(f"c{i}", float(i)) for i in range(2001)] + [("hot", -1.0)],
                  "k string, v double")
    counts = big.groupBy(F.col("cat").alias("k")).agg(F.count("*").alias("n")).where("k IS NOT NULL")
    hot = hot_keys(counts, "k", "n", 0.05).get(None, [])
    assert hot == ["hot"]
    results = []
    for bc, h in ((True, []), (False, []), (False, hot)):
        j = lookup_join(big, small, F.col("cat"), "k", broadcast=bc, hot=h)
        results.append(sorted((r.id, r.v) for r in j.select("id", "v").collect()))
    assert results[0] == results[1] == results[2] and len(results[0]) == N + 2
    assert small_side(small).count() == small.count()


def _big_and_small(n=600):
    return [(i, f"c{i % 300}", None if i % 5 == 0 else f"p{i % 4}", float(i % 7)) for i in range(n)]


def test_a_small_map_is_broadcast_beside_a_large_one(spark):
    from tessera.operators.encode import Encoder
    df = spark.createDataFrame(_big_and_small(), "id int, cust string, prio string, y double")
    for how in ("label", "target", "frequency"):
        def run(limit):
            f = Encoder(how, cols=["cust", "prio"], label="y", literal_limit=0, broadcast_limit=limit).fit(df)
            return f, sorted(map(tuple, f.transform(df).select("id", "cust", "prio").collect()), key=repr)
        mixed, got = run(100)
        assert mixed.broadcast == ["prio"] and set(mixed.hot) <= {"cust"}
        plan = mixed.transform(df)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("strategy=broadcast") == 1 and plan.count("LeftOuter") == 2
        assert run(0)[0].broadcast == [] and run(1000)[0].broadcast == ["cust", "prio"]
        assert got == run(0)[1] == run(1000)[1]


def test_rows_without_a_key_are_dealt_over_join_tasks(spark):
    from tessera.functions.joins import lookup_join
    big = spark.range(2000).select("id", F.when(F.col("id") % 4 == 0, F.col("id").cast("string")).alias("k"))
    small = spark.range(0, 2000, 8).select(F.col("id").cast("string").alias("c"), F.lit(1.0).alias("v"))
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for hot in ([], ["0"]):
            out = lookup_join(big, small, F.col("k"), "c", broadcast=False, hot=hot)
            assert out.columns == ["id", "k", "c", "v"]
            assert out.agg(F.count("*"), F.sum("v")).first() == (2000, 250.0)
            tasks = out.where("k IS NULL").groupBy(F.spark_partition_id().alias("t")).count().collect()
            assert len(tasks) >= 6 and max(r["count"] for r in tasks) < 750
            # the same rows are dealt when the filter is not pushed below the join
            parts = out.select("k", F.spark_partition_id().alias("t")).collect()
            assert len({r.t for r in parts if r.k is None}) >= 6
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
