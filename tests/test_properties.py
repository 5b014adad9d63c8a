"""Property checks on generated inputs."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import frame
from tessera.operators import clean, ensemble, scale
from tessera.operators.encode import Encoder

SETTINGS = dict(max_examples=8, deadline=None,
                suppress_health_check=[HealthCheck.function_scoped_fixture])

cats = st.lists(st.sampled_from(["a", "b", "c", "d"]), min_size=1, max_size=30)
nums = st.lists(st.floats(-1e6, 1e6, allow_nan=False), min_size=2, max_size=30)


@settings(**SETTINGS)
@given(values=cats)
def test_onehot_rows_sum_to_one_for_seen(spark, values):
    df = frame(spark, list(enumerate(values)), "id int, f string")
    f = Encoder("onehot", cols=["f"]).fit(df)
    out = f.transform(df)
    total = sum((F.col(f"`{n}`").cast("int") for n in f.names()), F.lit(0))
    assert out.select(total.alias("s")).where("s <> 1").count() == 0


@settings(**SETTINGS)
@given(values=cats)
def test_frequency_codes_sum_to_one(spark, values):
    df = frame(spark, list(enumerate(values)), "id int, f string")
    f = Encoder("frequency", cols=["f"]).fit(df)
    assert math.isclose(sum(f.literal["f"].values()), 1.0)


@settings(**SETTINGS)
@given(w=st.dictionaries(st.sampled_from(["m1", "m2", "m3"]), st.floats(0.01, 10), min_size=1))
def test_normalised_weights_sum_to_one(w):
    assert math.isclose(sum(ensemble.normalized_weights(w).values()), 1.0)


@settings(**SETTINGS)
@given(p1=nums, p2=nums)
def test_ensemble_within_member_range(spark, p1, p2):
    n = min(len(p1), len(p2))
    rows = [("m1", i, p1[i]) for i in range(n)] + [("m2", i, p2[i]) for i in range(n)]
    preds = frame(spark, rows, "model string, id int, p double")
    for e in (ensemble.weighted_average(preds, "id", {"m1": 0.3, "m2": 0.7}),
              ensemble.mean_vote(preds, "id")):
        for r in e.collect():
            lo, hi = min(p1[r.id], p2[r.id]), max(p1[r.id], p2[r.id])
            assert lo - 1e-6 * max(1, abs(lo)) <= r.prediction <= hi + 1e-6 * max(1, abs(hi))


@settings(**SETTINGS)
@given(train=nums, test=nums)
def test_fit_never_reads_test_rows(spark, train, test):
    """Statistics fitted on the train rows do not change when test rows change."""
    rows = [(i, "train", v) for i, v in enumerate(train)]
    a = frame(spark, rows + [(1000 + i, "test", v) for i, v in enumerate(test)],
              "id int, split string, x double")
    b = frame(spark, rows + [(1000 + i, "test", -v * 3 + 7) for i, v in enumerate(test)],
              "id int, split string, x double")
    for op in (scale.Scaler("robust", cols=["x"]), scale.Scaler("standard", cols=["x"]),
               clean.Imputer("median", cols=["x"]), clean.OutlierClipper("iqr", cols=["x"])):
        fa = op.fit(a.where("split = 'train'")).numbers()
        fb = op.fit(b.where("split = 'train'")).numbers()
        assert fa == fb
