import math

import pytest
from pyspark.errors import PySparkException

from helpers import frame
from tessera.operators import features
from tessera.operators.encode import Encoder


def by_id(df, c):
    return [r[c] for r in df.orderBy("id").collect()]


@pytest.mark.parametrize("limit", [20000, 0])      # literal map, then the join path
def test_label_encode(spark, limit):
    df = frame(spark, [(0, "b"), (1, "a"), (2, "c"), (3, "a")], "id int, f string")
    f = Encoder("label", cols=["f"], literal_limit=limit).fit(df)
    assert by_id(f.transform(df), "f") == [1, 0, 2, 0]
    unseen = frame(spark, [(0, "z")], "id int, f string")
    with pytest.raises((PySparkException, Exception)):
        f.transform(unseen).collect()
    keep = Encoder("label", cols=["f"], handle_unseen="keep", literal_limit=limit).fit(df)
    assert by_id(keep.transform(unseen), "f") == [-1]


def test_onehot(spark):
    df = frame(spark, [(0, "b"), (1, "a")], "id int, f string")
    f = Encoder("onehot", cols=["f"]).fit(df)
    assert f.names() == ["f_a", "f_b"]
    out = f.transform(frame(spark, [(0, "b"), (1, "a"), (2, "z")], "id int, f string"))
    assert [(r.f_a, r.f_b) for r in out.orderBy("id").collect()] == [(0, 1), (1, 0), (0, 0)]


@pytest.mark.parametrize("limit", [20000, 0])
def test_target_encode(spark, limit):
    df = frame(spark, [(0, "a", 1.0), (1, "a", 3.0), (2, "b", 10.0), (3, None, 6.0)],
               "id int, f string, y double")
    f = Encoder("target", cols=["f"], label="y", literal_limit=limit).fit(df)
    out = f.transform(frame(spark, [(0, "a"), (1, "b"), (2, None), (3, "z")], "id int, f string"))
    assert by_id(out, "f") == [2.0, 10.0, 5.0, 5.0]


@pytest.mark.parametrize("limit", [20000, 0])
def test_frequency_encode(spark, limit):
    df = frame(spark, [(0, "a"), (1, "a"), (2, "b"), (3, None)], "id int, f string")
    f = Encoder("frequency", cols=["f"], literal_limit=limit).fit(df)
    got = by_id(f.transform(df), "f")
    assert got[:3] == pytest.approx([2 / 3, 2 / 3, 1 / 3]) and got[3] is None


def test_unknown_encoding():
    with pytest.raises(ValueError):
        Encoder("bogus")


def test_row_sum_mean_cross(spark):
    df = frame(spark, [(0, 1.0, None, 4.0, "x", None)],
               "id int, SF1 double, SF2 double, Area double, a string, b string")
    assert features.row_sum(df, ["SF", "Area"]).first()["Total_Area"] == 5.0
    m = features.row_mean(frame(spark, [(0, 1.0, None, "4")], "id int, Qual1 double, Qual2 double, Cond string"),
                          ["Qual", "Cond"])
    assert m.first()["Quality_Score"] == 2.5
    assert features.crosses(df, ["a", "b"]).first()["a_b"] == "x_nan"


def test_feature_cap():
    cols = [f"c{i}" for i in range(12)]
    assert len(features.polynomial_plan(cols, max_interactions=50)) == 38
    assert len(features.polynomial_plan(cols, max_interactions=15)) == 15


def test_difference_and_ratio(spark):
    df = frame(spark, [(0, 2010, 1990, 4.0, 0.0)], "id int, YrSold int, YearBuilt int, a double, b double")
    assert features.difference(df, "YrSold", "YearBuilt").first()["House_Age"] == 20
    assert features.ratio(df, "a", "b", "r").first()["r"] is None
    assert features.weighted_sum(df, {"a": 0.5}, "w").first()["w"] == 2.0
    assert math.isclose(features.age_from(df, "YearBuilt", 2024, "age").first()["age"], 34)
