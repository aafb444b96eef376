import math

import pytest
from pyspark.sql import functions as F

from vantage.functions.columns import haversine_km, percent, round_half_away, safe_rate, tier_label


def test_haversine_cases(spark):
    rows = [(1, 10.0, 20.0, 10.0, 20.0), (2, 0.0, 0.0, 0.0, 180.0), (3, None, 1.0, 2.0, 3.0),
            (4, -23.55, -46.63, -22.90, -43.17)]
    df = spark.createDataFrame(rows, "id int, a double, b double, c double, d double")
    out = {r.id: r.km for r in df.select("id", haversine_km("a", "b", "c", "d").alias("km")).collect()}
    assert out[1] == 0.0
    assert abs(out[2] - math.pi * 6371.0) < 1e-6          # antipodal, clamped asin
    assert out[3] is None
    assert 355 < out[4] < 365                               # Sao Paulo - Rio


def test_tier_label_bounds(spark):
    scores = [0.0, 0.29, 0.30, 0.60, 0.85, 1.0, None]
    df = spark.createDataFrame([(s,) for s in scores], "s double")
    got = [r.t for r in df.select(tier_label("s").alias("t")).collect()]
    assert got == ["low", "low", "medium", "high", "critical", "critical", None]


def test_safe_rate_and_percent(spark):
    df = spark.createDataFrame([(1, 3), (0, 0), (2, None)], "n int, d int")
    got = df.select(safe_rate("n", "d").alias("r"), percent("n", "d").alias("p")).collect()
    assert got[0].r == pytest.approx(1 / 3) and got[0].p == 33.33
    assert got[1].r == 0.0 and got[1].p is None
    assert got[2].r == 0.0


def test_round_half_away_from_zero(spark):
    df = spark.createDataFrame([(0.125,), (2.5,), (-1.5,)], "x double")
    got = [r.y for r in df.select(round_half_away("x", 2).alias("y")).collect()]
    assert got[0] == 0.13
    got0 = [r.y for r in df.select(round_half_away("x", 0).alias("y")).collect()]
    assert got0[1:] == [3.0, -2.0]
