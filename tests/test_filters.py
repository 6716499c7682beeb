import pytest
from pyspark.sql import functions as F

from obsflow.functions.scalar import array_distance, nearest, steady_round
from obsflow.operators import filters


def times(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "t string").selectExpr("cast(t as timestamp) valid")


def clock(df):
    return [r[0].strftime("%H:%M") for r in df.collect()]


def test_day_and_night_share_out_the_clock(spark):
    df = times(spark, *[f"2024-01-01 {h:02d}:{m}" for h in range(24) for m in ("00", "59")])
    day, night = clock(filters.day_rows(df)), clock(filters.night_rows(df))
    assert day[0] == "08:00" and day[-1] == "18:59" and len(day) == 22
    assert len(night) == 26 and not set(day) & set(night)


def test_alignment(spark):
    df = times(spark, "2024-01-01 00:00", "2024-01-01 00:05", "2024-01-01 00:15", "2024-01-01 00:15:01")
    assert clock(filters.aligned(df)) == ["00:00", "00:15"]


def test_recent_week_from_the_latest_row_and_from_a_reference(spark):
    df = times(spark, "2024-01-01 00:00", "2024-01-08 11:59", "2024-01-08 12:00", "2024-01-15 12:00")
    assert filters.recent(df).count() == 2
    assert filters.recent(df, reference="2024-01-08 00:00:00").count() == 4
    assert filters.recent(df, reference="2024-01-09 00:00:00").count() == 3


def test_finite_and_threshold(spark):
    scores = [1.5, -2.0, -2.5, 2.0, float("nan"), float("inf"), float("-inf"), None]
    df = spark.createDataFrame([(z,) for z in scores], "z_score double")
    assert [r[0] for r in filters.finite_only(df).collect()] == [1.5, -2.0, -2.5, 2.0]
    assert [r[0] for r in filters.beyond(df, 2).collect()] == [-2.5]
    assert [r[0] for r in filters.beyond(df, 1).collect()] == [1.5, -2.0, -2.5, 2.0]


def test_steady_round_ignores_summation_noise(spark):
    df = spark.createDataFrame([(0.12345,), (0.12344999999999999,), (-0.12345,)], "x double")
    assert [r[0] for r in df.select(steady_round(F.col("x"), 4)).collect()] == [0.1235, 0.1235, -0.1235]


def test_nearest_and_array_distance(spark):
    df = spark.createDataFrame([(0.0, 0.0), (3.0, 4.0), (1.5, 2.0)], "x double, y double")
    best = df.select(nearest([F.col("x"), F.col("y")], [[3.0, 4.0], [0.0, 0.0]]).alias("n")).collect()
    assert [(r["n"]["cluster"], r["n"]["distance"]) for r in best] == [(1, 0.0), (0, 0.0), (0, 2.5)]
    row = df.select(array_distance(F.array("x", "y"), F.array(F.lit(0.0), F.lit(0.0))).alias("d")).collect()
    assert [r["d"] for r in row] == pytest.approx([0.0, 5.0, 2.5])
