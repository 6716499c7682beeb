import random
import statistics
from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from obsflow.functions.time import WEEK
from obsflow.operators import trailing
from obsflow.operators.filters import aligned

START = datetime(2024, 1, 1)


def by_hand(items, seconds):
    out = {}
    for station, at, _ in items:
        t = datetime.fromisoformat(at)
        inside = [
            v for s, a, v in items
            if s == station and v is not None and timedelta() <= t - datetime.fromisoformat(a) <= timedelta(seconds=seconds)
        ]
        out[station, t] = inside
    return out


def means(df):
    return {(r["station"], r["valid"]): r["tmpf_avg"] for r in df.collect()}


def check(rows, items):
    df = aligned(rows(items))
    kept = [i for i in items if datetime.fromisoformat(i[1]).minute % 15 == 0]
    expected = {k: (sum(v) / len(v) if v else 0.0) for k, v in by_hand(kept, 7200).items()}
    frames = means(trailing.trailing_mean(df, "valid", ["tmpf"], "station"))
    plain = means(trailing.trailing_mean_windows(df, "valid", ["tmpf"], "station"))
    assert frames == pytest.approx(expected) and plain == pytest.approx(expected)


def test_frame_edges(rows):
    check(rows, [
        ("a", "2024-01-01 00:00:00", 1.0),
        ("a", "2024-01-01 02:00:00", 3.0),
        ("a", "2024-01-01 02:15:00", 5.0),
        ("a", "2024-01-01 22:15:00", 7.0),
        ("a", "2024-01-01 23:45:00", 9.0),
        ("a", "2024-01-02 00:00:00", 11.0),
        ("a", "2024-01-02 00:15:00", 13.0),
        ("a", "2024-01-02 02:00:00", None),
        ("b", "2024-01-05 00:00:00", None),
        ("a", "2024-01-02 00:05:00", 100.0),
    ])


def test_many_rows_at_one_time(rows):
    check(rows, [("a", "2024-01-01 00:15:00", float(i)) for i in range(300)] + [("a", "2024-01-01 01:15:00", 1.0)])


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(
    st.tuples(
        st.sampled_from(["a", "b"]),
        st.integers(0, 300).map(lambda i: str(START + timedelta(minutes=5 * i))),
        st.one_of(st.none(), st.integers(-50, 50).map(float)),
    ),
    min_size=1, max_size=40,
))
def test_any_rows(rows, items):
    check(rows, items)


def test_week_long_frames(rows):
    rng = random.Random(9)
    items = []
    for station, step in (("a", 3), ("b", 47)):
        at = START
        for _ in range(250):
            at += timedelta(hours=step * rng.random() / 1.5)
            items.append((station, str(at.replace(microsecond=0)), round(rng.gauss(20, 3), 2)))
    # Both ends of the frame fall on rows, and one frame holds equal values only.
    items += [("c", "2024-01-01 12:00:00", 5.0), ("c", "2024-01-08 12:00:00", 5.0), ("c", "2024-01-15 12:00:01", 7.0)]
    items += [(None, "2024-01-01 12:00:00", 4.0), (None, "2024-01-04 12:00:00", 6.0)]
    got = trailing.trailing_stats(rows(items), "valid", "tmpf", "station", WEEK).collect()
    expected = by_hand(items, WEEK)
    assert {(r["station"], r["valid"]) for r in got} == set(expected) and len(got) == len(expected)
    for r in got:
        values = expected[r["station"], r["valid"]]
        assert r["avg_temp"] == pytest.approx(statistics.mean(values))
        if len(values) > 1:
            assert r["stddev_temp"] == pytest.approx(statistics.stdev(values), abs=1e-9)
        else:
            assert r["stddev_temp"] is None
    (equal,) = [r for r in got if r["station"] == "c" and r["valid"] == datetime(2024, 1, 8, 12)]
    assert (equal["avg_temp"], equal["stddev_temp"]) == (5.0, 0.0)


def test_trailing_week_of_times_within_a_second(spark):
    """Sub-second times are times of their own, and a key far from others keeps its deviation."""
    rows = [("a", "2024-01-03 00:00:00.100", 1.0), ("a", "2024-01-03 00:00:00.500", 3.0)]
    rows += [("near", f"2024-01-0{d} 10:00:00.25", v) for d, v in ((1, 0.0), (2, 0.1), (3, 0.2))]
    rows += [("far", f"2024-01-0{d} 10:00:00.25", 1e8 + v) for d, v in ((1, 0.0), (2, 0.1), (3, 0.2))]
    df = spark.createDataFrame(rows, "station string, valid string, tmpf double")
    df = df.withColumn("valid", F.col("valid").cast("timestamp"))
    got = {(r.station, str(r.valid)): r for r in trailing.trailing_stats(df, "valid", "tmpf", "station", WEEK).collect()}
    assert len(got) == 8
    first, second = got["a", "2024-01-03 00:00:00.100000"], got["a", "2024-01-03 00:00:00.500000"]
    assert (first.avg_temp, first.stddev_temp) == (1.0, None)
    assert second.avg_temp == 2.0 and second.stddev_temp == pytest.approx(2**0.5)
    for station in ("near", "far"):
        assert got[station, "2024-01-03 10:00:00.250000"].stddev_temp == pytest.approx(0.1, rel=1e-5)
