import random
from datetime import datetime, timedelta

import pytest

from obsflow.operators import scoring
from obsflow.operators.filters import beyond
from obsflow.plans import exploration


def week(station, values, first="2024-01-01"):
    start = datetime.fromisoformat(first)
    return [(station, str(start + timedelta(hours=6 * i)), v) for i, v in enumerate(values)]


def test_day_edge_picks_the_baseline(rows):
    items = week("a", [0.1 * (i % 5) for i in range(28)])
    items += [("a", "2024-01-08 23:45:00", 0.9), ("a", "2024-01-09 00:00:00", 0.9)]
    got = {r["valid"]: r for r in scoring.scored_observations(rows(items)).collect()}
    before, after = got[datetime(2024, 1, 8, 23, 45)], got[datetime(2024, 1, 9)]
    assert before["baseline_start"] == datetime(2024, 1, 1) and after["baseline_start"] == datetime(2024, 1, 2)
    assert before["window_start"] == datetime(2024, 1, 8, 21, 45)
    assert before["prev_week_start"] == datetime(2024, 1, 1, 23, 45)
    assert before["prev_week_end"] == datetime(2024, 1, 7, 23, 45)
    assert before["avg_temp"] == pytest.approx(5.3 / 28, abs=1e-4)
    assert before["z_score"] == pytest.approx((0.9 - before["avg_temp"]) / before["stddev_temp"])


def test_no_score_without_spread(rows):
    single = [("a", "2024-01-02 00:00:00", 0.5), ("a", "2024-01-09 00:00:00", 0.7)]
    constant = [*week("b", [0.3] * 28), ("b", "2024-01-08 00:00:00", 0.7)]
    assert scoring.scored_observations(rows(single + constant)).collect() == []


def test_one_row_per_station_and_time(rows):
    items = week("a", [0.1 * (i % 7) for i in range(28)]) + [("a", "2024-01-08 06:00:00", 0.2)] * 50
    got = scoring.scored_observations(rows(items)).collect()
    crowded = [r for r in got if r["valid"] == datetime(2024, 1, 8, 6)]
    assert len(crowded) == 1 and crowded[0]["temp"] == pytest.approx(0.2)
    assert len({r["valid"] for r in got}) == len(got)


def test_a_week_counts_from_its_first_row(rows):
    """Days before the data are no gap: the second day is compared with the first alone."""
    got = scoring.scored_observations(rows(week("a", [0.1, 0.2, 0.3, 0.4, 0.9]))).collect()
    assert [(r["valid"], r["avg_temp"]) for r in got] == [(datetime(2024, 1, 2), 0.25)]


def test_windows_give_the_same_scores(rows):
    rng = random.Random(3)
    items = [(rng.choice("ab"), str(datetime(2024, 1, 1) + timedelta(minutes=15 * rng.randint(0, 1500))), rng.random())
             for _ in range(800)]
    df = rows(items)
    order = ["station", "valid"]
    frames = scoring.scored_observations(df).orderBy(*order).collect()
    plain = scoring.scored_observations(df, form="windows").orderBy(*order).collect()
    assert len(frames) == len(plain) > 50
    for a, b in zip(frames, plain):
        assert a["valid"] == b["valid"] and a["z_score"] == pytest.approx(b["z_score"])


def test_cold_start_looks_at_the_first_week(rows):
    items = week("a", [0.1 * (i % 5) for i in range(28)]) + [("a", "2024-01-08 00:00:00", 0.9)]
    got = scoring.scored_observations(rows(items), cold_start_origin="2024-01-01").collect()
    assert len(got) == 29 and {r["baseline_start"] for r in got} == {datetime(2024, 1, 1)}
    first = min(got, key=lambda r: r["valid"])
    assert first["prev_week_end"] == first["valid"] - timedelta(minutes=15)
    later = [r for r in got if r["valid"] == datetime(2024, 1, 3)][0]
    assert later["prev_week_end"] == datetime(2024, 1, 2)


def test_range_comparison_against_brute_force(rows):
    rng = random.Random(8)
    items = [(rng.choice("ab"), str(datetime(2024, 1, 1) + timedelta(minutes=5 * rng.randint(0, 4000))), rng.random())
             for _ in range(120)]
    df = rows(items)
    baselines = exploration.sliding_week(df)
    got = exploration.compare(df, baselines)
    table = baselines.collect()
    expected = []
    for r in scoring.two_hour_rows(df).collect():
        for b in table:
            if b["station"] == r["station"] and r["prev_week_start"] <= b["window_start"].date() <= r["prev_week_end"]:
                expected.append((r["station"], r["window_start"], r["temperature"], b["window_start"]))
    columns = ["station", "window_start", "temperature", "baseline_start"]
    assert sorted(tuple(r) for r in got.select(*columns).collect()) == sorted(expected)
    flagged = exploration.compare_anomalies(df, baselines, 1.0).collect()
    assert len(flagged) == beyond(got, 1.0).count() > 0
    assert scoring.two_hour_rows(df).count() == 2 * len(items)


def test_distinct_and_top_rows(rows):
    df = rows([("a", "2024-01-01", float(i % 3)) for i in range(30)])
    assert scoring.distinct_rows(df).count() == 3
    assert scoring.distinct_rows(df, ["station"]).count() == 1
    assert [r["tmpf"] for r in scoring.top_rows(scoring.distinct_rows(df), [df.tmpf.desc()], 2).collect()] == [2.0, 1.0]
