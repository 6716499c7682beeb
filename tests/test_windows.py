import random
import statistics
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from obsflow.functions.time import DAY, WEEK
from obsflow.operators import windows

START = datetime(2024, 1, 1)


def walk(seed, n, stations=("a", "b"), minutes=5):
    rng = random.Random(seed)
    at = START
    out = []
    for _ in range(n):
        at += timedelta(minutes=minutes * rng.randint(0, 40))
        out.append((rng.choice(stations), str(at), round(rng.gauss(0.5, 0.2), 3)))
    return out


def close(rows, other, key):
    a = {key(r): r for r in rows}
    b = {key(r): r for r in other}
    assert a.keys() == b.keys() and len(a) == len(rows) == len(other)
    for k in a:
        for name in ("avg_temp", "stddev_temp"):
            ours, theirs = a[k][name], b[k][name]
            assert (ours is None) == (theirs is None), (k, name)
            assert ours is None or ours == pytest.approx(theirs, rel=1e-9, abs=1e-12), (k, name)


def test_panes_equal_plain_sliding_windows(rows):
    df = rows(walk(1, 300) + [("a", "2024-02-01 00:00", None), (None, "2024-02-01 00:00", 0.1)])
    panes = windows.sliding_stats(df, "valid", "tmpf", "station").collect()
    plain = windows.window_stats(df, "valid", "tmpf", "station", WEEK, DAY).collect()
    close(panes, plain, lambda r: (r["station"], r["window_start"], r["window_end"]))


def test_constant_and_single_values(rows):
    third = 0.1 + 0.2
    df = rows([("a", f"2024-01-0{d} 00:00", third) for d in range(1, 8)] + [("b", "2024-01-01 00:00", 1.0)])
    got = windows.sliding_stats(df, "valid", "tmpf", "station").collect()
    for r in got:
        full = r["station"] == "a" and r["window_start"] < datetime(2024, 1, 7) and r["window_end"] > datetime(2024, 1, 3)
        if r["station"] == "b":
            assert r["avg_temp"] == 1.0 and r["stddev_temp"] is None
        elif full:
            assert r["avg_temp"] == third and r["stddev_temp"] == 0.0


def test_slide_must_divide(rows):
    with pytest.raises(ValueError):
        windows.sliding_stats(rows([("a", "2024-01-01", 1.0)]), "valid", "tmpf", "station", 100, 30)


def lists_by_hand(items, seconds, slide):
    groups = defaultdict(list)
    for station, at, value, *_ in items:
        epoch = int((datetime.fromisoformat(at) - datetime(1970, 1, 1)).total_seconds())
        start = epoch - epoch % slide
        while start > epoch - seconds:
            if value is not None:
                groups[station, start].append(value)
            else:
                groups[station, start]
            start -= slide
    return {k: sorted(v) for k, v in groups.items()}


@pytest.mark.parametrize("page_rows", [3, 7, 100_000])
def test_list_pages_hold_every_value(rows, page_rows):
    rng = random.Random(5)
    crowd = [("a", "2024-01-03 10:00:00", rng.choice([0.1, 0.2, 0.3])) for _ in range(200)]
    items = walk(2, 150) + crowd + [("c", "2024-01-09 05:00:00", None)]
    got = windows.window_lists(rows(items), "valid", "tmpf", "station", 7200, 3600, page_rows).collect()
    pages = defaultdict(list)
    for r in got:
        key = (r["station"], int((r["window_start"] - datetime(1970, 1, 1)).total_seconds()))
        assert r["values"] == sorted(r["values"])
        pages[key] += r["values"]
        if page_rows == 100_000:
            assert r["page"] == 0
    assert {k: sorted(v) for k, v in pages.items()} == lists_by_hand(items, 7200, 3600)
    if page_rows == 7:
        crowded = [r for r in got if len(pages[r["station"], int((r["window_start"] - datetime(1970, 1, 1)).total_seconds())]) > 150]
        assert len(crowded) > 10 and max(len(r["values"]) for r in crowded) < 100


@pytest.mark.parametrize("page_rows", [7, 40])
def test_pages_are_cuts_of_the_sorted_list(rows, page_rows):
    crowd = [("a", "2024-01-03 10:00:00", v) for v in [3.5] * 30 + [i * 37 % 101 / 4 for i in range(101)] + [None, float("nan")]]
    got = windows.window_lists(rows(crowd), "valid", "tmpf", "station", 7200, 3600, page_rows).collect()
    whole = sorted(v for _, _, v in crowd[:-2])
    for start in {r["window_start"] for r in got}:
        pages = sorted((r["page"], r["values"]) for r in got if r["window_start"] == start)
        assert [p for p, _ in pages] == list(range(-(-132 // page_rows)))
        assert all(len(v) == page_rows for _, v in pages[:-1])
        values = [x for _, v in pages for x in v]
        assert values[:-1] == whole and values[-1] != values[-1]
    assert len(got) == 2 * -(-132 // page_rows)


def test_summary_matches_statistics(rows):
    items = walk(3, 120)
    got = windows.window_summary(rows(items), "valid", "tmpf", seconds=DAY).collect()
    by_day = defaultdict(list)
    for _, at, v in items:
        by_day[datetime.fromisoformat(at).date()].append(v)
    assert len(got) == len(by_day)
    for r in got:
        values = by_day[r["window_start"].date()]
        assert r["values"] == sorted(values) and r["count"] == len(values)
        assert r["avg"] == pytest.approx(statistics.mean(values), abs=6e-5)
        if len(values) > 1:
            assert r["standard_dev"] == pytest.approx(statistics.stdev(values), abs=6e-5)
        else:
            assert r["standard_dev"] is None


def test_outliers_and_standardised_columns(rows):
    items = walk(4, 200)
    df = rows(items)
    by_day = defaultdict(list)
    for _, at, v in items:
        by_day[datetime.fromisoformat(at).date()].append(v)
    expected = []
    for values in by_day.values():
        if len(values) > 1:
            m, s = round(statistics.mean(values), 4), round(statistics.stdev(values), 4)
            expected += [v for v in values if abs(v - m) > s > 0]
    got = windows.window_outliers(df, "valid", "tmpf", DAY, 1.0)
    assert sorted(r["value"] for r in got.collect()) == pytest.approx(sorted(expected))
    scores = windows.standardise(df, "valid", ["tmpf"], seconds=DAY)
    assert scores.count() == len(items)
    means = scores.groupBy("window_start").agg(F.avg("tmpf_norm").alias("m"), F.stddev_samp("tmpf_norm").alias("s"))
    for r in means.where("s is not null").collect():
        assert r["m"] == pytest.approx(0, abs=1e-9) and r["s"] == pytest.approx(1)


def test_counts_and_means(rows):
    df = rows([("a", "2024-01-01 00:00:03", 1.0), ("a", "2024-01-01 00:00:09", 3.0), ("b", "2024-01-01 00:00:10", 5.0)])
    counts = windows.window_count(df, "valid", "station").orderBy("window_start").collect()
    assert [(r["station"], r["count"]) for r in counts] == [("a", 2), ("b", 1)]
    means = windows.window_mean(df, "valid", "tmpf").orderBy("window_start").collect()
    assert [r["moving_average"] for r in means] == [2.0, 5.0]
    assert [tuple(r) for r in windows.count_by(df, "station").collect()] == [("a", 2), ("b", 1)]


def test_standardise_keeps_rows_without_key_or_time(spark):
    rows = [("a", "2024-01-01 00:00:00", 1.0), ("a", "2024-01-01 00:00:01", 3.0), (None, "2024-01-01 00:00:00", 2.0)]
    rows += [(None, "2024-01-01 00:00:02", 4.0), ("a", None, 9.0)]
    df = spark.createDataFrame(rows, "station string, valid string, tmpf double").selectExpr("station", "cast(valid as timestamp) valid", "tmpf")
    got = {(r.station, r.tmpf): r.tmpf_norm for r in windows.standardise(df, "valid", ["tmpf"], "station").collect()}
    assert len(got) == 5 and got["a", 9.0] is None
    assert got["a", 1.0] == -got["a", 3.0] == got[None, 2.0] == -got[None, 4.0] < 0


@pytest.mark.parametrize("kept", [4, 100_000])
def test_pages_of_counted_values(spark, monkeypatch, kept):
    """Windows below ``LIST_PAGE`` are ranked where they are, those above by ranges of values; null keys and values stay."""
    monkeypatch.setattr(windows, "LIST_PAGE", kept)
    rng = random.Random(4)
    want, items = {}, []
    for key in ("a", "b", "c", "d", None):
        values = [rng.randint(0, 6) / 10 for _ in range({"a": 2, "b": 3, "c": 4}.get(key, 60))]
        if key == "d":
            values += [0.5] * 30
        want[key] = sorted(values)
        items += [(key, v, values.count(v)) for v in set(values)] + [(key, None, 7)]
    items.append(("none", None, 3))
    want["none"] = []
    got = defaultdict(dict)
    for r in windows.lists_of_counts(spark.createDataFrame(items, "station string, value double, n long"), ["station"], 2).collect():
        assert r["page"] not in got[r["station"]]
        got[r["station"]][r["page"]] = r["values"]
    assert {k: [x for p in sorted(pages) for x in pages[p]] for k, pages in got.items()} == want
    assert all(len(x) == 2 for pages in got.values() for p, x in pages.items() if p < max(pages))


def test_pages_of_windows_take_one_exchange(spark):
    counted = spark.range(1000).selectExpr("id % 50 station", "id / 7 value", "id % 3 + 1 n")
    plan = windows.lists_of_counts(counted, ["station"], 2)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hash") == 1
