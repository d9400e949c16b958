import random
from datetime import date, timedelta

import pytest

from wardline.operators import intervals

DAY = date(2020, 1, 1)


def at(n):
    return None if n is None else DAY + timedelta(days=n)


def rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


@pytest.fixture
def many_ranges(spark):
    """Ranges are not merged, so keys span several of them."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    yield
    spark.conf.set(name, before)


def some_patients(rng, n):
    return ["hot" if rng.random() < 0.5 else f"p{rng.randrange(8)}" for _ in range(n)]


def test_events_in_windows(spark):
    rng = random.Random(1)
    events = [(p, at(rng.randrange(-400, 400)), rng.randrange(9)) for p in some_patients(rng, 1500)]
    events += [(None, at(0), 1), ("hot", None, 1)]
    windows = []
    for p in some_patients(rng, 300):
        low = rng.randrange(-400, 400)
        windows.append((p, rng.randrange(3), at(low), at(low + rng.choice([-1, 0, 1, 6, 7, 8, 30, 90, 365, 3000]))))
    windows += windows[:20] + [(None, 1, at(0), at(5)), ("hot", 2, None, at(3)), ("hot", 2, at(3), None), ("nobody", 1, at(0), at(9))]
    want = []
    for p, k, a, b in windows:
        inside = [(d, v) for q, d, v in events if q == p and p is not None and d and a and b and a <= d <= b]
        days = [d for d, _ in inside]
        want.append((p, k, a, b, len(inside), min(days, default=None), max(days, default=None), sum(v for _, v in inside) if inside else None))
    from pyspark.sql import functions as F

    found = intervals.events_in_windows(
        spark.createDataFrame(events, "patient_id string, day date, v bigint"), "day",
        spark.createDataFrame(windows, "patient_id string, kind int, window_start date, window_end date"), total=F.col("v"),
    )
    assert rows(found) == sorted(want, key=repr)
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_a_hot_patient_is_spread_over_bins(spark):
    """The join of windows and events is on bins: no key holds a patient's history."""
    events = spark.range(4000).selectExpr("'hot' AS patient_id", "date_add(DATE'2000-01-01', CAST(id AS int)) AS day")
    windows = events.selectExpr("patient_id", "day AS window_start", "date_add(day, 6) AS window_end")
    found = intervals.events_in_windows(events, "day", windows)
    assert found.where("events = 7").count() == 3994
    text = found._jdf.queryExecution().analyzed().toString()
    assert "bin" in text


def brute_eras(spans, grace):
    out, by_key = [], {}
    for key, a, b in spans:
        if a is not None:
            by_key.setdefault(key, []).append((a, max(a, b or a)))
    for key, found in by_key.items():
        found.sort()
        start, end, n, covered = None, None, 0, set()
        for a, b in [*found, (date.max, date.max)]:
            if start is not None and (a == date.max or a > end + timedelta(days=grace)):
                out.append((*key, start, end, n, (end - start).days + 1 - len(covered)))
                start, n, covered = None, 0, set()
            if start is None:
                start, end = a, b
            if a == date.max:
                break
            end, n = max(end, b), n + 1
            covered |= {a + timedelta(days=i) for i in range((b - a).days + 1)}
    return sorted(out, key=repr)


@pytest.mark.parametrize("grace", [0, 1, 5])
def test_eras(spark, many_ranges, grace):
    rng = random.Random(grace)
    spans = []
    for p in some_patients(rng, 700):
        a = rng.randrange(0, 2500)
        spans.append(((p, rng.choice(["x", "y", None])), at(a), at(rng.choice([None, a - 3, a, a + 2, a + 9]))))
    spans += [((None, "x"), at(i * 3), at(i * 3 + 1)) for i in range(40)] + [(("hot", "x"), None, at(5))]
    spans += [(("one", "x"), at(0), at(2400))] + [(("one", "x"), at(i), None) for i in range(0, 2600, 7)]
    frame = spark.createDataFrame([(*k, a, b) for k, a, b in spans], "patient_id string, code string, s date, e date")
    found = intervals.eras(frame.repartition(3), ["patient_id", "code"], "s", "e", grace)
    assert rows(found) == brute_eras(spans, grace)
    assert rows(intervals.eras(frame.limit(0), ["patient_id"], "s", "e", 1)) == []


def test_recurrent_index(spark):
    events = [("p", at(d), "a") for d in (0, 10, 40, 50, 200)] + [("p", at(100), "b"), (None, at(0), "a"), ("q", None, "a"), ("r", at(3), "a")]
    frame = spark.createDataFrame(events, "patient_id string, day date, code string")
    found = intervals.recurrent_index(frame, frame.code == "a", "day", 30)
    assert rows(found) == [("p", at(0), 1), ("p", at(200), 2), ("r", at(3), 1)]
    assert rows(intervals.recurrent_index(frame, frame.code == "a", "day", 20)) == [
        ("p", at(0), 1), ("p", at(40), 2), ("p", at(200), 3), ("r", at(3), 1)]


@pytest.mark.parametrize("nearest", [False, True])
def test_values_at(spark, many_ranges, nearest):
    rng = random.Random(7)
    values = [(p, rng.choice("xy"), at(rng.randrange(0, 900)), rng.choice([None, 1.5, 2.0, 7.25])) for p in some_patients(rng, 900)]
    values += [(None, "x", at(1), 1.0), ("hot", None, at(1), 1.0), ("hot", "x", None, 1.0)]
    points = [(p, rng.choice("xyz"), at(rng.randrange(-50, 950)), i) for i, p in enumerate(some_patients(rng, 300))]
    points += [(None, "x", at(3), -1), ("hot", "x", None, -2), ("nobody", "x", at(3), -3), points[0]]
    want = []
    for p, k, day, i in points:
        best = None
        for q, l, d, v in values:
            if None in (p, k, day, d, v) or (p, k) != (q, l) or (d > day and not nearest):
                continue
            rank = (abs((d - day).days), d, -v)
            if best is None or rank < best[0]:
                best = (rank, v, d)
        want.append((p, k, day, i, best and best[1], best and best[2]))
    found = intervals.values_at(
        spark.createDataFrame(values, "patient_id string, code string, day date, v double").repartition(3),
        spark.createDataFrame(points, "patient_id string, code string, asked date, i int"),
        ["patient_id", "code"], "day", "v", "asked", nearest,
    )
    assert rows(found) == sorted(want, key=repr)


def test_step_points(spark):
    windows = spark.createDataFrame([("p", at(0), at(180)), ("q", at(5), at(5))], "patient_id string, index_date date, follow_up_end date")
    assert rows(intervals.step_points(windows)) == [("p", 0, at(0)), ("p", 1, at(90)), ("p", 2, at(180)), ("q", 0, at(5))]
