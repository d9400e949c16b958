"""Index cohort, funnel and report against plain Python on random, dirty data."""

import random
import statistics
from datetime import date, timedelta

from wardline.operators import cohort as cohorts
from wardline.operators import funnel, summary
from wardline.spec import PRIOR_EXCLUSION_CODE, TARGET_CODE, WINDOW_EXCLUSION_CODE, StudySpec

T, P, W = TARGET_CODE, PRIOR_EXCLUSION_CODE, WINDOW_EXCLUSION_CODE
SPEC = StudySpec()
START = date(2015, 1, 1)


def random_tables(seed):
    rng = random.Random(seed)
    ids = [f"p{i}" for i in range(150)] + [None]

    def maybe(value, odds=0.05):
        return None if rng.random() < odds else value

    def a_day(first=START, span=900):
        return first + timedelta(days=rng.randrange(span))

    def someone():
        return "p0" if rng.random() < 0.33 else rng.choice(ids)

    patients = []
    for i in ids[:-20] + ids[-1:]:
        for _ in range(rng.choice([1, 1, 1, 1, 2])):
            born = maybe(a_day(date(1940, 1, 1), 25000))
            patients.append(
                (i, born, maybe(a_day(), 0.8), rng.choice(["M", " F", "", None]),
                 rng.choice(["a", "b", "c "]), rng.choice(["x", "\ty"]))
            )
    conditions = [
        (someone(), maybe(f"e{rng.randrange(40)}"), maybe(a_day()),
         rng.choice([T, P, W, "1", "2", None]), maybe(rng.choice(["d1", "d2"])))
        for _ in range(2500)
    ]
    encounters = [(someone(), maybe(a_day(date(2013, 1, 1), 1200))) for _ in range(600)]
    return patients, conditions, encounters


def years(birth, index):
    if birth is None:
        return None
    return index.year - birth.year - ((index.month, index.day) < (birth.month, birth.day))


def lowest(value):
    """Null sorts first."""
    return (value is not None, value or "")


def expected_cohort(patients, conditions, encounters):
    rows = []
    for pid in {c[0] for c in conditions}:
        mine = [c for c in conditions if c[0] == pid and c[2] is not None]
        target = [c for c in mine if c[3] == T]
        if not target:
            continue
        first = min(target, key=lambda c: (c[2], lowest(c[1]), lowest(c[4])))
        index = first[2]
        known = pid is not None
        prior = [c[2] for c in mine if c[3] == P and c[2] < index] if known else []
        window = [c[2] for c in mine if c[3] == W and c[2] <= index] if known else []
        seen = [e[1] for e in encounters if e[0] == pid and e[1]] if known else []
        history = (index - min(seen)).days if seen else None
        attributes = [p for p in patients if p[0] == pid] if known else []
        for p in attributes or [(pid, None, None, None, None, None)]:
            age = years(p[1], index)
            rules = (
                age is not None and age >= 18,
                history is not None and history >= 365,
                not prior,
                not window,
            )
            rows.append(
                (pid, index, first[1], T, first[4], len(target), *p[1:],
                 min(seen) if seen else None, bool(prior), min(prior, default=None), len(prior),
                 bool(window), min(window, default=None), len(window), age, history, *rules,
                 T, P, W, 365, "t2dm_index_cohort", all(rules))
            )
    return rows


def frames(clinic, spark, tables):
    from conftest import CONDITIONS, ENCOUNTERS, PATIENTS

    return [
        spark.createDataFrame(rows, schema).repartition(3)
        for rows, schema in zip(tables, (PATIENTS, CONDITIONS, ENCOUNTERS))
    ]


def test_random_tables(clinic, spark):
    tables = random_tables(20)
    patients, conditions, encounters = frames(clinic, spark, tables)
    built = cohorts.index_cohort(patients, conditions, encounters, SPEC).collect()
    expected = expected_cohort(*tables)
    assert sorted(map(repr, map(tuple, built))) == sorted(map(repr, expected))
    assert sum(r[-1] for r in expected) > 3

    cohort = spark.createDataFrame(built)
    steps = funnel.attrition(patients, cohort, SPEC).orderBy("step_number").collect()
    flags = [
        lambda r: True,
        lambda r: r.meets_adult_age_rule,
        lambda r: r.meets_adult_age_rule and r.meets_baseline_history_rule,
    ]
    assert steps[0].remaining_n == len({p[0] for p in tables[0]})
    for step, flag in zip(steps[1:4], flags):
        assert step.remaining_n == len({r.patient_id for r in built if flag(r)})
    assert steps[6].remaining_n == len({r.patient_id for r in built if r.meets_final_phase1_rules})

    report = summary.baseline_characteristics(cohort).orderBy("row_order").collect()
    ages = [float(r.age_at_index) for r in built if r.age_at_index is not None]
    total = len({r.patient_id for r in built})
    assert report[0].value == str(total)
    assert report[1].value == f"{statistics.mean(ages):.1f} ({statistics.stdev(ages):.1f})"
    assert report[2].value.startswith(f"{statistics.median(ages):.1f} [")
    quartiles = statistics.quantiles(ages, n=4, method="inclusive")
    assert report[2].value.endswith(f"[{quartiles[0]:.1f}, {quartiles[2]:.1f}]")
    assert report[3].value == f"{min(ages):.1f}, {max(ages):.1f}"
    levels = {}
    for r in built:
        text = (r.sex or "").strip() or "Missing"
        levels[text] = levels.get(text, 0) + 1
    want = [
        (level, n, round(n / total * 100, 1))
        for level, n in sorted(levels.items(), key=lambda item: (-item[1], item[0]))
    ]
    assert [(r.level, r.n, r.percent) for r in report if r.variable == "Sex"] == want
