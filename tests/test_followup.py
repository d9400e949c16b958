from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from wardline.operators import cohort as cohorts
from wardline.operators import followup
from wardline.spec import CONCEPT_SETS, SILVER_DATES, StudySpec

SPEC = StudySpec()


@pytest.fixture(params=["small cohort", "large cohort"])
def either_size(request, monkeypatch):
    """Both join strategies must give the same results."""
    if request.param == "large cohort":
        monkeypatch.setattr(cohorts, "BROADCAST_BYTES", 0)


def day(text):
    return date.fromisoformat(text) if text else None


def frame(spark, schema, *rows):
    return spark.createDataFrame(list(rows), schema)


def cohort(spark, *rows):
    """(patient, index date, death date)"""
    return frame(
        spark, "patient_id string, index_date date, death_date date",
        *[(p, day(i), day(d)) for p, i, d in rows],
    )


def encounters(spark, *rows):
    return frame(
        spark, "patient_id string, encounter_start_date date, encounter_class string",
        *[(p, day(d), c) for p, d, c in rows],
    )


def windows(spark, *rows):
    """(patient, index date, end date, reason)"""
    return frame(
        spark,
        "patient_id string, index_date date, follow_up_end date, end_reason string,"
        " follow_up_days bigint",
        *[(p, day(i), day(e), r, (day(e) - day(i)).days) for p, i, e, r in rows],
    )


def test_followup_window_ends_at_the_first_limit(spark):
    people = cohort(
        spark,
        ("full", "2020-02-29", None),
        ("dead", "2020-01-01", "2020-06-01"),
        ("lost", "2020-01-01", None),
        ("early", "2020-01-01", "2019-01-01"),
        ("late_death", "2020-01-01", "2030-01-01"),
        ("unseen", "2020-01-01", None),
        ("twice", "2020-01-01", None),
        ("twice", "2020-01-01", None),
        ("day_after", "2020-01-01", "2020-03-02"),
    )
    seen = encounters(
        spark,
        ("day_after", "2020-03-01", "a"),
        ("full", "2025-01-01", "a"),
        ("dead", "2025-01-01", "a"),
        ("lost", "2020-01-31", "a"),
        ("lost", "2019-01-31", "a"),
        ("early", "2025-01-01", "a"),
        ("late_death", "2025-01-01", "a"),
        ("twice", "2025-01-01", "a"),
    )
    found = {
        r.patient_id: (str(r.follow_up_end), r.end_reason, r.follow_up_days)
        for r in followup.followup_window(people, seen, SPEC).collect()
    }
    assert found == {
        "full": ("2022-02-28", "window_end", 730),
        "day_after": ("2020-03-02", "death", 61),  # a death is itself a record
        "dead": ("2020-06-01", "death", 152),
        "lost": ("2020-01-31", "end_of_record", 30),
        "early": ("2020-01-01", "death", 0),
        "late_death": ("2022-01-01", "window_end", 731),
        "unseen": ("2022-01-01", "window_end", 731),
        "twice": ("2022-01-01", "window_end", 731),
    }


def test_baseline_window_leaves_out_the_index_date(spark):
    seen = encounters(
        spark,
        ("a", "2020-01-01", "x"),
        ("a", "2019-12-31", "x"),
        ("a", "2019-01-01", "x"),
        ("a", "2018-12-31", "x"),
        ("b", "2020-01-01", "x"),
    )
    people = cohort(spark, ("a", "2020-01-01", None), ("b", "2020-01-01", None))
    found = {
        r.patient_id: (r.has_baseline_encounter, r.baseline_encounter_count)
        for r in followup.baseline_window(people, seen, SPEC).collect()
    }
    assert found == {"a": (True, 2), "b": (False, 0)}


def test_window_exclusion_with_two_bounds(spark):
    conditions = frame(
        spark,
        "patient_id string, condition_start_date date, code string",
        *[("a", day(d), "w") for d in ("2018-12-31", "2019-01-01", "2020-06-01", "2020-06-02")],
        ("b", day("2020-01-01"), "other"),
    )
    w = windows(
        spark,
        ("a", "2020-01-01", "2020-06-01", "death"),
        ("b", "2020-01-01", "2020-06-01", "death"),
    )
    rows = cohorts.exclusion_flags(
        conditions, w, "w", "flag", "first", "n", True,
        earliest=F.date_sub("index_date", 365), latest=F.col("follow_up_end"),
    ).collect()
    assert [tuple(r) for r in rows] == [("a", True, day("2019-01-01"), 2)]


def test_medication_exposure(spark, either_size):
    concepts = {
        "x": ("v", "u", (("1", "one"), ("2", "two"), ("1", "again"))), "none": ("v", "u", ())
    }
    medications = frame(
        spark,
        "patient_id string, medication_start_date date, code string",
        ("a", day("2020-01-01"), "1"),
        ("a", day("2020-01-01"), "1"),
        ("a", day("2020-05-01"), "2"),
        ("a", day("2021-01-01"), "1"),
        ("b", day("2019-12-31"), "1"),
        ("b", day("2020-01-01"), "9"),
        ("z", day("2020-01-01"), "1"),
    )
    w = windows(
        spark,
        ("a", "2020-01-01", "2020-06-01", "death"),
        ("b", "2020-01-01", "2020-06-01", "death"),
    )
    rows = followup.medication_exposure(medications, w, concepts).collect()
    assert [tuple(r) for r in rows] == [("x", 1, 3, 2, 50.0)]


def test_utilization_rate(spark, either_size):
    w = windows(
        spark,
        ("a", "2020-01-01", "2021-01-01", "window_end"),
        ("b", "2020-01-01", "2021-01-01", "window_end"),
    )
    seen = encounters(
        spark,
        *[("a", "2020-03-01", "clinic")] * 3,
        ("b", "2020-04-01", "clinic"),
        ("b", "2022-04-01", "clinic"),
        ("b", "2020-04-01", "home"),
    )
    found = {r.encounter_class: r for r in followup.utilization(seen, w).collect()}
    assert (found["clinic"].encounters, found["clinic"].patients) == (4, 2)
    assert found["clinic"].per_patient_year == pytest.approx(4 / (732 / 365.25))
    assert found["home"].encounters == 1


def test_costs(spark, either_size):
    w = windows(
        spark,
        ("a", "2020-01-01", "2021-01-01", "window_end"),
        ("b", "2020-01-01", "2021-01-01", "window_end"),
    )
    visits = frame(
        spark, "patient_id string, d date, c double",
        ("a", day("2020-02-01"), 0.1), ("a", day("2020-02-01"), 0.2), ("a", day("2020-03-01"), 10.0),
        ("a", day("2030-03-01"), 99.0), ("b", day("2020-03-01"), None),
    )
    drugs = frame(spark, "patient_id string, m date, c double", ("b", day("2020-02-01"), 7.0))
    per_patient = followup.patient_costs({"visit": (visits, "d", "c"), "drug": (drugs, "m", "c")}, w)
    found = {(r.patient_id, r.kind): r.cost for r in per_patient.collect()}
    assert found == {
        ("a", "visit"): pytest.approx(10.3),
        ("b", "visit"): 0.0,
        ("a", "drug"): 0.0,
        ("b", "drug"): 7.0,
    }
    row = {r.kind: r for r in followup.cost_summary(per_patient).collect()}["visit"]
    assert (row.patients, row.total, row.mean, row.median) == (2, *map(pytest.approx, (10.3, 5.15, 5.15)))
    assert (row.q1, row.q3) == pytest.approx((2.575, 7.725))


def test_lab_summary_and_trajectory(spark, either_size):
    concepts = {"x": ("v", "u", (("1", "one"),))}
    w = windows(
        spark,
        ("a", "2020-01-01", "2020-12-31", "death"),
        ("b", "2020-01-01", "2020-12-31", "death"),
    )
    observations = frame(
        spark,
        "patient_id string, observation_date date, code string, value_numeric double",
        ("a", day("2019-06-01"), "1", 100.0),
        ("a", day("2020-01-01"), "1", 5.0),
        ("a", day("2020-01-01"), "1", 5.0),
        ("a", day("2020-04-01"), "1", 8.0),
        ("b", day("2020-02-01"), "1", 6.0),
        ("b", day("2021-02-01"), "1", 60.0),
        ("b", day("2020-02-01"), "1", None),
        ("b", day("2020-02-01"), "2", 6.0),
    )
    rows = followup.lab_rows(observations, w, concepts)
    row = followup.lab_report(rows).first()
    assert (row.results, row.patients, row.mean, row.min, row.max) == (4, 2, 6.0, 5.0, 8.0)
    assert row.patients_with_context == 1
    assert (row.q1, row.median, row.q3) == (5.0, 5.5, 6.5)
    steps = {r.step: (r.results, r.mean, r.sd) for r in followup.lab_trajectory(rows).collect()}
    assert steps[0][:2] == (3, pytest.approx(16 / 3))
    assert steps[0][2] == pytest.approx((1 / 3) ** 0.5)
    assert steps[1] == (1, 8.0, 0.0)


def test_survival(spark):
    w = windows(
        spark,
        ("a", "2020-01-01", "2020-01-11", "death"),
        ("b", "2020-01-01", "2020-01-11", "end_of_record"),
        ("c", "2020-01-01", "2020-01-21", "window_end"),
        ("d", "2020-01-01", "2020-01-31", "death"),
    )
    rows = followup.survival_table(w).orderBy("day").collect()
    assert [(r.day, r.at_risk, r.deaths, r.censored) for r in rows] == [
        (10, 4, 1, 1),
        (20, 2, 0, 1),
        (30, 1, 1, 0),
    ]
    assert [r.survival for r in rows] == pytest.approx([0.75, 0.75, 0.0])


def test_concept_frame(spark):
    rows = followup.concept_frame(spark).collect()
    assert len(rows) == sum(len(codes) for _, _, codes in CONCEPT_SETS.values()) == 11
    assert {r.concept_set for r in rows if r.use == "phase1_treatment_pattern_analysis"} == {
        "sglt2_inhibitors",
        "glp1_receptor_agonists",
    }
    assert followup.concept_frame(spark, {"none": ("v", "u", ())}).count() == 0


def test_concept_signal(spark):
    concepts = {"x": ("v", "u", (("1", ""), ("2", ""), ("1", "listed twice")))}
    events = frame(
        spark, "patient_id string, d date, code string",
        ("a", day("2020-01-01"), "1"), ("a", day("2020-01-01"), "1"), ("a", None, "2"),
        (None, day("2021-01-01"), "1"), ("b", day("2020-01-01"), "3"),
    )
    rows = followup.concept_signal(events, "d", concepts).collect()
    assert [tuple(r) for r in rows] == [("x", 4, 2, day("2020-01-01"), day("2021-01-01"))]


def test_date_checks(spark):
    raw = {
        "patients": frame(
            spark, "Id string, BIRTHDATE string", ("a", "1970-01-01"), ("b", "bad"), ("c", None)
        )
    }
    rows = [tuple(r) for r in followup.date_parse_check(raw).collect()]
    assert rows == [("patients", "BIRTHDATE", 2, 1, False)]
    typed = {
        "patients": frame(
            spark, "birth_date date, death_date date",
            (day("2020-01-01"), day("2026-06-02")), (day("2026-06-01"), None),
        )
    }
    found = followup.future_date_check(typed, SILVER_DATES, "2026-06-01").collect()
    assert {(r.column_name, r.after_reference_date, r.passed) for r in found} == {
        ("birth_date", 0, True),
        ("death_date", 1, False),
    }


def test_common_model(spark):
    layer = {
        table: frame(
            spark,
            ", ".join(f"{c} string" for c in dict.fromkeys(c for _, c in columns)),
            tuple(str(i) for i in range(len(columns))),
        )
        for table, columns in followup.COMMON_MODEL.values()
    }
    tables = followup.common_model(layer)
    assert list(tables) == list(followup.COMMON_MODEL)
    for name, (_, columns) in followup.COMMON_MODEL.items():
        assert tables[name].columns == [target for target, _ in columns]
        assert tuple(tables[name].first()) == tuple(str(i) for i in range(len(columns)))


def test_costs_of_any_size(spark, either_size):
    w = windows(spark, *[(p, "2020-01-01", "2021-01-01", "window_end") for p in "abc"])
    visits = frame(
        spark, "patient_id string, d date, c double",
        ("a", day("2020-02-01"), 1e17), ("b", day("2020-02-01"), 10.005), ("b", day("2020-02-01"), 4e-5),
    )
    per_patient = followup.patient_costs({"visit": (visits, "d", "c")}, w)
    assert {r.patient_id: r.cost for r in per_patient.collect()} == {
        "a": 1e17, "b": pytest.approx(10.00504, abs=1e-12), "c": 0.0
    }
    assert followup.cost_summary(per_patient).first().max == 1e17


def test_spread_of_large_and_tiny_results(spark):
    schema = "concept_set string, patient_id string, value_numeric double, results long, day long, before_end boolean"
    for values, sd in (
        ([1e9 + 0.1, 1e9 + 0.2, 1e9 + 0.3], 0.1),
        ([100000.0001, 100000.0002, 100000.0003], 1e-4),
        ([0.00004, 0.00004, 0.00007], 1.7320508e-5),
        ([1e15, 1e15 + 2, 1e15 + 4], 2.0),
    ):
        rows = frame(spark, schema, *[("x", "a", v, 1, 5, True) for v in values])
        step = followup.lab_trajectory(rows).first()
        assert step.sd == pytest.approx(sd, rel=1e-5)
        assert step.mean == pytest.approx(sum(values) / 3, rel=1e-12)
        assert followup.lab_report(rows).first().mean == pytest.approx(sum(values) / 3, rel=1e-12)
