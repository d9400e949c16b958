from datetime import date

import pytest
from pyspark.sql import functions as F

from wardline.operators import cohort as cohorts
from wardline.operators import funnel
from wardline.spec import (
    PRIOR_EXCLUSION_CODE,
    TARGET_CODE,
    WINDOW_EXCLUSION_CODE,
    StudySpec,
)

T, P, W = TARGET_CODE, PRIOR_EXCLUSION_CODE, WINDOW_EXCLUSION_CODE
SPEC = StudySpec()


def build(clinic, patients, conditions, encounters, spec=SPEC):
    return cohorts.index_cohort(
        clinic.patients(*patients),
        clinic.conditions(*conditions),
        clinic.encounters(*encounters),
        spec,
    )


def only(frame):
    rows = frame.collect()
    assert len(rows) == 1
    return rows[0]


def test_first_qualifying_date_wins(clinic):
    row = only(
        build(
            clinic,
            [("p1", "1970-01-01")],
            [("p1", "e2", "2021-01-01", T), ("p1", "e1", "2020-01-01", T)],
            [("p1", "2018-01-01"), ("p1", "2019-01-01")],
        )
    )
    assert row.index_date == date(2020, 1, 1)
    assert row.index_encounter_id == "e1"
    assert row.age_at_index == 50
    assert row.first_observed_date == date(2018, 1, 1)
    assert row.observable_history_days_before_index == 730
    assert row.t2dm_condition_row_count == 2
    assert row.meets_final_phase1_rules


def test_columns_and_types(clinic):
    cohort = build(clinic, [("p1", "1970-01-01")], [("p1", "e", "2020-01-01", T)], [])
    assert tuple(cohort.columns) == cohorts.COHORT_COLUMNS
    types = dict(cohort.dtypes)
    assert types["age_at_index"] == "int"
    assert types["observable_history_days_before_index"] == "bigint"
    assert types["prior_t1dm_row_count"] == "bigint"
    assert types["baseline_days_required"] == "int"
    assert types["first_prior_t1dm_date"] == "date"


def test_short_history_fails(clinic):
    row = only(
        build(clinic, [("p1", "1970-01-01")], [("p1", "e", "2020-01-01", T)], [("p1", "2019-09-01")])
    )
    assert row.observable_history_days_before_index == 122
    assert not row.meets_baseline_history_rule
    assert not row.meets_final_phase1_rules


def test_under_age_fails(clinic):
    row = only(
        build(clinic, [("p1", "2010-01-01")], [("p1", "e", "2020-01-01", T)], [("p1", "2018-01-01")])
    )
    assert row.age_at_index == 10
    assert not row.meets_adult_age_rule


@pytest.mark.parametrize(
    "code, when, prior, window",
    [
        (P, "2019-01-01", True, False),
        (P, "2020-01-01", False, False),  # strict: the index day itself does not exclude
        (P, "2020-01-02", False, False),
        (W, "2019-01-01", False, True),
        (W, "2020-01-01", False, True),  # inclusive
        (W, "2020-01-02", False, False),
        (W, "1990-01-01", False, True),  # no lower bound
    ],
)
def test_exclusion_events(clinic, code, when, prior, window):
    row = only(
        build(
            clinic,
            [("p1", "1970-01-01")],
            [("p1", "e0", when, code), ("p1", "e0", when, code), ("p1", "e1", "2020-01-01", T)],
            [("p1", "2018-01-01")],
        )
    )
    assert row.has_prior_t1dm_before_index is prior
    assert row.has_pregnancy_window_before_or_at_index is window
    assert row.prior_t1dm_row_count == (2 if prior else 0)
    assert row.pregnancy_window_row_count == (2 if window else 0)
    assert row.first_prior_t1dm_date == (date.fromisoformat(when) if prior else None)
    assert row.meets_final_phase1_rules is not (prior or window)


def test_no_target_gives_no_rows(clinic):
    cohort = build(clinic, [("p1", "1970-01-01")], [("p1", "e", "2020-01-01", "123")], [])
    assert cohort.count() == 0
    assert len(cohort.columns) == 30


def test_undated_target_rows_do_not_qualify(clinic):
    cohort = build(
        clinic,
        [("p1", "1970-01-01")],
        [("p1", "e", None, T), ("p1", "e", None, P), ("p1", "e2", "2020-01-01", T)],
        [("p1", "2018-01-01")],
    )
    row = only(cohort)
    assert row.t2dm_condition_row_count == 1
    assert not row.has_prior_t1dm_before_index


def test_same_day_tie_takes_smallest_encounter(clinic):
    row = only(
        build(
            clinic,
            [("p1", "1970-01-01")],
            [
                ("p1", "e3", "2020-01-01", T, "c"),
                ("p1", "e2", "2020-01-01", T, "b"),
                ("p1", "e2", "2020-01-01", T, "a"),
            ],
            [],
        )
    )
    assert (row.index_encounter_id, row.index_condition_description) == ("e2", "a")
    assert row.t2dm_condition_row_count == 3


def test_history_null_or_negative_fails(clinic):
    rows = build(
        clinic,
        [("p1", "1970-01-01"), ("p2", "1970-01-01")],
        [("p1", "e", "2020-01-01", T), ("p2", "e", "2020-01-01", T)],
        [("p2", "2021-01-01")],
    ).collect()
    found = {r.patient_id: r for r in rows}
    assert found["p1"].observable_history_days_before_index is None
    assert found["p2"].observable_history_days_before_index == -366
    assert not found["p1"].meets_baseline_history_rule
    assert not found["p2"].meets_baseline_history_rule


def test_null_patient_is_one_cohort_row_without_attributes(clinic):
    cohort = build(
        clinic,
        [(None, "1970-01-01"), ("p1", "1970-01-01")],
        [
            (None, "e1", "2020-01-01", T),
            (None, "e2", "2019-01-01", T),
            (None, "e0", "2018-01-01", P),
            (None, "e0", "2018-01-01", W),
        ],
        [(None, "2010-01-01")],
    )
    row = only(cohort)
    assert row.patient_id is None
    assert row.index_date == date(2019, 1, 1)
    assert row.birth_date is None and row.first_observed_date is None
    # Null ids never match in a join, so no exclusion is found either.
    assert not row.has_prior_t1dm_before_index
    assert not row.has_pregnancy_window_before_or_at_index
    assert row.prior_t1dm_row_count == 0


def test_patient_absent_from_patients_stays(clinic):
    row = only(build(clinic, [], [("p9", "e", "2020-01-01", T)], [("p9", "2010-01-01")]))
    assert row.birth_date is None and row.age_at_index is None
    assert not row.meets_adult_age_rule


def test_duplicate_patients_multiply_rows_but_not_funnel_counts(clinic, monkeypatch):
    monkeypatch.setattr(cohorts, "COPY_BLOCK", 4)
    patients = [("p1", "1970-01-01")] * 11 + [("p1", "1971-01-01")] * 2 + [("p2", "1970-01-01")]
    conditions = [("p1", "e", "2020-01-01", T), ("p2", "e", "2020-01-01", T)]
    encounters = [("p1", "2010-01-01"), ("p2", "2010-01-01")]
    cohort = build(clinic, patients, conditions, encounters)
    counts = {
        (r.patient_id, r.birth_date.year): r["count"]
        for r in cohort.groupBy("patient_id", "birth_date").count().collect()
    }
    assert counts == {("p1", 1970): 11, ("p1", 1971): 2, ("p2", 1970): 1}
    steps = funnel.attrition(clinic.patients(*patients), cohort, SPEC).collect()
    assert [s.remaining_n for s in steps] == [2] * 7


def test_other_codes_and_thresholds(clinic):
    spec = StudySpec("a", "b", "c", minimum_age_years=51, baseline_days=1000)
    row = only(
        build(
            clinic,
            [("p1", "1970-01-01")],
            [("p1", "e", "2020-01-01", "a"), ("p1", "e", "2019-01-01", "b")],
            [("p1", "2018-01-01")],
            spec,
        )
    )
    assert (row.target_t2dm_code, row.prior_t1dm_exclusion_code) == ("a", "b")
    assert row.baseline_days_required == 1000
    assert not row.meets_adult_age_rule and not row.meets_baseline_history_rule
    assert row.has_prior_t1dm_before_index


def test_codes_compare_as_text(clinic):
    numbers = clinic.conditions(("p1", "e", "2020-01-01", T)).withColumn(
        "code", F.col("code").cast("bigint")
    )
    cohort = cohorts.index_cohort(clinic.patients(), numbers, clinic.encounters(), SPEC)
    assert only(cohort).index_condition_code == T


def test_missing_columns_raise(clinic):
    with pytest.raises(ValueError, match="birth_date"):
        cohorts.index_cohort(
            clinic.patients().drop("birth_date"), clinic.conditions(), clinic.encounters(), SPEC
        )
    with pytest.raises(ValueError, match="code"):
        cohorts.index_cohort(
            clinic.patients(),
            clinic.conditions().withColumnRenamed("code", "CODE"),
            clinic.encounters(),
            SPEC,
        )


def test_single_steps_agree_with_the_combined_plan(clinic, spark):
    rows = [
        (f"p{i % 7}", f"e{i % 5}", f"20{10 + i % 9:02d}-0{1 + i % 8}-1{i % 9}", [T, P, W][i % 3])
        for i in range(200)
    ]
    conditions = clinic.conditions(*rows)
    cohort = cohorts.index_cohort(clinic.patients(), conditions, clinic.encounters(), SPEC)
    first = cohorts.first_event_per_patient(conditions, T)
    index = first.select("patient_id", "index_date")
    prior = cohorts.exclusion_flags(
        conditions, index, P, "has_prior_t1dm_before_index", "first_prior_t1dm_date",
        "prior_t1dm_row_count", include_index_date=False,
    )
    window = cohorts.exclusion_flags(
        conditions, index, W, "has_pregnancy_window_before_or_at_index",
        "first_pregnancy_window_date", "pregnancy_window_row_count", include_index_date=True,
    )
    stepwise = first.join(prior, "patient_id", "left").join(window, "patient_id", "left")
    combined = cohort.select(*stepwise.columns)
    filled = stepwise.fillna(False).fillna(0)
    assert sorted(map(str, combined.collect())) == sorted(map(str, filled.collect()))


def test_golden_ages_and_history(clinic):
    """Two patients with published results."""
    cohort = build(
        clinic,
        [("a", "1943-07-14", "2017-08-14"), ("b", "1943-07-14", "2025-09-05")],
        [("a", "e", "1993-04-28", T), ("b", "e", "1995-07-26", T)],
        [("a", "1953-11-18"), ("b", "1961-09-06")],
    )
    found = {
        r.patient_id: (r.age_at_index, r.observable_history_days_before_index)
        for r in cohort.collect()
    }
    assert found == {"a": (49, 14406), "b": (52, 12376)}


def test_funnel_steps(spark):
    schema = (
        "patient_id string, index_date date, age_at_index bigint, meets_adult_age_rule boolean,"
        " observable_history_days_before_index bigint, meets_baseline_history_rule boolean,"
        " has_prior_t1dm_before_index boolean,"
        " has_pregnancy_window_before_or_at_index boolean, meets_final_phase1_rules boolean"
    )
    d = date(2020, 1, 1)
    patients = spark.createDataFrame([("p1",), ("p2",), ("p3",), ("p4",)], "patient_id string")
    cohort = spark.createDataFrame(
        [
            ("p1", d, 50, True, 730, True, False, False, True),
            ("p2", d, 50, True, 100, False, False, False, False),
            ("p3", d, 50, True, 730, True, True, False, False),
        ],
        schema,
    )
    steps = funnel.attrition(patients, cohort, SPEC).orderBy("step_number").collect()
    assert [s.remaining_n for s in steps] == [4, 3, 3, 2, 1, 1, 1]
    assert [s.excluded_n for s in steps] == [0, 1, 0, 1, 1, 0, 0]
    assert [s.input_n for s in steps] == [4, 4, 3, 3, 2, 1, 1]
    assert [s.step_id for s in steps][3] == "baseline_history_365_days"

    two = patients.limit(2)
    empty = funnel.attrition(two, cohort.where("false"), SPEC).orderBy("step_number").collect()
    assert [s.remaining_n for s in empty] == [2, 0, 0, 0, 0, 0, 0]

    # A null rule value drops out of its step; a null id counts as one patient; cohort patients
    # unknown to the patient table can push a count below zero.
    odd = spark.createDataFrame(
        [
            (None, d, None, None, 730, True, False, False, False),
            ("x", d, 50, True, 730, None, False, False, False),
            ("y", d, 50, True, 730, True, None, False, False),
        ],
        schema,
    )
    one = spark.createDataFrame([("p1",)], "patient_id string")
    steps = funnel.attrition(one, odd, SPEC).orderBy("step_number").collect()
    assert [s.remaining_n for s in steps] == [1, 3, 2, 1, 0, 0, 0]
    assert steps[1].excluded_n == -2

    with pytest.raises(ValueError, match="meets_final_phase1_rules"):
        funnel.attrition(patients, cohort.drop("meets_final_phase1_rules"), SPEC)


def test_index_summary_counts_rows(clinic):
    patients = clinic.patients(("p1", "1970-01-01"), ("p2", "2015-01-01"), ("p3", "1970-01-01"))
    conditions = clinic.conditions(
        ("p1", "e", "2020-01-01", T),
        ("p1", "e", "2021-01-01", T),
        ("p2", "e", "2020-01-01", T),
        ("p3", "e", "2020-01-01", T),
        ("p3", "e", "2019-01-01", P),
        ("p3", "e", None, T),
    )
    encounters = clinic.encounters(("p1", "2010-01-01"), ("p2", "2016-01-01"), ("p3", "2010-01-01"))
    cohort = cohorts.index_cohort(patients, conditions, encounters, SPEC)
    row = only(funnel.index_summary(patients, conditions, encounters, cohort, SPEC)).asDict()
    assert row == {
        "patients_total": 3,
        "conditions_total": 6,
        "encounters_total": 3,
        "t2dm_condition_rows": 4,
        "t2dm_patient_count": 3,
        "index_cohort_rows": 3,
        "adult_index_cohort_rows": 2,
        "underage_index_cohort_rows": 1,
        "baseline_history_eligible_rows": 2,
        "baseline_history_ineligible_rows": 0,
        "prior_t1dm_excluded_rows": 1,
        "pregnancy_window_excluded_rows": 0,
        "final_phase1_eligible_rows": 1,
    }


def test_final_cohort_and_age_statistics(clinic):
    cohort = build(
        clinic,
        [("p1", "1970-01-01"), ("p2", "2010-01-01")],
        [("p1", "e", "2020-01-01", T), ("p2", "e", "2020-01-01", T)],
        [("p1", "2018-01-01"), ("p2", "2018-01-01")],
    )
    assert [r.patient_id for r in cohorts.final_cohort(cohort).collect()] == ["p1"]
    stats = only(funnel.final_summary(cohort))
    assert (stats.index_cohort_rows, stats.final_cohort_rows, stats.excluded_from_final_rows) == (2, 1, 1)
    assert (stats.min_age_at_index, stats.max_age_at_index, stats.mean_age_at_index) == (50, 50, 50.0)

    none = only(funnel.final_summary(cohort.where(F.col("patient_id") == "p2")))
    assert none.final_cohort_rows == 0
    assert none.min_age_at_index is None and none.mean_age_at_index is None
    with pytest.raises(ValueError, match="meets_adult_age_rule"):
        cohorts.final_cohort(cohort.drop("meets_adult_age_rule"))


def test_spec_rejects_bad_values():
    with pytest.raises(ValueError):
        StudySpec(minimum_age_years=-1)
    with pytest.raises(ValueError):
        StudySpec(baseline_days="365")
    assert StudySpec(target_code=123).target_code == "123"
