"""Attrition funnel and the one-row run summaries of the cohort stages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expr import has_code, is_false, is_true, require_columns
from ..spec import StudySpec, codes_text

FUNNEL_COLUMNS = (
    "patient_id", "index_date", "age_at_index", "meets_adult_age_rule",
    "observable_history_days_before_index", "meets_baseline_history_rule",
    "has_prior_t1dm_before_index", "has_pregnancy_window_before_or_at_index",
    "meets_final_phase1_rules",
)


def funnel_steps(spec: StudySpec) -> list[tuple[str, str, str]]:
    """(step_id, criterion, notes) per step: fixed texts, with the spec's values filled in."""
    return [
        (
            "raw_synthea_population",
            "Raw Synthea population with patient records",
            "Starting population from silver patients table.",
        ),
        (
            "has_t2dm_diagnosis",
            "At least one qualifying Type 2 Diabetes Mellitus diagnosis",
            f"Uses SNOMED code {codes_text(spec.target_code)} from silver conditions table.",
        ),
        (
            "adult_at_index",
            f"Age >= {spec.minimum_age_years} years at first qualifying T2DM index date",
            "Age calculated at the first qualifying T2DM diagnosis date.",
        ),
        (
            f"baseline_history_{spec.baseline_days}_days",
            f"At least {spec.baseline_days} days of observable history before index date",
            "Observable history currently measured from earliest encounter date to index date.",
        ),
        (
            "exclude_prior_type_1_diabetes",
            "No prior Type 1 Diabetes Mellitus diagnosis before index date",
            f"Uses SNOMED code {codes_text(spec.prior_exclusion_code)} before the T2DM index date.",
        ),
        (
            "exclude_pregnancy_window",
            "No pregnancy or gestational-window diagnosis before or at index date",
            f"Uses SNOMED code {codes_text(spec.window_exclusion_code)} before or at the T2DM index date.",
        ),
        (
            "final_analytical_cohort",
            "Final Phase 1 analytical cohort",
            "Patients meeting adult age, baseline history, and exclusion rules.",
        ),
    ]


def attrition(patients: DataFrame, cohort: DataFrame, spec: StudySpec) -> DataFrame:
    """Seven funnel rows of distinct patients (a null id counts as one patient).

    Every patient and cohort row carries the set of steps it reaches as bits; one aggregate by
    patient merges them, one global aggregate counts them. A single shuffle in all.
    """
    require_columns(patients, ("patient_id",), "patients table")
    require_columns(cohort, FUNNEL_COLUMNS, "index cohort")

    adult = is_true(F.col("meets_adult_age_rule"))
    history = adult & is_true(F.col("meets_baseline_history_rule"))
    no_prior = history & is_false(F.col("has_prior_t1dm_before_index"))
    no_window = no_prior & is_false(F.col("has_pregnancy_window_before_or_at_index"))
    final = is_true(F.col("meets_final_phase1_rules"))
    reached = F.lit(2)
    for bit, passed in ((4, adult), (8, history), (16, no_prior), (32, no_window), (64, final)):
        reached = reached + F.when(passed, bit).otherwise(0)

    per_patient = (
        patients.select("patient_id", F.lit(1).alias("steps"))
        .unionByName(cohort.select("patient_id", reached.alias("steps")))
        .groupBy("patient_id")
        .agg(F.bit_or("steps").alias("steps"))
    )
    texts = funnel_steps(spec)
    counts = per_patient.agg(
        *[
            F.count_if(F.col("steps").bitwiseAND(1 << i) != 0).alias(f"n{i}")
            for i in range(len(texts))
        ]
    )

    rows = []
    for i, (step_id, criterion, notes) in enumerate(texts):
        before, after = F.col(f"n{max(i - 1, 0)}"), F.col(f"n{i}")
        rows.append(
            F.struct(
                F.lit(i + 1).cast("bigint").alias("step_number"),
                F.lit(step_id).alias("step_id"),
                F.lit(criterion).alias("criterion"),
                before.alias("input_n"),
                (before - after).alias("excluded_n"),
                after.alias("remaining_n"),
                F.lit(notes).alias("notes"),
            )
        )
    return counts.select(F.inline(F.array(*rows)))


def index_summary(
    patients: DataFrame,
    conditions: DataFrame,
    encounters: DataFrame,
    cohort: DataFrame,
    spec: StudySpec,
) -> DataFrame:
    """One row of row counts for the index build."""
    qualifying = has_code(spec.target_code) & F.col("condition_start_date").isNotNull()
    total = F.count(F.lit(1)).alias("n")
    adult = F.col("meets_adult_age_rule")
    history = adult & F.col("meets_baseline_history_rule")
    no_prior = history & F.col("meets_prior_t1dm_exclusion_rule")
    counts = cohort.agg(
        total.alias("index_cohort_rows"),
        F.count_if(adult).alias("adult"),
        F.count_if(history).alias("history"),
        F.count_if(no_prior).alias("no_prior"),
        F.count_if(F.col("meets_final_phase1_rules")).alias("final"),
    )
    # One pass over the conditions. A null patient counts as one.
    patient = F.col("patient_id")
    null_patient = F.max(F.when(qualifying & patient.isNull(), 1).otherwise(0))
    of_conditions = conditions.agg(
        F.struct(
            total,
            F.count_if(qualifying).alias("targets"),
            (
                F.count_distinct(F.when(qualifying, patient)) + F.coalesce(null_patient, F.lit(0))
            ).alias("patients"),
        ).alias("t")
    ).scalar()
    return counts.select(
        patients.agg(total).scalar().alias("patients_total"),
        of_conditions.getField("n").alias("conditions_total"),
        encounters.agg(total).scalar().alias("encounters_total"),
        of_conditions.getField("targets").alias("t2dm_condition_rows"),
        of_conditions.getField("patients").cast("bigint").alias("t2dm_patient_count"),
        "index_cohort_rows",
        F.col("adult").alias("adult_index_cohort_rows"),
        (F.col("index_cohort_rows") - F.col("adult")).alias("underage_index_cohort_rows"),
        F.col("history").alias("baseline_history_eligible_rows"),
        (F.col("adult") - F.col("history")).alias("baseline_history_ineligible_rows"),
        (F.col("history") - F.col("no_prior")).alias("prior_t1dm_excluded_rows"),
        (F.col("no_prior") - F.col("final")).alias("pregnancy_window_excluded_rows"),
        F.col("final").alias("final_phase1_eligible_rows"),
    )


def final_summary(cohort: DataFrame) -> DataFrame:
    """Row counts and age statistics of the final cohort; the statistics are null if it is
    empty."""
    eligible = is_true(F.col("meets_final_phase1_rules"))
    age = F.when(eligible, F.col("age_at_index"))
    return cohort.agg(
        F.count(F.lit(1)).alias("index_cohort_rows"),
        F.count_if(eligible).alias("final_cohort_rows"),
        F.count_if(~eligible).alias("excluded_from_final_rows"),
        F.min(age).alias("min_age_at_index"),
        F.max(age).alias("max_age_at_index"),
        F.avg(age).alias("mean_age_at_index"),
    )
