"""Index cohort: first qualifying event per patient, eligibility rules, final cohort.

Event rows are collapsed to one row per (patient, day) before anything is moved by patient
alone, so a patient who owns a large share of all rows reaches the per-patient stage with at
most one row per calendar day.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import (
    completed_years,
    days_between,
    code_list,
    has_code,
    is_true,
    require_columns,
)
from ..spec import StudySpec, codes_text

PATIENT_COLUMNS = ("patient_id", "birth_date", "death_date", "sex", "race", "ethnicity")
CONDITION_COLUMNS = ("patient_id", "encounter_id", "condition_start_date", "code", "description")
ENCOUNTER_COLUMNS = ("patient_id", "encounter_start_date")

# Fixed output order of the index cohort.
COHORT_COLUMNS = (
    "patient_id", "index_date", "index_encounter_id", "index_condition_code",
    "index_condition_description", "t2dm_condition_row_count", "birth_date", "death_date",
    "sex", "race", "ethnicity", "first_observed_date", "has_prior_t1dm_before_index",
    "first_prior_t1dm_date", "prior_t1dm_row_count",
    "has_pregnancy_window_before_or_at_index", "first_pregnancy_window_date",
    "pregnancy_window_row_count", "age_at_index", "observable_history_days_before_index",
    "meets_adult_age_rule", "meets_baseline_history_rule", "meets_prior_t1dm_exclusion_rule",
    "meets_pregnancy_exclusion_rule", "target_t2dm_code", "prior_t1dm_exclusion_code",
    "pregnancy_exclusion_code", "baseline_days_required", "cohort_name",
    "meets_final_phase1_rules",
)

# Copies of one patient row are multiplied back in blocks of this many rows.
COPY_BLOCK = 65536

# A patient list up to this size is broadcast to event tables; a row takes this much besides its id.
BROADCAST_BYTES = 128 * 1024 * 1024
ROW_BYTES = 96


def first_event_per_patient(conditions: DataFrame, code) -> DataFrame:
    """Earliest dated event with `code` (one, or any of a tuple) per patient, and how many such rows
    there are. Ties on the day go to the smallest (encounter_id, description, code)."""
    day = _coded_days(conditions, has_code(code))
    return day.groupBy("patient_id").agg(
        F.min("condition_start_date").alias("index_date"),
        F.min_by("first_row", "condition_start_date").alias("first_row"),
        F.sum("row_count").alias("t2dm_condition_row_count"),
    ).select(
        "patient_id",
        "index_date",
        F.col("first_row.encounter_id").alias("index_encounter_id"),
        F.col("first_row.code").cast("string").alias("index_condition_code"),
        F.col("first_row.description").alias("index_condition_description"),
        "t2dm_condition_row_count",
    )


def rows_per_day(events: DataFrame, date_column: str, *keys: str, **sums: Column) -> DataFrame:
    """Dated events merged per patient, day and extra keys, with their number and given sums."""
    return (
        events.where(F.col(date_column).isNotNull())
        .groupBy("patient_id", date_column, *keys)
        .agg(F.count(F.lit(1)).alias("row_count"), *[c.alias(name) for name, c in sums.items()])
    )


def first_observed(encounters: DataFrame) -> DataFrame:
    """First encounter day per patient."""
    return (
        encounters.where(F.col("encounter_start_date").isNotNull())
        .groupBy("patient_id")
        .agg(F.min("encounter_start_date").alias("first_observed_date"))
    )


def exclusion_flags(
    conditions: DataFrame,
    index: DataFrame,
    code: str,
    flag: str,
    first_date: str,
    row_count: str,
    include_index_date: bool,
    earliest: Column | None = None,
    latest: Column | None = None,
) -> DataFrame:
    """Patients with a dated `code` event before (or on) their index date. Patients without one
    get no row. `earliest` / `latest` replace the default open start and index-date end."""
    day = rows_per_day(conditions.where(has_code(code)), "condition_start_date")
    start, index_date = F.col("condition_start_date"), F.col("index_date")
    if latest is not None:
        hit = start <= latest
    else:
        hit = start <= index_date if include_index_date else start < index_date
    if earliest is not None:
        hit = hit & (start >= earliest)
    return (
        day.join(index, "patient_id")
        .where(hit)
        .groupBy("patient_id")
        .agg(
            F.lit(True).alias(flag),
            F.min("condition_start_date").alias(first_date),
            F.sum("row_count").alias(row_count),
        )
    )


def fits_broadcast(frame: DataFrame, limit: int | None = None) -> bool:
    """Size check of a one-row-per-patient side, from its row count and the length of its ids;
    cheap on a written table. `limit` is in bytes, BROADCAST_BYTES by default. It chooses the plan
    only; both plans give the same rows."""
    rows, id_bytes = frame.agg(
        F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("patient_id")), F.lit(0))
    ).first()
    return rows * ROW_BYTES + id_bytes <= (BROADCAST_BYTES if limit is None else limit)


def of_patients(
    known: DataFrame, *tables: DataFrame, limit: int | None = None
) -> list[DataFrame]:
    """The tables, cut to rows of the patients in `known` (a written table) if those are few enough
    to broadcast; unchanged otherwise, as the joins to come drop the other rows anyway."""
    if not fits_broadcast(known, limit):
        return list(tables)
    ids = F.broadcast(known.select("patient_id"))
    return [table.join(ids, "patient_id", "left_semi") for table in tables]


def index_cohort(
    patients: DataFrame,
    conditions: DataFrame,
    encounters: DataFrame,
    spec: StudySpec,
    stage: Callable[[DataFrame], DataFrame] | None = None,
    limit: int | None = None,
) -> DataFrame:
    """One row per (patient with a qualifying event, matching patient row), with every rule
    evaluated. Each table is scanned once; unsorted, because order belongs to the sink.

    With `stage` (a function that writes a frame and reads it back) the index events are written
    first. If they turn out small, their patients are broadcast to the scans of the other two
    tables, so that rows of patients outside the cohort are never exchanged.
    """
    require_columns(patients, PATIENT_COLUMNS, "patients table")
    require_columns(conditions, CONDITION_COLUMNS, "conditions table")
    require_columns(encounters, ENCOUNTER_COLUMNS, "encounters table")

    events = index_from_days(coded_days(conditions, spec))
    if stage is not None:
        events = stage(events)
        patients, encounters = of_patients(events, patients, encounters, limit=limit)
    return multiply_copies(cohort_blocks(events, patient_copies(patients), first_observed(encounters), spec))


def cohort_blocks(events: DataFrame, copies: DataFrame, seen: DataFrame, spec: StudySpec) -> DataFrame:
    """Cohort rows with all rules, a row per block of equal ones."""
    joined = events.join(_patient_blocks(copies), "patient_id", "left").join(seen, "patient_id", "left")
    return _with_rules(joined, spec)


def final_cohort(cohort: DataFrame) -> DataFrame:
    """The eligible rows, all columns kept."""
    require_columns(
        cohort,
        (
            "patient_id", "index_date", "age_at_index", "meets_adult_age_rule",
            "meets_baseline_history_rule", "meets_prior_t1dm_exclusion_rule",
            "meets_pregnancy_exclusion_rule", "meets_final_phase1_rules",
        ),
        "index cohort",
    )
    return cohort.where(F.col("meets_final_phase1_rules"))


def report_order(cohort: DataFrame) -> DataFrame:
    """Order of the written cohort tables."""
    return cohort.orderBy(F.asc_nulls_first("index_date"), F.asc_nulls_first("patient_id"))


def _coded_days(conditions: DataFrame, wanted: Column) -> DataFrame:
    return (
        conditions.where(wanted & F.col("condition_start_date").isNotNull())
        .groupBy("patient_id", "condition_start_date")
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.min(F.struct("encounter_id", "description", "code")).alias("first_row"),
        )
    )


def coded_days(conditions: DataFrame, spec: StudySpec) -> DataFrame:
    """Dated events with a code of the three rules, merged per (patient, day): rows of each rule, and
    the smallest target row. Days of several parts of the table merge by `merged_days`."""
    rules = (spec.target_code, spec.prior_exclusion_code, spec.window_exclusion_code)
    target, prior, window = (has_code(rule) for rule in rules)
    codes = dict.fromkeys(code for rule in rules for code in code_list(rule))
    day = F.col("condition_start_date")
    return (
        conditions.where(F.col("code").cast("string").isin(*codes) & day.isNotNull())
        .groupBy("patient_id", "condition_start_date")
        .agg(
            F.count_if(target).alias("target_rows"),
            F.count_if(prior).alias("prior_rows"),
            F.count_if(window).alias("window_rows"),
            F.min(F.when(target, F.struct("encounter_id", "description", "code"))).alias("first_row"),
        )
    )


def merged_days(days: DataFrame) -> DataFrame:
    """Days of parts of the table as the days of the whole."""
    rows = [F.sum(f"{rule}_rows").alias(f"{rule}_rows") for rule in ("target", "prior", "window")]
    return days.groupBy("patient_id", "condition_start_date").agg(*rows, F.min("first_row").alias("first_row"))


def index_from_days(days: DataFrame) -> DataFrame:
    """Index event and both exclusion flags of each patient with a target day."""
    day = F.col("condition_start_date")
    by_patient = Window.partitionBy("patient_id")
    index_date = F.col("index_date")
    known = F.col("patient_id").isNotNull()
    is_prior = known & (F.col("prior_rows") > 0) & (day < index_date)
    is_window = known & (F.col("window_rows") > 0) & (day <= index_date)
    return (
        days.withColumn("index_date", F.min(F.when(F.col("target_rows") > 0, day)).over(by_patient))
        .where(index_date.isNotNull())
        .groupBy("patient_id")
        .agg(
            F.min("index_date").alias("index_date"),
            F.max(F.when(day == index_date, F.col("first_row"))).alias("first_row"),
            F.sum("target_rows").alias("t2dm_condition_row_count"),
            F.min(F.when(is_prior, day)).alias("first_prior_t1dm_date"),
            F.sum(F.when(is_prior, F.col("prior_rows")).otherwise(0)).alias("prior_t1dm_row_count"),
            F.min(F.when(is_window, day)).alias("first_pregnancy_window_date"),
            F.sum(F.when(is_window, F.col("window_rows")).otherwise(0)).alias(
                "pregnancy_window_row_count"
            ),
        )
        .select(
            "*",
            F.col("first_row.encounter_id").alias("index_encounter_id"),
            F.col("first_row.code").cast("string").alias("index_condition_code"),
            F.col("first_row.description").alias("index_condition_description"),
            F.col("first_prior_t1dm_date").isNotNull().alias("has_prior_t1dm_before_index"),
            F.col("first_pregnancy_window_date")
            .isNotNull()
            .alias("has_pregnancy_window_before_or_at_index"),
        )
        .drop("first_row")
    )


def patient_copies(patients: DataFrame) -> DataFrame:
    """Patient attributes with equal rows collapsed to a count. Patients are exchanged twice for it, by
    the whole row and then by id: equal rows must merge before they move, which an exchange by id
    alone would undo for a patient with very many copies."""
    return (
        patients.where(F.col("patient_id").isNotNull())
        .groupBy(*PATIENT_COLUMNS)
        .agg(F.count(F.lit(1)).alias("copies"))
    )


def _patient_blocks(copies: DataFrame) -> DataFrame:
    """Copies cut into bounded blocks, so that a patient copied very often adds a handful of rows to
    the join instead of all copies."""
    blocks = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("copies") - 1) / COPY_BLOCK))
    return copies.select("*", F.explode(blocks).alias("block")).select(
        *PATIENT_COLUMNS,
        F.least(F.lit(COPY_BLOCK), F.col("copies") - F.col("block") * COPY_BLOCK)
        .cast("int")
        .alias("copies_in_block"),
    )


def multiply_copies(rows: DataFrame) -> DataFrame:
    """Give every copy its own row again; rows are produced one block at a time."""
    copy = F.explode(F.expr("array_repeat(1, coalesce(copies_in_block, 1))"))
    return rows.select("*", copy.alias("copy")).select(*COHORT_COLUMNS)


def _with_rules(joined: DataFrame, spec: StudySpec) -> DataFrame:
    age = completed_years(F.col("birth_date"), F.col("index_date"))
    history = days_between(F.col("first_observed_date"), F.col("index_date"))
    return (
        joined.withColumns({"age_at_index": age, "observable_history_days_before_index": history})
        .withColumns(
            {
                "meets_adult_age_rule": is_true(
                    F.col("age_at_index") >= F.lit(spec.minimum_age_years)
                ),
                "meets_baseline_history_rule": is_true(
                    F.col("observable_history_days_before_index") >= F.lit(spec.baseline_days)
                ),
                "meets_prior_t1dm_exclusion_rule": ~F.col("has_prior_t1dm_before_index"),
                "meets_pregnancy_exclusion_rule": ~F.col("has_pregnancy_window_before_or_at_index"),
                "target_t2dm_code": F.lit(codes_text(spec.target_code)),
                "prior_t1dm_exclusion_code": F.lit(codes_text(spec.prior_exclusion_code)),
                "pregnancy_exclusion_code": F.lit(codes_text(spec.window_exclusion_code)),
                "baseline_days_required": F.lit(spec.baseline_days),
                "cohort_name": F.lit(spec.cohort_name),
            }
        )
        .withColumn(
            "meets_final_phase1_rules",
            F.col("meets_adult_age_rule")
            & F.col("meets_baseline_history_rule")
            & F.col("meets_prior_t1dm_exclusion_rule")
            & F.col("meets_pregnancy_exclusion_rule"),
        )
    )
