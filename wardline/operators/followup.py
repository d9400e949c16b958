"""Summaries the study definition names beyond the baseline report: follow-up window, exposure,
utilisation, cost, laboratory results, survival, date checks, concept sets, common data model.

A small cohort is broadcast to the event scans, behind a size check. For a larger one event rows are
merged per patient and day before the join, so one patient with very many events stays small in it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.expr import days_between, lenient_date
from ..functions.quantiles import exact_quantiles
from ..spec import CONCEPT_SETS, SILVER_LAYOUT, StudySpec
from .cohort import fits_broadcast, rows_per_day

QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


# --- concept sets and date checks ------------------------------------------------------------


def concept_frame(spark: SparkSession, sets: dict = CONCEPT_SETS) -> DataFrame:
    """One row per code of every concept set; a set without codes has no row. Made of literals, so
    the planner knows how small it is and broadcasts it."""
    names = ("concept_set", "vocabulary", "code", "display", "use")
    rows = [
        F.struct(*[F.lit(v).alias(n) for v, n in zip((name, vocabulary, code, display, use), names)])
        for name, (vocabulary, use, codes) in sets.items()
        for code, display in codes
    ]
    whole = F.array(*rows).cast(f"array<struct<{','.join(f'{n}:string' for n in names)}>>")
    return spark.range(1).select(F.inline(whole))


def coded_events(events: DataFrame, sets: dict) -> DataFrame:
    """Events whose code is in a concept set, once for each set that lists it: a code listed twice
    in a set, or under two vocabularies, counts once. The codes are a filter of plain values, which
    reaches the scan; the pairs of set and code are literals too, so their size is known."""
    pairs = sorted({(name, str(code)) for name, (_, _, codes) in sets.items() for code, _ in codes})
    if not pairs:
        return events.where(F.lit(False)).withColumn("concept_set", F.lit(None).cast("string"))
    wanted = sorted({code for _, code in pairs})
    listed = F.array(*[F.struct(F.lit(s).alias("concept_set"), F.lit(c).alias("code")) for s, c in pairs])
    concepts = events.sparkSession.range(1).select(F.inline(listed))
    return events.where(F.col("code").isin(wanted)).join(F.broadcast(concepts), "code")


def concept_signal(events: DataFrame, date_column: str, sets: dict) -> DataFrame:
    """Rows, distinct patients (null being one) and date range per concept set with at least one
    event."""
    per_patient = (
        coded_events(events, sets)
        .groupBy("concept_set", "patient_id")
        .agg(
            F.count(F.lit(1)).alias("c"),
            F.min(date_column).alias("first"),
            F.max(date_column).alias("last"),
        )
    )
    return per_patient.groupBy("concept_set").agg(
        F.sum("c").alias("row_count"),
        F.count(F.lit(1)).alias("patient_count"),
        F.min("first").alias("earliest_date"),
        F.max("last").alias("latest_date"),
    )


def date_parse_check(layer: dict[str, DataFrame]) -> DataFrame:
    """Per raw date column: filled values, and filled values that hold no date."""
    parts = []
    for table, frame in layer.items():
        sources = dict.fromkeys(s for s, _, kind in SILVER_LAYOUT[table] if kind == "date")
        present = [s for s in sources if s in frame.columns]
        lines = [
            F.struct(
                F.lit(table).alias("table_name"),
                F.lit(s).alias("column_name"),
                F.count(F.col(s)).alias("filled"),
                F.count_if(F.col(s).isNotNull() & lenient_date(F.col(s)).isNull()).alias(
                    "unreadable"
                ),
            )
            for s in present
        ]
        if lines:
            parts.append(frame.agg(F.array(*lines).alias("lines")).select(F.inline("lines")))
    checks = reduce(DataFrame.unionByName, parts)
    return checks.withColumn("passed", F.col("unreadable") == 0)


def future_date_check(layer: dict[str, DataFrame], dates: dict, reference_date: str) -> DataFrame:
    """Per typed date column: values after the reference date."""
    limit = F.lit(reference_date).cast("date")
    parts = []
    for table, frame in layer.items():
        lines = [
            F.struct(
                F.lit(table).alias("table_name"),
                F.lit(c).alias("column_name"),
                F.count_if(F.col(c) > limit).alias("after_reference_date"),
            )
            for c in dates[table]
            if c in frame.columns
        ]
        if lines:
            parts.append(frame.agg(F.array(*lines).alias("lines")).select(F.inline("lines")))
    checks = reduce(DataFrame.unionByName, parts)
    return checks.withColumn("passed", F.col("after_reference_date") == 0)


# --- windows ---------------------------------------------------------------------------------


def followup_window(cohort: DataFrame, encounters: DataFrame, spec: StudySpec) -> DataFrame:
    """One row per cohort patient: follow-up from the index date to the earliest of the window
    end, death and the end of the record, and which of them ended it. The record ends with the last
    encounter or the death, whichever is later: a dated death is itself a record, so a death after
    the last encounter is a death in follow-up and not the end of the record."""
    last_seen = (
        encounters.where(F.col("encounter_start_date").isNotNull())
        .groupBy("patient_id")
        .agg(F.max("encounter_start_date").alias("last_observed_date"))
    )
    window_end = F.add_months("index_date", spec.follow_up_months)
    record_end = F.coalesce("death_date", "last_observed_date")
    end = F.greatest("index_date", F.least("window_end", record_end))
    return (
        cohort.groupBy("patient_id")
        .agg(F.min("index_date").alias("index_date"), F.min("death_date").alias("death_date"))
        .join(last_seen, "patient_id", "left")
        .withColumn("window_end", window_end)
        .withColumn("follow_up_end", end)
        .select(
            "patient_id",
            "index_date",
            "follow_up_end",
            F.when(F.col("death_date") <= F.col("follow_up_end"), "death")
            .when(F.col("window_end") <= F.col("follow_up_end"), "window_end")
            .otherwise("end_of_record")
            .alias("end_reason"),
            days_between(F.col("index_date"), F.col("follow_up_end")).alias("follow_up_days"),
        )
    )


def baseline_window(cohort: DataFrame, encounters: DataFrame, spec: StudySpec) -> DataFrame:
    """One row per cohort patient: encounters in the days before the index date, which itself
    does not belong to the window."""
    index = cohort.groupBy("patient_id").agg(F.min("index_date").alias("index_date"))
    day = F.col("encounter_start_date")
    inside = (day >= F.date_sub("index_date", spec.baseline_days)) & (day < F.col("index_date"))
    hits = (
        rows_per_day(encounters, "encounter_start_date")
        .join(index, "patient_id")
        .where(inside)
        .groupBy("patient_id")
        .agg(F.sum("row_count").alias("events"))
    )
    return index.join(hits, "patient_id", "left").select(
        "patient_id",
        "index_date",
        F.col("events").isNotNull().alias("has_baseline_encounter"),
        F.coalesce("events", F.lit(0)).alias("baseline_encounter_count"),
    )


def followup_totals(
    events: DataFrame,
    date_column: str,
    windows: DataFrame,
    *keys: str,
    limit: int | None = None,
    **sums: Column,
) -> DataFrame:
    """Events within each patient's follow-up, as one row per patient and extra keys: their number
    (`events`) and the given sums.

    A cohort within `limit` bytes is broadcast: events are filtered where they are read and merged
    map-side. A larger one joins events that were first merged per patient and day, which bounds
    what one patient brings to the join. Both give the same rows.
    """
    bounds = windows.select("patient_id", "index_date", "follow_up_end")
    inside = F.col(date_column).between(F.col("index_date"), F.col("follow_up_end"))
    if fits_broadcast(windows, limit):
        return (
            events.join(F.broadcast(bounds), "patient_id")
            .where(inside)
            .groupBy("patient_id", *keys)
            .agg(
                F.count(F.lit(1)).alias("events"), *[F.sum(c).alias(n) for n, c in sums.items()]
            )
        )
    daily = rows_per_day(events, date_column, *keys, **{n: F.sum(c) for n, c in sums.items()})
    return (
        daily.join(bounds, "patient_id")
        .where(inside)
        .groupBy("patient_id", *keys)
        .agg(F.sum("row_count").alias("events"), *[F.sum(n).alias(n) for n in sums])
    )


def _cohort_size(windows: DataFrame) -> Column:
    return windows.agg(F.count(F.lit(1)).alias("n")).scalar()


# --- summaries in the follow-up window -------------------------------------------------------


def medication_exposure(
    medications: DataFrame, windows: DataFrame, sets: dict, limit: int | None = None
) -> DataFrame:
    """Per medication class: exposed patients, medication rows, and share of the cohort. Hand in
    written windows; they are read more than once."""
    classed = coded_events(medications, sets)
    per_patient = followup_totals(classed, "medication_start_date", windows, "concept_set", limit=limit)
    return (
        per_patient.groupBy("concept_set")
        .agg(
            F.count(F.lit(1)).alias("exposed_patients"), F.sum("events").alias("medication_rows")
        )
        .withColumn("cohort_patients", _cohort_size(windows))
        .withColumn(
            "exposed_percent", F.col("exposed_patients") / F.col("cohort_patients") * 100
        )
    )


def utilization(
    encounters: DataFrame, windows: DataFrame, limit: int | None = None
) -> DataFrame:
    """Per encounter class: encounters and patients in the window, encounters per patient-year.
    Hand in written windows; they are read more than once."""
    per_patient = followup_totals(
        encounters, "encounter_start_date", windows, "encounter_class", limit=limit
    )
    days = windows.agg(F.sum("follow_up_days").alias("d")).scalar()
    return (
        per_patient.groupBy("encounter_class")
        .agg(F.sum("events").alias("encounters"), F.count(F.lit(1)).alias("patients"))
        .withColumn("follow_up_days", days)
        .withColumn(
            "per_patient_year",
            F.when(
                F.col("follow_up_days") > 0,
                F.col("encounters") / (F.col("follow_up_days") / F.lit(365.25)),
            ),
        )
    )


def patient_costs(
    costs: dict[str, tuple[DataFrame, str, str]], windows: DataFrame, limit: int | None = None
) -> DataFrame:
    """Cost per cohort patient and kind (0 without events). `costs` maps a kind to its table, date
    column and cost column. Amounts are added as doubles of any size. Hand in written windows; they
    are read more than once."""
    events = reduce(
        DataFrame.unionByName,
        [
            frame.select(
                "patient_id",
                F.col(date_column).alias("day"),
                F.lit(kind).alias("kind"),
                F.col(cost_column).cast("double").alias("amount"),
            )
            for kind, (frame, date_column, cost_column) in costs.items()
        ],
    )
    totals = (
        followup_totals(events, "day", windows, "kind", limit=limit, cost=F.col("amount"))
        .groupBy("patient_id")
        .agg(*[F.sum(F.when(F.col("kind") == k, F.col("cost"))).alias(k) for k in costs])
    )
    kinds = F.array(
        *[
            F.struct(F.lit(k).alias("kind"), F.coalesce(k, F.lit(0.0)).alias("cost"))
            for k in costs
        ]
    )
    return (
        windows.select("patient_id")
        .join(totals, "patient_id", "left")
        .select("patient_id", F.inline(kinds))
    )


def cost_summary(per_patient: DataFrame) -> DataFrame:
    """Per cost kind: patients, total, mean, SD, quartiles and range of the patient costs. Reads
    its input more than once, so hand it a written table."""
    cost = F.col("cost")
    n = F.count(F.lit(1))
    spread = per_patient.groupBy("kind").agg(
        n.alias("patients"),
        F.sum(cost).alias("total"),
        F.avg(cost).alias("mean"),
        F.when(n > 1, F.stddev_samp(cost)).otherwise(F.lit(0.0)).alias("sd"),
        F.min(cost).alias("min"),
        F.max(cost).alias("max"),
    )
    quartiles = exact_quantiles(per_patient.select("kind", "cost"), "kind", "cost", QUARTILES)
    return spread.join(quartiles, "kind")


def lab_rows(
    observations: DataFrame, windows: DataFrame, sets: dict, limit: int | None = None
) -> DataFrame:
    """Numeric results of the concept codes per patient, day and value, with the number of equal
    results and the day relative to the index date. A cohort within `limit` bytes is broadcast; otherwise results
    are merged before the join. Hand in written windows: both join sides are then plain shuffles,
    whose skewed partitions adaptive execution splits."""
    filled = F.col("observation_date").isNotNull() & F.col("value_numeric").isNotNull()
    coded = coded_events(observations.where(filled), sets)
    bounds = windows.select("patient_id", "index_date", "follow_up_end")
    keys = ("concept_set", "patient_id", "observation_date", "value_numeric")
    number = F.count(F.lit(1)).alias("results")
    if fits_broadcast(windows, limit):
        joined = (
            coded.join(F.broadcast(bounds), "patient_id")
            .groupBy(*keys, "index_date", "follow_up_end")
            .agg(number)
        )
    else:
        joined = coded.groupBy(*keys).agg(number).join(bounds, "patient_id")
    return joined.select(
        "concept_set",
        "patient_id",
        "value_numeric",
        "results",
        days_between(F.col("index_date"), F.col("observation_date")).alias("day"),
        (F.col("observation_date") <= F.col("follow_up_end")).alias("before_end"),
    )


def lab_report(rows: DataFrame) -> DataFrame:
    """Per concept set, over results in follow-up: results, patients, mean, range, quartiles; and
    patients with a result on or before the index date (the optional monitoring-context
    criterion). Reads its input more than once, so hand it a written table."""
    value, results = F.col("value_numeric"), F.col("results")
    in_followup = (F.col("day") >= 0) & F.col("before_end")
    per_patient = rows.groupBy("concept_set", "patient_id").agg(
        F.sum(F.when(in_followup, results)).alias("results"),
        F.sum(F.when(in_followup, value * results)).alias("total"),
        F.min(F.when(in_followup, value)).alias("low"),
        F.max(F.when(in_followup, value)).alias("high"),
        F.bool_or(F.col("day") <= 0).alias("context"),
    )
    spread = per_patient.groupBy("concept_set").agg(
        F.coalesce(F.sum("results"), F.lit(0)).alias("results"),
        F.count("results").alias("patients"),
        (F.sum("total") / F.sum("results")).alias("mean"),
        F.min("low").alias("min"),
        F.max("high").alias("max"),
        F.count_if("context").alias("patients_with_context"),
    )
    quartiles = exact_quantiles(
        rows.where(in_followup), "concept_set", "value_numeric", QUARTILES, weight="results"
    )
    return spread.join(quartiles, "concept_set", "left")


def lab_trajectory(rows: DataFrame, days_per_step: int = 90) -> DataFrame:
    """Per concept set and step of days since the index date: results, mean and sample SD. Values
    are centred on the mean of their group before they are squared, so large values that differ
    little keep their spread. Reads its input twice, so hand it a written table."""
    value, results = F.col("value_numeric"), F.col("results")
    keys = ["concept_set", "step"]
    stepped = rows.where((F.col("day") >= 0) & F.col("before_end")).withColumn(
        "step", F.floor(F.col("day") / days_per_step)
    )
    centres = stepped.groupBy(*keys).agg((F.sum(value * results) / F.sum(results)).alias("centre"))
    off = value - F.col("centre")
    sums = (
        stepped.join(centres, keys)
        .groupBy(*keys)
        .agg(
            F.sum("results").alias("n"),
            F.first("centre").alias("centre"),
            F.sum(off * results).alias("s"),
            F.sum(off * off * results).alias("ss"),
        )
    )
    n, s = F.col("n"), F.col("s")
    variance = F.greatest((F.col("ss") - s * s / n) / (n - 1), F.lit(0.0))
    return sums.select(
        *keys,
        n.alias("results"),
        (F.col("centre") + s / n).alias("mean"),
        F.when(n > 1, F.sqrt(variance)).otherwise(F.lit(0.0)).alias("sd"),
    )


def survival_table(windows: DataFrame) -> DataFrame:
    """Kaplan-Meier table of death in follow-up: per day with an ending, patients at risk, deaths,
    censored patients, and survival. Follow-up length bounds the number of days."""
    by_day = windows.groupBy(F.col("follow_up_days").alias("day")).agg(
        F.count(F.lit(1)).alias("endings"),
        F.count_if(F.col("end_reason") == "death").alias("deaths"),
    )
    onward = Window.orderBy(F.desc("day")).rowsBetween(Window.unboundedPreceding, 0)
    so_far = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    at_risk = by_day.withColumn("at_risk", F.sum("endings").over(onward))
    stay = 1 - F.col("deaths") / F.col("at_risk")
    died_out = F.max((F.col("deaths") == F.col("at_risk")).cast("int")).over(so_far) == 1
    log_stay = F.sum(F.when(stay > 0, F.ln(stay)).otherwise(F.lit(0.0))).over(so_far)
    return at_risk.select(
        "day",
        "at_risk",
        "deaths",
        (F.col("endings") - F.col("deaths")).alias("censored"),
        F.when(died_out, F.lit(0.0)).otherwise(F.exp(log_stay)).alias("survival"),
    )


# --- common data model -----------------------------------------------------------------------

# Fixed layout: target table -> (silver table, ((target column, silver column), ...)).
COMMON_MODEL = {
    "person": (
        "patients",
        (
            ("person_source_value", "patient_id"),
            ("year_of_birth", "birth_year"),
            ("birth_date", "birth_date"),
            ("death_date", "death_date"),
            ("gender_source_value", "sex"),
            ("race_source_value", "race"),
            ("ethnicity_source_value", "ethnicity"),
        ),
    ),
    "visit_occurrence": (
        "encounters",
        (
            ("visit_source_value", "encounter_id"),
            ("person_source_value", "patient_id"),
            ("visit_start_date", "encounter_start_date"),
            ("visit_end_date", "encounter_stop_date"),
            ("visit_type", "encounter_class"),
        ),
    ),
    "condition_occurrence": (
        "conditions",
        (
            ("person_source_value", "patient_id"),
            ("visit_source_value", "encounter_id"),
            ("condition_start_date", "condition_start_date"),
            ("condition_end_date", "condition_stop_date"),
            ("condition_source_value", "code"),
        ),
    ),
    "drug_exposure": (
        "medications",
        (
            ("person_source_value", "patient_id"),
            ("visit_source_value", "encounter_id"),
            ("drug_exposure_start_date", "medication_start_date"),
            ("drug_exposure_end_date", "medication_stop_date"),
            ("drug_source_value", "code"),
            ("quantity", "dispenses"),
        ),
    ),
    "measurement": (
        "observations",
        (
            ("person_source_value", "patient_id"),
            ("visit_source_value", "encounter_id"),
            ("measurement_date", "observation_date"),
            ("measurement_source_value", "code"),
            ("value_as_number", "value_numeric"),
            ("unit_source_value", "units"),
        ),
    ),
    "procedure_occurrence": (
        "procedures",
        (
            ("person_source_value", "patient_id"),
            ("visit_source_value", "encounter_id"),
            ("procedure_date", "procedure_start_date"),
            ("procedure_source_value", "code"),
        ),
    ),
}


def common_model_table(target: str, source: DataFrame) -> DataFrame:
    _, columns = COMMON_MODEL[target]
    return source.select(*[F.col(c).alias(name) for name, c in columns])


def common_model(layer: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Person, visit, condition, drug, measurement and procedure tables: narrow projections."""
    return {
        target: common_model_table(target, layer[source])
        for target, (source, _) in COMMON_MODEL.items()
    }


def model_profile(tables: dict[str, DataFrame], date_columns: dict[str, str]) -> DataFrame:
    """Per common-model table: rows, distinct persons, first and last date."""
    parts = []
    for name, frame in tables.items():
        day = F.col(date_columns[name])
        parts.append(
            frame.groupBy("person_source_value")
            .agg(F.count(F.lit(1)).alias("c"), F.min(day).alias("first"), F.max(day).alias("last"))
            .agg(
                F.lit(name).alias("table_name"),
                F.sum("c").alias("row_count"),
                F.count("person_source_value").alias("person_count"),
                F.min("first").alias("first_date"),
                F.max("last").alias("last_date"),
            )
        )
    return reduce(DataFrame.unionByName, parts)
