"""One patient owning a third of all rows: right results, and small per-patient stages."""

import pytest
from pyspark.sql import functions as F

from wardline.operators import cohort as cohorts
from wardline.operators import funnel, quality
from wardline.operators.quality import SILVER
from wardline.sources import layers
from wardline.spec import PRIOR_EXCLUSION_CODE, TARGET_CODE, WINDOW_EXCLUSION_CODE, StudySpec

N = 60_000


def hot(column="id"):
    """Every third row belongs to patient `hot`."""
    return F.when(F.col(column) % 3 == 0, "hot").otherwise(
        F.concat(F.lit("p"), (F.col(column) % 500).cast("string"))
    )


def events(spark):
    code = (
        F.when(F.col("id") % 5 < 2, TARGET_CODE)
        .when(F.col("id") % 5 == 2, PRIOR_EXCLUSION_CODE)
        .when(F.col("id") % 5 == 3, WINDOW_EXCLUSION_CODE)
        .otherwise("x")
    )
    return spark.range(N).select(
        hot().alias("patient_id"),
        F.concat(F.lit("e"), F.col("id").cast("string")).alias("encounter_id"),
        F.date_add(F.lit("2015-01-01").cast("date"), (F.col("id") * 31 % 1500).cast("int")).alias(
            "condition_start_date"
        ),
        code.alias("code"),
        F.lit("t").alias("description"),
    )


def patients(spark):
    return spark.range(N).select(
        hot().alias("patient_id"),
        F.lit("1970-01-01").cast("date").alias("birth_date"),
        F.lit(None).cast("date").alias("death_date"),
        F.lit("F").alias("sex"),
        F.lit("r").alias("race"),
        F.lit("e").alias("ethnicity"),
    )


def encounters(spark):
    return events(spark).select(
        "patient_id", F.date_sub("condition_start_date", 700).alias("encounter_start_date")
    )


def test_hot_patient(spark, monkeypatch):
    monkeypatch.setattr(cohorts, "COPY_BLOCK", 1024)
    conditions = events(spark)
    spec = StudySpec()
    cohort = cohorts.index_cohort(patients(spark), conditions, encounters(spark), spec)
    hot_rows = cohort.where("patient_id = 'hot'")
    assert hot_rows.count() == N // 3
    row = hot_rows.distinct().collect()
    assert len(row) == 1
    mine = conditions.where("patient_id = 'hot'")
    first = mine.where(F.col("code") == TARGET_CODE).agg(F.min("condition_start_date")).first()[0]
    assert row[0].index_date == first
    before = mine.where(
        (F.col("code") == PRIOR_EXCLUSION_CODE) & (F.col("condition_start_date") < F.lit(first))
    ).count()
    assert row[0].prior_t1dm_row_count == before
    total = mine.where(F.col("code") == TARGET_CODE).count()
    assert row[0].t2dm_condition_row_count == total
    steps = funnel.attrition(patients(spark), cohort, spec).orderBy("step_number").collect()
    assert steps[0].remaining_n == patients(spark).select("patient_id").distinct().count()


@pytest.mark.parametrize("limit", [10, 1 << 27])
def test_staged_index_cohort_is_the_same(spark, monkeypatch, limit):
    """Written index events, broadcast or not, against the single plan."""
    monkeypatch.setattr(cohorts, "BROADCAST_BYTES", limit)
    people = patients(spark).where("patient_id <> 'p7'").limit(2000)
    tables = (people, events(spark), encounters(spark))
    plain = cohorts.index_cohort(*tables, StudySpec())
    staged = cohorts.index_cohort(
        *tables, StudySpec(), stage=lambda frame: layers.materialize(frame, "index_events")
    )
    assert staged.exceptAll(plain).count() == 0
    assert plain.exceptAll(staged).count() == 0


def test_days_not_rows_reach_the_patient_stage(spark):
    """What is exchanged by patient alone is at most one row per patient and day."""
    days = cohorts.rows_per_day(events(spark), "condition_start_date")
    assert days.where("patient_id = 'hot'").count() <= 1500
    assert days.agg(F.sum("row_count")).first()[0] == N


def test_reference_check_moves_merged_ids(spark):
    layer = {"patients": patients(spark).where("patient_id <> 'hot'"), "conditions": events(spark)}
    row = quality.reference_checks(spark, layer, ["conditions"], SILVER).first()
    assert row.unknown_patient_reference_count == 1 and row.status == "failed"
    plan = quality.reference_checks(spark, layer, ["conditions"], SILVER)._jdf.queryExecution()
    text = plan.executedPlan().toString()
    assert "Join" not in text and "partial_bit_or" in text
