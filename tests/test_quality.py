from datetime import date

import pytest
from pyspark.sql import functions as F

from wardline.operators import quality
from wardline.operators.quality import BRONZE, SILVER
from wardline.spec import BRONZE_CONTRACT, CORE_TABLES, TARGET_CODE


def raw(spark, **columns):
    return spark.createDataFrame(
        [tuple(columns.values())], ", ".join(f"`{c}` string" for c in columns)
    )


def valid_bronze(spark):
    layer = {}
    for table, columns in BRONZE_CONTRACT.items():
        values = {c: "2020-01-01" for c in columns}
        if "PATIENT" in values:
            values["PATIENT"] = "p1"
        if "CODE" in values:
            values["CODE"] = TARGET_CODE
        if table == "patients":
            values["Id"] = "p1"
        layer[table] = raw(spark, **values)
    return layer


def first(frame):
    return frame.first().asDict()


def test_valid_bronze_passes(spark):
    found = quality.bronze_quality(spark, valid_bronze(spark), CORE_TABLES)
    verdict = first(found["verdict"])
    assert verdict["structural_checks_passed"] is True
    assert verdict["required_table_count"] == 7
    assert {r.status for r in found["tables"].collect()} == {"present"}
    assert {r.status for r in found["references"].collect()} == {"passed"}
    signal = first(found["signal"])
    assert (signal["condition_row_count"], signal["patient_count"]) == (1, 1)
    assert signal["status"] == "present"


def test_unknown_reference_fails(spark):
    layer = valid_bronze(spark)
    layer["conditions"] = raw(
        spark, START="2020-01-01", PATIENT="p999", CODE=TARGET_CODE, DESCRIPTION="x"
    ).union(
        raw(spark, START="2020-01-01", PATIENT="p999", CODE=TARGET_CODE, DESCRIPTION="x")
    ).union(
        raw(spark, START="2020-01-01", PATIENT=None, CODE=TARGET_CODE, DESCRIPTION="x")
    )
    found = quality.bronze_quality(spark, layer, CORE_TABLES)
    checks = {r.table_name: r for r in found["references"].collect()}
    assert checks["conditions"].status == "failed"
    assert checks["conditions"].unknown_patient_reference_count == 1
    assert checks["conditions"].unique_patient_reference_count == 1
    verdict = first(found["verdict"])
    assert verdict["failed_patient_reference_tables"] == ["conditions"]
    assert verdict["structural_checks_passed"] is False
    # Null patients count as one patient in the signal.
    assert first(found["signal"])["patient_count"] == 2


def test_absent_code_is_labelled_and_does_not_fail(spark):
    layer = valid_bronze(spark)
    layer["conditions"] = layer["conditions"].withColumn("CODE", F.lit("123"))
    found = quality.bronze_quality(spark, layer, CORE_TABLES)
    assert first(found["signal"])["status"] == "absent_in_smoke_data"
    assert first(found["verdict"])["structural_checks_passed"] is True


def test_status_precedence(spark):
    layer = valid_bronze(spark)
    layer["procedures"] = layer["procedures"].where("false")
    layer["careplans"] = layer["careplans"].where("false").drop("CODE")
    layer["observations"] = None
    found = quality.bronze_quality(spark, layer, CORE_TABLES)
    status = {r.table_name: r.status for r in found["tables"].collect()}
    assert status["procedures"] == "empty"
    assert status["careplans"] == "missing_core_columns"
    assert status["observations"] == "missing"
    verdict = first(found["verdict"])
    # An empty table that also lacks a column is not counted as empty.
    assert verdict["empty_required_tables"] == ["procedures"]
    assert verdict["tables_missing_columns"] == ["careplans"]
    assert verdict["missing_required_tables"] == ["observations"]
    checks = {r.table_name: r.status for r in found["references"].collect()}
    assert checks["observations"] == "missing_input"


def test_optional_tables_only_when_present(spark):
    layer = valid_bronze(spark)
    optional = layer.pop("careplans")
    required = [t for t in CORE_TABLES if t != "careplans"]
    found = quality.bronze_quality(spark, layer, required, ["careplans", "allergies"])
    assert found["tables"].count() == 6
    assert found["references"].count() == 5
    layer["careplans"] = optional.drop("CODE")
    found = quality.bronze_quality(spark, layer, required, ["careplans", "allergies"])
    rows = {r.table_name: r for r in found["tables"].collect()}
    assert rows["careplans"].required is False
    verdict = first(found["verdict"])
    assert verdict["optional_table_count_present"] == 1
    assert found["references"].count() == 6
    assert verdict["structural_checks_passed"] is True


def test_missing_patient_key(spark):
    layer = valid_bronze(spark)
    layer["encounters"] = layer["encounters"].drop("PATIENT")
    found = quality.bronze_quality(spark, layer, CORE_TABLES)
    checks = {r.table_name: (r.checked, r.status) for r in found["references"].collect()}
    assert checks["encounters"] == (False, "missing_patient_key_column")
    layer["patients"] = None
    found = quality.bronze_quality(spark, layer, CORE_TABLES)
    assert {r.status for r in found["references"].collect()} == {"missing_input"}


@pytest.mark.parametrize(
    "dropped, status",
    [("CODE", "conditions_missing_code_column"), ("PATIENT", "conditions_missing_patient_column")],
)
def test_bronze_signal_without_columns(spark, dropped, status):
    conditions = valid_bronze(spark)["conditions"].drop(dropped)
    row = first(quality.target_signal(spark, conditions, BRONZE))
    assert (row["checked"], row["status"], row["patient_count"]) == (False, status, None)


def test_signal_without_conditions(spark):
    assert first(quality.target_signal(spark, None, SILVER))["status"] == "conditions_missing"


SILVER_PATIENTS = (
    "patient_id string, birth_date date, death_date date, sex string, race string,"
    " ethnicity string, birth_year int, source_table string"
)
SILVER_CONDITIONS = (
    "patient_id string, encounter_id string, condition_start_date date,"
    " condition_stop_date date, code string, description string, source_table string"
)


def silver(spark, patient="p1", code=TARGET_CODE):
    d = date(2020, 1, 1)
    return {
        "patients": spark.createDataFrame(
            [("p1", date(1970, 1, 1), None, "M", "white", "n", 1970, "patients")], SILVER_PATIENTS
        ),
        "conditions": spark.createDataFrame(
            [(patient, "e1", d, None, code, "text", "conditions")], SILVER_CONDITIONS
        ),
    }


REQUIRED = ["patients", "conditions"]


def test_valid_silver_passes(spark):
    layer = silver(spark)
    # An untyped all-null column is accepted as a date.
    layer["patients"] = layer["patients"].withColumn("death_date", F.lit(None))
    found = quality.silver_quality(spark, layer, REQUIRED)
    assert first(found["verdict"])["structural_checks_passed"] is True
    assert first(found["signal"])["earliest_date"] == date(2020, 1, 1)
    rows = {r.table_name: r for r in found["tables"].collect()}
    dates = {c.column: (c.is_date, c.null_count) for c in rows["patients"].date_column_checks}
    assert dates == {"birth_date": (True, 0), "death_date": (True, 1)}
    assert rows["conditions"].required_date_null_counts[0].null_count == 0
    assert [r.table_name for r in found["references"].collect()] == ["conditions"]


def test_text_date_fails(spark):
    layer = silver(spark)
    layer["patients"] = layer["patients"].withColumn("birth_date", F.lit("1970-01-01"))
    layer["patients"] = layer["patients"].drop("sex")
    found = quality.silver_quality(spark, layer, REQUIRED)
    rows = {r.table_name: r for r in found["tables"].collect()}
    assert rows["patients"].status == "invalid_date_dtypes"
    assert rows["patients"].invalid_date_columns == ["birth_date"]
    verdict = first(found["verdict"])
    assert verdict["tables_with_invalid_date_dtypes"] == ["patients"]
    assert verdict["tables_missing_columns"] == ["patients"]
    assert verdict["structural_checks_passed"] is False


def test_silver_orphan_and_absent_code(spark):
    found = quality.silver_quality(spark, silver(spark, patient="p999"), REQUIRED)
    assert first(found["verdict"])["failed_patient_reference_table_count"] == 1
    row = first(quality.target_signal(spark, silver(spark, code="1")["conditions"], SILVER))
    assert (row["status"], row["condition_row_count"], row["patient_count"]) == ("absent", 0, 0)
    assert row["earliest_date"] is None


def test_silver_signal_without_columns(spark):
    conditions = silver(spark)["conditions"].drop("condition_start_date")
    row = first(quality.target_signal(spark, conditions, SILVER))
    assert row["status"] == "conditions_missing_columns: ['condition_start_date']"


def test_undated_rows_count_in_the_signal(spark):
    layer = silver(spark)
    undated = layer["conditions"].withColumn("condition_start_date", F.lit(None).cast("date"))
    row = first(quality.target_signal(spark, undated, SILVER))
    assert (row["status"], row["condition_row_count"], row["earliest_date"]) == ("present", 1, None)


def test_no_references_to_check(spark):
    found = quality.silver_quality(spark, silver(spark), ["patients"])
    assert found["references"].count() == 0
    assert first(found["verdict"])["structural_checks_passed"] is True
