"""What the plans must and must not contain."""

import os
import re

import pytest

from wardline.operators import cohort as cohorts
from wardline.operators import followup, funnel
from wardline.plans import registry
from wardline.sources import layers
from wardline.spec import StudySpec

SF_DIR = "/root/testdata/sf0.001"


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def silver(spark, tmp_path_factory):
    from test_brute_force import random_tables

    from conftest import CONDITIONS, ENCOUNTERS, PATIENTS

    folder = str(tmp_path_factory.mktemp("silver"))
    names = ("patients", "conditions", "encounters")
    for name, rows, schema in zip(names, random_tables(1), (PATIENTS, CONDITIONS, ENCOUNTERS)):
        layers.write_table(spark.createDataFrame(rows, schema), folder, name)
    return [layers.read_table(spark, folder, name) for name in names]


def test_index_cohort_scans_each_table_once(silver):
    text = plan(cohorts.index_cohort(*silver, StudySpec()))
    assert text.count("FileScan") == 3
    scan = next(line for line in text.splitlines() if "FileScan" in line and "code" in line)
    assert "In(code" in scan
    encounters = next(
        line for line in text.splitlines() if "FileScan" in line and "encounter_start" in line
    )
    schema = re.search(r"ReadSchema: struct<(.*?)>", encounters).group(1)
    assert schema == "patient_id:string,encounter_start_date:date"
    assert "Python" not in text


def test_events_merge_before_every_exchange(silver):
    """Each exchange of event rows sits on a partial aggregate."""
    lines = plan(cohorts.index_cohort(*silver, StudySpec())).splitlines()
    for i, line in enumerate(lines):
        if "Exchange hashpartitioning(patient_id" in line and "condition_start_date" in line:
            assert "partial_count" in lines[i + 1]


def test_funnel_is_one_shuffle_over_cohort_and_patients(silver, spark):
    patients = silver[0]
    cohort = layers.materialize(cohorts.index_cohort(*silver, StudySpec()), "cohort")
    text = plan(funnel.attrition(patients, cohort, StudySpec()))
    assert text.count("Exchange hashpartitioning") == 1
    assert "Join" not in text


def test_index_cohort_exchanges(silver):
    """Days, which then stay by patient; patient rows by row (copies merge before they move) and
    by id; encounters."""
    text = plan(cohorts.index_cohort(*silver, StudySpec()))
    assert text.count("FileScan") == 3
    assert text.count("Exchange hashpartitioning") <= 5


def test_index_summary_reads_the_conditions_once(silver):
    patients, conditions, encounters = silver
    cohort = layers.materialize(cohorts.index_cohort(*silver, StudySpec()), "cohort")
    frame = funnel.index_summary(patients, conditions, encounters, cohort, StudySpec())
    assert len(frame.collect()) == 1
    final = plan(frame).split("== Initial Plan ==")[0]
    assert final.count("ReusedSubquery") >= 2  # one pass answers all three numbers


def test_baseline_window_reads_the_cohort_and_encounters_only(silver, spark):
    cohort = layers.materialize(
        cohorts.final_cohort(cohorts.index_cohort(*silver, StudySpec())), "final"
    )
    (seen,) = cohorts.of_patients(cohort, silver[2])
    text = plan(followup.baseline_window(cohort, seen, StudySpec()))
    assert text.count("FileScan") <= 4 and "code" not in text


def test_concept_codes_reach_the_scan(spark, tmp_path):
    rows = spark.createDataFrame(
        [("a", "1", None)], "patient_id string, code string, medication_start_date date"
    )
    layers.write_table(rows, str(tmp_path), "medications")
    written = layers.read_table(spark, str(tmp_path), "medications")
    sets = {"x": ("v", "u", (("1", "one"), ("2", "two")))}
    assert "In(code" in plan(followup.concept_signal(written, "medication_start_date", sets))


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="check tables not present")
@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_no_cross_joins_and_no_row_at_a_time_python(spark, name):
    text = plan(registry.queries()[name](spark, SF_DIR))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    assert "BatchEvalPython" not in text


@pytest.mark.parametrize("module, name", [("sources.files", "_hash_batches"),
                                          ("sources.csv_ranges", "_profile"),
                                          ("functions.text", "_one_decimal_text"),
                                          ("functions.text", "_one_decimal")])
def test_python_functions_need_no_package_on_executors(tmp_path, module, name):
    import importlib
    import subprocess
    import sys

    from pyspark import cloudpickle

    function = getattr(importlib.import_module(f"wardline.{module}"), name)
    body = cloudpickle.dumps(getattr(function, "func", function))
    code = "import pickle, sys; pickle.loads(sys.stdin.buffer.read())"
    environment = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", code], input=body, cwd=tmp_path, env=environment,
        capture_output=True, check=False,
    )
    assert done.returncode == 0, done.stderr.decode()
