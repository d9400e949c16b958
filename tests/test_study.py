import csv
import os

import pytest

from wardline.plans import study
from wardline.sources import layers
from wardline.spec import CONCEPT_SETS, Scenario, StudySpec, concept_version

RAW = {
    "patients": (
        "Id,BIRTHDATE,DEATHDATE,GENDER,RACE,ETHNICITY",
        ["p1,1970-01-01,,M,white,nonhispanic", "p2,1980-02-02,,F,black,hispanic",
         "p3,2012-01-01,,F,white,hispanic"],
    ),
    "encounters": (
        "Id,START,STOP,PATIENT,CODE,DESCRIPTION",
        [f"e{i},201{i}-01-01T08:00:00Z,,p{1 + i % 3},1,visit" for i in range(6)],
    ),
    "conditions": (
        "START,STOP,PATIENT,ENCOUNTER,CODE,DESCRIPTION",
        ["2020-01-01,,p1,e1,44054006,Diabetes mellitus type 2",
         "2020-06-01,,p2,e2,44054006,\"Diabetes, type 2\"",
         "2019-06-01,,p2,e2,46635009,Diabetes mellitus type 1",
         "2020-06-01,,p3,e3,44054006,Diabetes mellitus type 2"],
    ),
    "medications": ("START,PATIENT,CODE,DESCRIPTION", ["2020-01-01,p1,1,m"]),
    "observations": ("DATE,PATIENT,CODE,DESCRIPTION,VALUE", ["2020-01-01,p1,1,o,7.5"]),
    "procedures": ("START,PATIENT,CODE,DESCRIPTION", ["2020-01-01,p1,1,p"]),
    "careplans": ("Id,START,PATIENT,CODE,DESCRIPTION", ["c1,2020-01-01,p1,1,c"]),
}


def test_end_to_end(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    for table, (header, rows) in RAW.items():
        (raw / f"{table}.csv").write_text("\n".join([header, *rows]) + "\n")
    scenario = Scenario(
        "trial", "Trial run", str(raw), *(str(tmp_path / d) for d in ("bronze", "silver", "gold")),
        report_dir=str(tmp_path / "reports"), generator={"seed": "1"}, reference_date="2026-01-01",
    )
    scratch = spark.conf.get("spark.checkpoint.dir").removeprefix("file://")
    there = set(os.listdir(scratch)) if os.path.isdir(scratch) else set()
    out = study.run_study(spark, scenario)
    assert set(os.listdir(scratch)) <= there  # no folder of the run's own is left
    assert out["bronze_verdict"].first().structural_checks_passed
    assert out["silver_verdict"].first().structural_checks_passed
    assert {r.status for r in out["silver_normalization"].collect()} == {"normalized"}

    steps = out["attrition"].orderBy("step_number").collect()
    assert [s.remaining_n for s in steps] == [3, 3, 2, 2, 1, 1, 1]
    assert [r.patient_id for r in out["final_cohort"].collect()] == ["p1"]
    assert out["index_cohort"].count() == 3
    assert out["baseline"].columns[0] == "section" and len(out["baseline"].columns) == 9
    assert out["baseline"].count() == 10

    tables = tmp_path / "reports" / "tables"
    part = next((tables / "trial_t2dm_attrition.csv").glob("part-*.csv"))
    lines = list(csv.reader(part.open()))
    assert lines[0][:3] == ["step_number", "step_id", "criterion"]
    assert [line[0] for line in lines[1:]] == [str(i) for i in range(1, 8)]
    assert out["followup_window"].count() == 1 and out["baseline_window"].count() == 1
    assert out["model_condition_occurrence"].count() == 4 and out["survival_table"].count() == 1
    assert out["date_parse_check"].where("NOT passed").count() == 0
    assert out["future_date_check"].where("NOT passed").count() == 0
    assert next((tables / "trial_survival_table.csv").glob("part-*.csv")).exists()
    sets = tmp_path / "reports" / "manifests" / "concept_sets"
    line = next(sets.glob("part-*.json")).read_text().splitlines()[0]
    assert concept_version(CONCEPT_SETS) in line
    manifests = {p.name for p in (tmp_path / "reports" / "manifests").iterdir()}
    assert {"raw_inventory", "bronze_conversion", "bronze_qa_verdict", "silver_normalization",
            "silver_qa_verdict", "t2dm_index_cohort", "t2dm_attrition_table",
            "t2dm_final_cohort", "baseline_characteristics"} <= manifests

    lab_sets = {"lab": ("v", "u", (("1", "o"),))}
    classes = {"class": ("v", "u", (("1", "m"),))}
    more = study.build_followup(
        spark, scenario.silver_dir, scenario.gold_dir, StudySpec(), classes, lab_sets
    )
    window = more["followup_window"].first()
    assert (window.patient_id, window.end_reason) == ("p1", "end_of_record")
    assert more["medication_exposure"].first().exposed_patients == 1
    assert more["lab_summary"].first().results == 1
    assert {r.kind: r.total for r in more["cost_summary"].collect()} == {
        "encounters": 0.0, "medications": 0.0, "procedures": 0.0
    }
    assert more["survival_table"].first().survival == 1.0
    model = study.build_common_model(spark, scenario.silver_dir, str(tmp_path / "model"))
    assert model["person"].count() == 3 and model["condition_occurrence"].count() == 4

    # A second run overwrites the first.
    again = study.run_study(spark, scenario)
    assert again["index_cohort"].count() == 3


def test_stages_name_the_stage_to_run_first(spark, tmp_path):
    silver, gold = str(tmp_path / "silver"), str(tmp_path / "gold")
    with pytest.raises(FileNotFoundError, match="bronze_to_silver"):
        study.build_index_cohort(spark, silver, gold, StudySpec())
    with pytest.raises(FileNotFoundError, match="build_index_cohort"):
        study.build_final_cohort(spark, gold)
    with pytest.raises(FileNotFoundError, match="build_final_cohort"):
        study.build_baseline(spark, gold)
    layers.write_table(spark.createDataFrame([("p",)], "patient_id string"), silver, "patients")
    with pytest.raises(FileNotFoundError, match="build_index_cohort"):
        study.build_attrition(spark, silver, gold, StudySpec())


def test_rules_with_several_codes():
    spec = StudySpec.from_concepts()
    assert (spec.target_code, spec.window_exclusion_code) == ("44054006", "77386006")
    sets = {**CONCEPT_SETS, "pregnancy": ("v", "u", (("1", "a"), ("2", "b")))}
    assert StudySpec.from_concepts(sets).window_exclusion_code == ("1", "2")
    assert StudySpec(target_code=("7", 8, "7")).target_code == ("7", "8")
    assert StudySpec(target_code=["7"]).target_code == "7"
    assert concept_version(sets) != concept_version(CONCEPT_SETS)
    with pytest.raises(ValueError):
        StudySpec.from_concepts(sets, target="a1c")


def test_any_code_of_a_rule_counts(clinic):
    from wardline.operators.cohort import index_cohort

    rows = index_cohort(
        clinic.patients(("p1", "1970-01-01"), ("p2", "1970-01-01")),
        clinic.conditions(("p1", "e", "2020-01-01", "7"), ("p1", "e", "2019-01-01", "8"), ("p2", "e", "2020-01-01", "9")),
        clinic.encounters(("p1", "2010-01-01")),
        StudySpec(target_code=("7", "8")),
    ).collect()
    assert [(r.patient_id, str(r.index_date), r.target_t2dm_code) for r in rows] == [("p1", "2019-01-01", "7|8")]
    assert rows[0].index_condition_code == "8"  # the row's own code


def test_a_code_may_hold_a_bar(clinic):
    from wardline.operators.cohort import first_event_per_patient, index_cohort

    events = clinic.conditions(("p1", "e", "2020-01-01", "7|8"), ("p1", "e", "2019-01-01", "7"))
    people = clinic.patients(("p1", "1970-01-01"))
    row = index_cohort(people, events, clinic.encounters(), StudySpec(target_code="7|8")).first()
    assert (str(row.index_date), row.index_condition_code) == ("2020-01-01", "7|8")
    found = first_event_per_patient(events, ("7|8", "7")).first()
    assert (str(found.index_date), found.index_condition_code) == ("2019-01-01", "7")
