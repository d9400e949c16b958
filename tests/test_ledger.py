import json

import pytest
from test_study import RAW

from wardline.plans import ledger as ledgers
from wardline.plans import study
from wardline.sources import files, layers
from wardline.spec import Rule, Scenario, StudySpec

OUTPUTS = ("index_cohort", "attrition", "final_cohort", "baseline", "followup_window", "survival_table", "baseline_window",
           "ruled_cohort", "model_person", "bronze_verdict", "silver_verdict", "silver_tables", "date_parse_check")
SPEC = StudySpec(rules=(Rule("near", ("46635009", "1")),))
STAGES = ["bronze_checks", "bronze_dates", "silver_checks", "silver_future_dates", "index_cohort", "attrition",
          "final_cohort", "baseline", "followup", "windows", "rules", "common_model"]


def scenario(root):
    raw = root / "raw"
    raw.mkdir(parents=True, exist_ok=True)
    for table, (header, rows) in RAW.items():
        (raw / f"{table}.csv").write_text("\n".join([header, *rows]) + "\n")
    return Scenario(
        "trial", "Trial run", str(raw), *(str(root / d) for d in ("bronze", "silver", "gold")),
        report_dir=str(root / "reports"), reference_date="2026-01-01",
    )


def content(out):
    return {name: sorted(map(repr, out[name].collect())) for name in OUTPUTS}


def status(out):
    return {r.stage: r.status for r in out["stages"].collect()}


def test_changed_files_rerun_what_depends_on_them_and_cut_runs_go_on(spark, tmp_path, monkeypatch):
    place = scenario(tmp_path / "one")
    first = study.run_study(spark, place, SPEC, reuse=True)
    assert set(status(first).values()) == {"ran"}
    want = content(first)

    second = study.run_study(spark, place, SPEC, reuse=True)
    assert set(status(second).values()) == {"reused"} and content(second) == want

    # Other raw rows of one table: only what reads it runs again.
    with open(f"{place.raw_dir}/medications.csv", "a") as file:
        file.write("2021-01-01,p2,1,m\n")
    third = status(study.run_study(spark, place, SPEC, reuse=True))
    ran = {s for s, how in third.items() if how == "ran"}
    assert ran == {"bronze_medications", "silver_medications", "bronze_checks", "bronze_dates", "silver_checks",
                   "silver_future_dates", "followup", "windows", "common_model"}

    # Other parameters: the raw layers stand. A table someone else wrote over does not.
    layers.write_table(spark.range(1), place.silver_dir, "careplans")
    fourth = status(study.run_study(spark, place, StudySpec(minimum_age_years=40, rules=SPEC.rules), reuse=True))
    assert {s for s, how in fourth.items() if how == "ran"} == {
        "silver_careplans", "index_cohort", "attrition", "final_cohort", "baseline", "followup", "windows", "rules"}

    # A run that dies after each stage in turn, and goes on each time.
    other = scenario(tmp_path / "two")
    keep = ledgers.Ledger.keep
    done = []

    def dying(self, name, *rest):
        keep(self, name, *rest)
        if name in STAGES and name not in done:
            done.append(name)
            raise KeyboardInterrupt(name)

    with monkeypatch.context() as patch:
        patch.setattr(ledgers.Ledger, "keep", dying)
        patch.setattr(layers, "write_manifest", lambda *a: None)  # the runs before the last: only their stages
        for stage in STAGES:
            with pytest.raises(KeyboardInterrupt, match=stage):
                study.run_study(spark, other, SPEC, reuse=True)
    last = study.run_study(spark, other, SPEC, reuse=True)
    assert done == STAGES and set(status(last).values()) == {"reused"}
    assert content(last) == want
    line = next((tmp_path / "two" / "reports" / "manifests" / "stages").glob("part-*.json")).read_text().splitlines()[0]
    assert json.loads(line)["status"] == "reused"


def test_records(spark, tmp_path):
    ledger = ledgers.Ledger(spark, str(tmp_path), reuse=True)
    built = []

    def build():
        built.append(1)
        return {"rows": spark.range(3)}

    for parameters, runs in ((1, 1), (1, 1), (2, 2)):
        assert ledger.stage("a", {"raw": "x"}, parameters, build)["rows"].count() == 3
        assert len(built) == runs
    assert ledger.stage("b", ["a"], None, build)["rows"].count() == 3 and len(built) == 3
    ledger.stage("a", {"raw": "y"}, 2, build)
    ledger.stage("b", ["a"], None, build)
    assert len(built) == 5  # a changed input reaches the stage after it
    again = ledgers.Ledger(spark, str(tmp_path), reuse=False)
    again.stage("a", {"raw": "y"}, 2, build)
    assert len(built) == 6
    with pytest.raises(ZeroDivisionError):  # a stage that fails leaves no record
        again.stage("c", ["a"], None, lambda: 1 / 0)
    assert not files.path_exists(f"{tmp_path}/c/record.json")
    other = ledgers.Ledger(spark, str(tmp_path), reuse=True)
    other.code = "another version of the code"
    other.stage("a", {"raw": "y"}, 2, build)
    assert len(built) == 7


def test_checks_measured_while_writing_equal_scanned_ones(spark, tmp_path):
    from wardline.operators import quality

    place = scenario(tmp_path)
    out = study.run_study(spark, place)
    silver = layers.read_present(spark, place.silver_dir, list(RAW))
    scanned = quality.silver_quality(spark, silver, list(RAW))
    for name in ("tables", "verdict"):
        assert sorted(map(repr, out[f"silver_{name}"].collect())) == sorted(map(repr, scanned[name].collect()))
    bronze = layers.read_present(spark, place.bronze_dir, list(RAW))
    assert sorted(map(repr, out["bronze_tables"].collect())) == sorted(
        map(repr, quality.bronze_quality(spark, bronze, list(RAW))["tables"].collect())
    )
    measured = study.measured_tables(out["silver_normalization"])
    assert measured["conditions"]["row_count"] == 4 and measured["patients"]["nulls_death_date"] == 3
    # No scan of a table whose measures are known.
    checks = quality.table_checks(spark, silver, list(RAW), (), quality.SILVER, measured)
    assert "FileScan" not in checks._jdf.queryExecution().executedPlan().toString()
