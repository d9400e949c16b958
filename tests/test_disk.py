"""What queries leave and hold on disk: packed raw text, shuffles that end with their query, rows moved once."""

import csv
import glob
import gzip
import os
import random

import pytest
from test_intervals import at, brute_eras, rows
from test_plans import plan
from test_small_tasks import order_tables  # noqa: F401

from wardline.operators import intervals, quality
from wardline.plans import bindings, registry, study
from wardline.sources import layers, raw_csv
from wardline.spec import Scenario

CELLS = [("1", 'a "b"', None), ("2", " x, y ", "z"), ("3", "line\nbreak", ""), ("4", None, "é"), ("5", "e", "f")]


def shuffle_files(spark):
    # The driver's own block manager writes below the first folder of its temporary files.
    root = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for d in root for f in glob.glob(f"{d}/**/shuffle_*", recursive=True)}


@pytest.mark.parametrize("spanning", [False, True])
def test_packed_text_is_read_like_plain_text(spark, tmp_path, monkeypatch, spanning):
    monkeypatch.setattr(layers, "FILE_RECORDS", 2)
    wanted = [c for c in CELLS if spanning or "\n" not in (c[1] or "")]
    frame = spark.createDataFrame(wanted, "k string, t string, u string").coalesce(1)
    found = {}
    for packed in (False, True):
        raw, bronze = f"{tmp_path}/raw{packed}", f"{tmp_path}/bronze{packed}"
        layers.write_csv(frame, f"{raw}/t.csv", packed=packed)
        (row,) = raw_csv.raw_inventory(spark, raw, ["t.csv"]).collect()
        assert row.spans_lines == spanning
        (done,) = raw_csv.raw_to_bronze(spark, raw, bronze).collect()
        assert done.status == "converted", done.error
        cells = sorted(map(str, layers.read_table(spark, bronze, "t").collect()))
        found[packed] = (row.header, row.row_count, done.row_count, done.columns, cells)
    assert found[True] == found[False] and found[True][1] == len(wanted)
    parts = glob.glob(f"{tmp_path}/rawTrue/t.csv/part-*")
    assert len(parts) == -(-len(wanted) // 2) and all(p.endswith(".csv.gz") for p in parts)
    for part in parts:
        with gzip.open(part, "rt", newline="") as text:
            assert len(list(csv.reader(text))) <= 3  # the header and two records


@pytest.mark.parametrize("query", ["bronze_csv_roundtrip", "study_outputs"])
def test_raw_text_is_packed_and_joined_lines_go(spark, order_tables, monkeypatch, query):  # noqa: F811
    made = []

    def watched(session, name):
        made.append(scratch_dir(session, name))
        return made[-1]

    scratch_dir = layers.scratch_dir
    monkeypatch.setattr(layers, "scratch_dir", watched)
    monkeypatch.setattr(study, "run_study", lambda *_: (_ for _ in ()).throw(StopAsyncIteration))
    if query == "study_outputs":
        with pytest.raises(StopAsyncIteration):
            registry.study_outputs(spark, order_tables)
    else:
        found = registry.bronze_csv_roundtrip(spark, order_tables).collect()
        whole = bindings.bronze_tables(spark, order_tables)
        assert {(r.table_name, r.row_count) for r in found} == {(t, f.count()) for t, f in whole.items()}
        made.pop()  # the lines of the count above
    (raw,) = [d for d in made if "/raw-" in d]
    (lines,) = [d for d in made if "/lines-" in d]
    parts = glob.glob(f"{raw}/*.csv/part-*")
    assert {p.split("/")[-2] for p in parts} == {f"{t}.csv" for t in bindings.CORE_TABLES}
    assert all(p.endswith(".csv.gz") for p in parts) and not os.path.exists(lines)


def test_shuffle_files_end_with_their_query(spark, tmp_path):
    name, path = layers.SHUFFLE_CLEANUP, f"{tmp_path}/t"
    before = spark.conf.get(name)
    none = shuffle_files(spark)
    kept = spark.range(1000).selectExpr("id % 7 AS k").groupBy("k").count()
    assert len(kept.collect()) == 7 and shuffle_files(spark) - none
    files = shuffle_files(spark)
    with layers.freed_shuffles(spark):
        assert spark.conf.get(name) == "true"
        frame = spark.range(1000).selectExpr("id % 7 AS k").groupBy("k").count()
        frame.write.parquet(path)
        assert len(frame.collect()) == len(frame.collect()) == 7
    with pytest.raises(KeyError), layers.freed_shuffles(spark):
        raise KeyError
    assert spark.conf.get(name) == before
    assert not shuffle_files(spark) - files


def test_a_study_frees_its_shuffles(spark, tmp_path, monkeypatch):
    seen = []
    monkeypatch.setattr(study, "_all_stages", lambda *_: seen.append(spark.conf.get(layers.SHUFFLE_CLEANUP)) or {})
    scenario = Scenario("t", "T", *(f"{tmp_path}/{d}" for d in ("raw", "bronze", "silver", "gold", "reports")))
    assert study.run_study(spark, scenario) == {} and seen == ["true"]


@pytest.fixture
def watched_eras(monkeypatch):
    made = {}

    def watched(frame, name):
        made[name] = (plan(frame), frame.collect())
        return layers.materialize(frame, name)

    monkeypatch.setattr(intervals, "materialize", watched)
    return made


def test_intervals_of_rare_keys_move_once(spark, tmp_path, watched_eras, monkeypatch):
    monkeypatch.setattr(intervals, "FREQUENT", 10)
    rng = random.Random(5)
    spans = []
    for _ in range(900):
        a = rng.randrange(0, 400)
        patient = "hot" if rng.random() < 0.4 else f"p{rng.randrange(40)}"
        spans.append(((patient, rng.choice(["x", None])), at(a), at(rng.choice([None, a - 3, a, a + 1, a + 40]))))
    spans += [((None, None), None, at(5)), ((None, None), at(3), None)]
    frame = spark.createDataFrame([(*k, a, b) for k, a, b in spans], "patient_id string, code string, s date, e date")
    frame.repartition(3).write.parquet(f"{tmp_path}/spans")
    given = spark.read.parquet(f"{tmp_path}/spans")
    for grace in (0, 3):
        found = intervals.eras(given, ["patient_id", "code"], "s", "e", grace)
        assert rows(found) == brute_eras(spans, grace)
    days, pieces = watched_eras["era-days"], watched_eras["era-pieces"]
    assert {(r.patient_id, r.code) for r in days[1]} == {("hot", "x"), ("hot", None)}
    hot = [(k, a) for k, a, _ in spans if k[0] == "hot" and a is not None]
    assert len(days[1]) == len(set(hot)) < len(hot)  # merged per day before they meet the others
    assert pieces[0].count("Exchange") == 1


def test_written_days_of_eras_go(spark, tmp_path, monkeypatch):
    made = []
    scratch_dir = layers.scratch_dir
    monkeypatch.setattr(layers, "scratch_dir", lambda s, n: made.append(scratch_dir(s, n)) or made[-1])
    frame = spark.createDataFrame([("p", at(0), at(1)), ("p", at(9), None)], "p string, s date, e date")
    assert rows(intervals.eras(frame, ["p"], "s", "e", 1)) == [("p", at(0), at(1), 1, 0), ("p", at(9), at(9), 1, 0)]
    days, pieces = made
    assert "era-days" in days and not os.path.exists(days) and os.path.exists(pieces)


def test_references_are_checked_once_for_report_and_verdict(spark, clinic):
    patients = clinic.patients(("1", "1950-01-01"))
    conditions = clinic.conditions(("2", "e", "2020-01-01", "x"))
    layer = {"patients": patients, "conditions": conditions, "encounters": None}
    for check, rules in ((quality.bronze_quality, quality.BRONZE), (quality.silver_quality, quality.SILVER)):
        found = check(spark, layer, ["patients", "conditions", "encounters"])
        for name in ("references", "verdict"):
            assert "bit_or" not in plan(found[name])
        want = quality.reference_checks(spark, layer, ["encounters", "conditions"], rules)
        assert sorted(map(str, found["references"].collect())) == sorted(map(str, want.collect()))


def test_scans_are_dealt_into_small_tasks(spark, tmp_path, monkeypatch):
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    monkeypatch.setattr(layers, "TASK_BYTES", 10_000)
    with layers.small_tasks(spark.range(1)):
        assert spark.conf.get(name) == "10000"
    assert spark.conf.get(name) == before


def test_typed_tables_are_sorted_in_small_tasks(spark, tmp_path, monkeypatch):
    """A task reads, and so sorts, at most about TASK_BYTES of the text layer, whose files hold few records."""
    header = "Id,START,STOP,PATIENT,ENCOUNTERCLASS,CODE,DESCRIPTION,TOTAL_CLAIM_COST"
    raw = tmp_path / "raw"
    raw.mkdir()
    lines = [f"{i},2020-01-01,2020-01-02,p{i % 7},c,{i % 3},d,1.5" for i in range(60)]
    (raw / "encounters.csv").write_text("\n".join([header, *lines]) + "\n")
    monkeypatch.setattr(layers, "FILE_RECORDS", 10)
    monkeypatch.setattr(layers, "TASK_BYTES", 1000)
    (done,) = raw_csv.raw_to_bronze(spark, str(raw), f"{tmp_path}/bronze").collect()
    assert done.row_count == 60 and len(glob.glob(f"{tmp_path}/bronze/encounters.parquet/part-*")) == 6
    (made,) = study.bronze_to_silver(spark, f"{tmp_path}/bronze", f"{tmp_path}/silver", ["encounters"]).collect()
    assert (made.status, made.output_row_count) == ("normalized", 60)
    assert len(glob.glob(f"{tmp_path}/silver/encounters.parquet/part-*")) >= 6
