import random

import pytest
from test_brute_force import random_tables

from conftest import CONDITIONS, ENCOUNTERS, PATIENTS
from wardline.operators.cohort import index_cohort
from wardline.spec import StudySpec
from wardline.streaming.live_cohort import LiveCohort

TABLES = {"patients": PATIENTS, "conditions": CONDITIONS, "encounters": ENCOUNTERS}


def rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def batch_cohort(spark, tables):
    frames = [spark.createDataFrame(tables[t], schema) for t, schema in TABLES.items()]
    return rows(index_cohort(*frames, StudySpec()))


@pytest.fixture(scope="module")
def tables():
    return dict(zip(TABLES, random_tables(5), strict=True))


@pytest.mark.parametrize("seed", [1, 2])
def test_any_order_and_cut_gives_the_batch_cohort(spark, tables, tmp_path, seed):
    rng = random.Random(seed)
    parts = []
    for table, all_rows in tables.items():
        shuffled = rng.sample(all_rows, len(all_rows))
        cuts = sorted(rng.sample(range(len(shuffled)), 2))
        for n, (a, b) in enumerate(zip([0, *cuts], [*cuts, len(shuffled)])):
            parts.append((table, n, shuffled[a:b]))
    rng.shuffle(parts)
    live = LiveCohort(spark, str(tmp_path / "live"), StudySpec())
    for table, n, part in parts:
        live.add(table, spark.createDataFrame(part, TABLES[table]), n)
    want = batch_cohort(spark, tables)
    assert rows(live.current()) == want and want
    again_table, again_n, again_part = parts[4]  # a part given again counts once
    live.add(again_table, spark.createDataFrame(again_part, TABLES[again_table]), again_n)
    assert rows(live.current()) == want
    packed = live.compact(str(tmp_path / "packed"))
    assert rows(packed.current()) == want
    more = {**tables, "conditions": [*tables["conditions"], ("p1", "late", tables["conditions"][0][2], "44054006", "late")]}
    for state in (packed, live):
        state.add("conditions", spark.createDataFrame(more["conditions"][-1:], CONDITIONS), 77)
        assert rows(state.current()) == batch_cohort(spark, more)


def test_an_earlier_event_moves_the_index_date(spark, clinic, tmp_path):
    live = LiveCohort(spark, str(tmp_path), StudySpec())
    live.add("conditions", clinic.conditions(("p", "e1", "2020-05-01", "44054006"), ("p", "x", "2019-01-01", "46635009")), 1)
    first = live.current().first()
    assert (str(first.index_date), first.has_prior_t1dm_before_index, first.age_at_index) == ("2020-05-01", True, None)
    live.add("patients", clinic.patients(("p", "1970-01-01"), ("q", "1970-01-01")), 1)
    assert live.current().first().age_at_index == 50
    live.add("conditions", clinic.conditions(("p", "e0", "2018-05-01", "44054006")), 2)
    row = live.current().first()
    assert (str(row.index_date), row.index_encounter_id, row.t2dm_condition_row_count) == ("2018-05-01", "e0", 2)
    assert row.has_prior_t1dm_before_index is False and row.age_at_index == 48
    live.add("encounters", clinic.encounters(("p", "2010-01-01"), ("p", "2012-01-01"), ("z", "2000-01-01")), 1)
    assert str(live.current().first().first_observed_date) == "2010-01-01"
    touched = {r.seq: (r.table, r.patients) for r in live.history().collect()}
    assert touched == {1: ("conditions", 1), 2: ("patients", 2), 3: ("conditions", 1), 4: ("encounters", 2)}


def test_a_step_that_died_is_repeated_and_counts_once(spark, clinic, tmp_path, monkeypatch):
    live = LiveCohort(spark, str(tmp_path), StudySpec())
    live.add("conditions", clinic.conditions(("p", "e", "2020-05-01", "44054006")), 1)
    part = clinic.conditions(("p", "e", "2019-05-01", "44054006"), ("q", "e", "2019-05-01", "44054006"))
    with monkeypatch.context() as patch:
        patch.setattr(LiveCohort, "_rows_of", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            live.add("conditions", part, 2)
    assert [r.patient_id for r in live.current().collect()] == ["p"]  # the step is not complete
    live.add("conditions", part, 2)
    found = {r.patient_id: (str(r.index_date), r.t2dm_condition_row_count) for r in live.current().collect()}
    assert found == {"p": ("2019-05-01", 2), "q": ("2019-05-01", 1)}


def test_part_files_are_followed(spark, tables, tmp_path):
    """Streams over the silver tables' part files: each file counts once over several calls."""
    silver, live = tmp_path / "silver", LiveCohort(spark, str(tmp_path / "live"), StudySpec())
    for round_ in range(2):
        for table, schema in TABLES.items():
            half = tables[table][round_::2]
            spark.createDataFrame(half, schema).repartition(2).write.mode("append").parquet(str(silver / f"{table}.parquet"))
        live.follow(str(silver), str(tmp_path / "checkpoints"), files_per_batch=1)
    live.follow(str(silver), str(tmp_path / "checkpoints"))
    assert rows(live.current()) == batch_cohort(spark, tables)
    assert live.history().count() >= 6


def test_no_rows_at_all(spark, tmp_path):
    live = LiveCohort(spark, str(tmp_path), StudySpec())
    for table, schema in TABLES.items():
        live.add(table, spark.createDataFrame([], schema), 1)
    assert live.current().collect() == []
