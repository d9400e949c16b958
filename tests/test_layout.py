import os
import random
from datetime import date, timedelta

import pytest

from wardline.sources import layers, layout

SCHEMA = "code string, patient_id string, day date, n bigint"


def part_files(folder):
    return {
        os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
        for d, _, names in os.walk(folder) for f in names if f.startswith("part-") and "/_" not in d
    }


def test_text_folders_come_back_as_text(spark, tmp_path):
    rows = [("0044", "a", 1), ("0100", "b", 2), ("44", "c", 3), ("1e3", "d", 4), ("2020-01-01", "e", 5), (None, "f", 6)]
    frame = spark.createDataFrame(rows, "zip string, name string, n int")
    layers.write_table(frame, str(tmp_path), "t", ["zip"])
    found = layers.read_table(spark, str(tmp_path), "t")
    assert found.schema.simpleString() == "struct<zip:string,name:string,n:int>"
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(rows, key=repr)
    typed = spark.createDataFrame([(date(2020, 1, 2), 7, "x"), (date(2020, 1, 2), 8, "y")], "day date, k bigint, v string")
    layers.write_table(typed, str(tmp_path), "typed", ["day", "k"])
    found = layers.read_table(spark, str(tmp_path), "typed")
    assert found.schema == typed.schema and found.where("day = DATE'2020-01-02' AND k = 8").count() == 1
    layers.write_table(typed.drop("k"), str(tmp_path), "typed")  # written again without folders
    assert layers.read_table(spark, str(tmp_path), "typed").columns == ["day", "v"]


def test_one_folder_is_rewritten_and_the_others_stay(spark, tmp_path):
    rows = [(f"0{i % 4}", i) for i in range(40)]
    frame = spark.createDataFrame(rows, "code string, n bigint")
    layers.write_table(frame, str(tmp_path), "t", ["code"])
    before = part_files(tmp_path)
    layers.write_table(frame.where("code = '02'").selectExpr("code", "n * 100 AS n"), str(tmp_path), "t", ["code"], "folders")
    after = part_files(tmp_path)
    same = {p for p in before if "code=02" not in p}
    assert same and all(after[p] == before[p] for p in same)
    assert {p for p in after if "code=02" in p}.isdisjoint(before)
    found = sorted(map(tuple, layers.read_table(spark, str(tmp_path), "t").collect()))
    assert found == sorted((c, n * 100 if c == "02" else n) for c, n in rows)
    layers.write_table(frame.where("code = '03'"), str(tmp_path), "t", ["code"])  # the whole table
    assert layers.read_table(spark, str(tmp_path), "t").count() == 10
    with pytest.raises(ValueError, match="other columns"):
        layers.write_table(frame.selectExpr("code", "CAST(n AS int) AS n"), str(tmp_path), "t", ["code"], "folders")
    with pytest.raises(ValueError):
        layers.write_table(frame, str(tmp_path), "t", replace="folders")
    with pytest.raises(ValueError):
        layers.write_table(frame, str(tmp_path), "t", ["code"], "rows")


def events(n=6000):
    rng = random.Random(2)
    out = []
    for i in range(n):
        code = "hot" if rng.random() < 0.34 else f"c{rng.randrange(40):02d}"
        patient = "p000" if rng.random() < 0.34 else f"p{rng.randrange(300):03d}"
        out.append((code, patient, date(2020, 1, 1) + timedelta(rng.randrange(900)), i))
    return out + [(None, "p001", None, -1), ("c01", None, date(2020, 5, 5), -2)]


def test_filters_on_each_column_skip_files(spark, tmp_path):
    rows = events()
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    folder = str(tmp_path)
    layout.write_clustered(frame, folder, "clustered", ["code", "patient_id", "day"], 64)
    layers.write_table(frame.repartition(64).sortWithinPartitions("code", "patient_id"), folder, "plain")
    layout.write_cover(spark, folder, "plain", ["code", "patient_id", "day"])
    assert layout.has_cover(folder, "plain") and not layout.has_cover(folder, "other")
    low, high = date(2021, 1, 1), date(2021, 1, 20)
    cases = [
        ({"code": {"c07"}}, lambda r: r[0] == "c07"),
        ({"code": {"c07", "c08"}}, lambda r: r[0] in ("c07", "c08")),
        ({"patient_id": ("p100", "p104")}, lambda r: r[1] and "p100" <= r[1] <= "p104"),
        ({"day": (low, high)}, lambda r: r[2] and low <= r[2] <= high),
        ({"day": (None, date(2020, 1, 9))}, lambda r: r[2] and r[2] <= date(2020, 1, 9)),
        ({"code": {"hot"}, "patient_id": {"p000"}, "day": (low, high)},
         lambda r: r[0] == "hot" and r[1] == "p000" and r[2] and low <= r[2] <= high),
        ({"code": {"nothing"}}, lambda r: False),
        ({"code": set()}, lambda r: False),
    ]
    for bounds, holds in cases:
        want = sorted((r for r in rows if holds(r)), key=repr)
        for table in ("clustered", "plain"):
            got = layout.read_within(spark, folder, table, **bounds)
            assert sorted(map(tuple, got.collect()), key=repr) == want
        few = layout.files_to_read(spark, folder, "clustered", **bounds).count()
        many = layout.files_to_read(spark, folder, "plain", **bounds).count()
        assert few < 0.6 * many or many == 0, (bounds, few, many)
    # The hot code and patient are spread over files.
    largest = layout.files_to_read(spark, folder, "clustered").agg({"rows": "max"}).first()[0]
    assert largest < 4 * len(rows) / 64
    assert layers.read_table(spark, folder, "clustered").count() == len(rows)


def test_equal_rows_and_empty_tables(spark, tmp_path):
    same = spark.createDataFrame([("c", "p", date(2020, 1, 1), 1)] * 3000, SCHEMA)
    layout.write_clustered(same, str(tmp_path), "same", ["code", "day"], 6)
    assert layout.files_to_read(spark, str(tmp_path), "same").count() >= 5
    assert layout.read_within(spark, str(tmp_path), "same", code={"c"}).count() == 3000
    layout.write_clustered(same.limit(0), str(tmp_path), "none", ["code"], 4)
    assert layout.read_within(spark, str(tmp_path), "none", code={"c"}).count() == 0
