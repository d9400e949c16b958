"""What a task holds, and how often the order lines are joined, when tables grow."""

from datetime import datetime

import pytest
from test_plans import plan

from wardline.operators import intervals
from wardline.plans import bindings
from wardline.sources import layers, layout, raw_csv

PARTS, SIZE = "spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
LINE_TABLES = ("conditions", "medications", "procedures")


@pytest.fixture
def order_tables(spark, tmp_path):
    """The given tables, a few rows each, keys that repeat and are null."""
    day = datetime(1997, 3, 5)
    tables = {
        "lineitem": ("l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_extendedprice double,"
                     " l_linestatus string, l_shipdate timestamp",
                     [(k % 5, k % 3, k, 2.0 * k, 10.25 * k, "FO"[k % 2], day) for k in range(12)]
                     + [(None, 1, 1, 1.0, 1.0, "F", day), (1, None, 1, 1.0, 1.0, "F", None), (2, 2, 7, None, None, None, None)]),
        "orders": ("o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp,"
                   " o_orderpriority string",
                   [(1, 7, "F", 1.5, day, "1"), (1, 8, "F", 2.5, day, "2"), (2, None, "O", 3.5, day, None), (None, 1, None, None, None, None)]),
        "part": ("p_partkey long, p_brand string, p_type string", [(0, "Brand#1", "a"), (1, None, "b"), (2, "Brand#2", "c"), (2, "Brand#3", "c")]),
        "customer": ("c_custkey long, c_name string, c_nationkey int, c_mktsegment string", [(7, "x", 1, "S"), (8, "y", 1, None)]),
        "nation": ("n_nationkey int, n_name string, n_regionkey int", [(1, "N", 1)]),
        "region": ("r_regionkey int, r_name string", [(1, "R")]),
        "events": ("event_id long, ts timestamp, user_id long, event_type string, value double", [(1, day, 7, "view", 1.5)]),
    }
    for name, (schema, rows) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


@pytest.mark.parametrize("whole, one", [(bindings.bronze_tables, bindings.bronze), (bindings.silver_tables, bindings.silver)])
def test_order_lines_are_joined_once_for_all_tables(spark, order_tables, whole, one):
    found = whole(spark, order_tables)
    assert list(found) == list(bindings.CORE_TABLES)
    for name, frame in found.items():
        alone = one(spark, order_tables, name)
        assert frame.dtypes == alone.dtypes
        assert sorted(map(str, frame.collect())) == sorted(map(str, alone.collect())) != []
        if name in LINE_TABLES:
            assert "Join" in plan(alone) and "Join" not in plan(frame)


def test_shuffles_have_as_many_tasks_as_the_files_call_for(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/a table"
    spark.range(20_000).selectExpr("uuid() AS x").write.parquet(path)
    frame, before = spark.read.parquet(path), (spark.conf.get(PARTS), spark.conf.get(SIZE))
    monkeypatch.setattr(layers, "TASK_BYTES", 10_000)
    with layers.small_tasks(frame):
        assert int(spark.conf.get(PARTS)) > 100 and spark.conf.get(SIZE) == "10000"
    with pytest.raises(KeyError), layers.small_tasks(frame):
        raise KeyError
    assert (spark.conf.get(PARTS), spark.conf.get(SIZE)) == before
    with layers.small_tasks(spark.createDataFrame([(1,)], "a int")):
        assert spark.conf.get(PARTS) == before[0]


def test_eras_are_dealt_into_small_tasks(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/spans"
    day = "date_add(DATE'2000-01-01', CAST(id % 900 AS INT))"
    rows = ["uuid() AS patient_id", f"{day} AS a", f"date_add({day}, 1) AS b"]
    spark.range(20_000).selectExpr(*rows).write.parquet(path)
    made = []

    def watched(frame, name):
        made.append((name, int(frame.sparkSession.conf.get(PARTS))))
        return layers.materialize(frame, name)

    monkeypatch.setattr(layers, "TASK_BYTES", 20_000)
    monkeypatch.setattr(intervals, "materialize", watched)
    assert intervals.eras(spark.read.parquet(path), ["patient_id"], "a", "b", 30).count() == 20_000
    assert [name for name, _ in made] == ["era-days", "era-pieces"] and min(n for _, n in made) > 20


def test_cover_is_counted_without_sorting_rows(spark, tmp_path):
    rows = spark.createDataFrame([("b", 1), ("a", 2), (None, 3)], "code string, day int")
    layers.write_table(rows.coalesce(1), str(tmp_path), "t")
    cover = layout._covered(layers.read_table(spark, str(tmp_path), "t"), ["code", "day"])
    assert "Sort" not in plan(cover)
    (row,) = cover.collect()
    assert (row.rows, row.low_0, row.high_0, row.null_0, row.low_1, row.high_1, row.null_1) == (3, "a", "b", True, 1, 3, False)


def test_only_lines_with_a_quote_are_searched_for_quoted_fields(spark, tmp_path):
    (tmp_path / "t.csv").write_text('a,b\n1,"x, ""y"""\n2,plain\n')
    (tmp_path / "u.csv").write_text('a,b\n1,"x\ny"\n')
    profile = raw_csv.line_profile(spark, [f"{tmp_path}/t.csv", f"{tmp_path}/u.csv"])
    found = sorted((r.table[-5:], r.records, r.spans_lines) for r in profile.collect())
    assert found == [("t.csv", 2, False), ("u.csv", 2, True)]
    assert "CASE WHEN Contains(value" in plan(profile)


def test_layer_tables_are_written_compactly(spark, tmp_path):
    layers.write_table(spark.range(10), str(tmp_path), "t")
    assert all(".zstd." in p for p in spark.read.parquet(f"{tmp_path}/t.parquet").inputFiles())
