"""Clinical tables derived from the order tables the checks run on.

`silver(...)` binds typed tables, `bronze(...)` the same tables as raw text with some
unreadable dates and numbers mixed in. Both are lazy; the functions for all tables write the joined
order lines first. Every row of the inputs takes part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import layers
from ..spec import CORE_TABLES, Rule, StudySpec

# The study the bound tables are checked with.
BOUND_STUDY = StudySpec(
    target_code="Brand#1", prior_exclusion_code="Brand#10", window_exclusion_code="Brand#11"
)

# The same study with other thresholds.
OTHER_STUDY = StudySpec(
    target_code=BOUND_STUDY.target_code,
    prior_exclusion_code=BOUND_STUDY.prior_exclusion_code,
    window_exclusion_code=BOUND_STUDY.window_exclusion_code,
    minimum_age_years=40,
    baseline_days=180,
)
# A study whose rules hold several codes each, with ten more rules: open, one-sided and two-sided
# bounds, other anchors, least counts, overlapping and unused codes.
MANY_CODES_STUDY = StudySpec(
    target_code=("Brand#1", "Brand#2", "Brand#25"),
    prior_exclusion_code=("Brand#10", "Brand#12"),
    window_exclusion_code=("Brand#11", "Brand#13"),
    rules=(
        Rule("before", ("Brand#10", "Brand#12"), to_days=0, strict=True),
        Rule("until", ("Brand#10", "Brand#12", "Brand#14"), to_days=0),
        Rule("year", ("Brand#3", "Brand#4", "Brand#5"), from_days=-365, to_days=0, kind="require"),
        Rule("after", ("Brand#3", "Brand#16"), from_days=0, to_days=90, from_strict=True),
        Rule("twice", ("Brand#6", "Brand#7"), from_days=-730, to_days=-1, least=2),
        Rule("ever", ("Brand#8", "Brand#9", "Brand#3"), to_days=None, least=3, kind="require"),
        Rule("early", ("Brand#15", "Brand#16"), anchor="first_observed_date", from_days=0, to_days=30),
        Rule("between", ("Brand#17", "Brand#18"), anchor="first_observed_date", from_days=0, from_strict=True,
             to_anchor="index_date", to_days=0, strict=True),
        Rule("until_death", ("Brand#19", "Brand#20"), from_days=1, to_anchor="death_date", to_days=0),
        Rule("unused", ("no code", "Brand#A|B")),
    ),
)
# Concept sets in terms of the bound codes.
FOLLOWUP_CONCEPTS = {
    "class_a": ("bound", "treatment", (("Brand#2", "a one"), ("Brand#3", "a two"))),
    "class_b": ("bound", "treatment", (("Brand#4", "b one"),)),
    "class_c": ("bound", "treatment", (("Brand#5", "c one"), ("Brand#6", "c two"))),
    "class_without_codes": ("bound", "treatment", ()),
}
LAB_CONCEPTS = {
    "lab_a": ("bound", "monitoring", (("click", "a"),)),
    "lab_b": ("bound", "monitoring", (("view", "b"), ("error", "b"))),
}


def study_concepts(sets: dict, uses) -> dict:
    """The sets with a use that the study run looks for."""
    return {name: (vocabulary, uses[0], codes) for name, (vocabulary, _, codes) in sets.items()}


# Some bound dates lie after this day.
REFERENCE_DATE = "2001-06-30"


# Order amounts as raw text, some of an extreme size or no finite number.
EXTREME_AMOUNT = """CASE o_orderkey % 7 WHEN 0 THEN '10.005' WHEN 1 THEN '1e17' WHEN 2 THEN '1e400'
    WHEN 3 THEN '0.00004' WHEN 4 THEN '-1e400' ELSE CAST(CAST(o_totalprice AS BIGINT) AS STRING) END"""
# Results by event type: tiny ones, and large ones that differ little.
EXTREME_RESULT = """CASE event_type WHEN 'click' THEN 0.00004 + (event_id % 3) * 1e-6
    WHEN 'view' THEN 1e9 + (event_id % 3) * 0.125 ELSE value END"""


def source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def silver(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    rows, *columns = _SILVER[table]
    return rows(spark, sf_dir).selectExpr(*columns)


def bronze(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    rows, *columns = _BRONZE[table]
    return rows(spark, sf_dir).selectExpr(*columns)


def bronze_tables(spark: SparkSession, sf_dir: str, tables=CORE_TABLES) -> dict[str, DataFrame]:
    return _tables(spark, sf_dir, _BRONZE, tables)


def silver_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return _tables(spark, sf_dir, _SILVER, CORE_TABLES)


def _tables(spark, sf_dir, bound, tables) -> dict[str, DataFrame]:
    """Several tables, each read more than once: the order lines that some are made of are joined once,
    and written."""
    lines = kept_lines(spark, sf_dir)
    return {
        name: (lines if bound[name][0] is _lines else bound[name][0](spark, sf_dir)).selectExpr(*bound[name][1:])
        for name in tables
    }


_BIRTH = "date_add(DATE'1930-01-01', CAST(c_custkey * 7919 % 21000 AS INT))"
# One patient in eleven dies, 1996 to 2004.
_DEATH = (
    "CASE WHEN c_custkey % 11 = 0"
    " THEN date_add(DATE'1996-01-01', CAST(c_custkey * 104729 % 3000 AS INT)) END"
)
# Some events name no patient, some one that the patients table does not have.
_PATIENT = (
    "CASE WHEN o_orderkey % 97 = 0 THEN NULL"
    " WHEN o_orderkey % 101 = 0 THEN 'unknown-' || CAST(o_custkey AS STRING)"
    " ELSE CAST(o_custkey AS STRING) END"
)
# Levels with spaces around them, blank ones and nulls.
_SEX = (
    "CASE c_custkey % 17 WHEN 0 THEN '   ' WHEN 1 THEN ' ' || c_mktsegment || '  '"
    " WHEN 2 THEN NULL ELSE c_mktsegment END"
)
_ORDERED = "to_date(o_orderdate)"
_LEFT = "date_add(to_date(o_orderdate), CAST(o_orderkey % 4 AS INT))"
_SHIPPED = "to_date(l_shipdate)"
_RESOLVED = "CASE WHEN l_linestatus = 'F' THEN date_add(to_date(l_shipdate), 30) END"


def _people(spark, sf_dir) -> DataFrame:
    nation = source(spark, sf_dir, "nation").join(
        source(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    people = source(spark, sf_dir, "customer").join(
        nation, F.col("c_nationkey") == F.col("n_nationkey")
    )
    # One patient row in fifty stands there twice.
    copies = F.expr("array_repeat(1, IF(c_custkey % 50 = 0, 2, 1))")
    return people.withColumn("copy", F.explode(copies))


def _lines(spark, sf_dir) -> DataFrame:
    """Order lines with their part and order. The part join comes first: a filter on the code
    then thins the lines before the larger join."""
    return (
        source(spark, sf_dir, "lineitem")
        .withColumn("l_shipdate", F.to_date("l_shipdate"))
        .join(source(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(source(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    )


def kept_lines(spark, sf_dir) -> DataFrame:
    """The columns of `_lines` that tables are made of, written and read again."""
    lines = _lines(spark, sf_dir).select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_linestatus", "l_shipdate",
        "o_custkey", "p_brand", "p_type",
    )
    with layers.small_tasks(lines):
        path = layers.write_table(lines, layers.scratch_dir(spark, "lines"), "lines")
    return spark.read.schema(lines.schema).parquet(path).withColumn("o_orderkey", F.col("l_orderkey"))


def _orders(spark, sf_dir) -> DataFrame:
    return source(spark, sf_dir, "orders")


def _events(spark, sf_dir) -> DataFrame:
    return source(spark, sf_dir, "events")


# Typed tables: rows, and the columns as SQL expressions.
_SILVER = {
    "patients": (
        _people,
        "CAST(c_custkey AS STRING) AS patient_id",
        f"{_BIRTH} AS birth_date",
        f"{_DEATH} AS death_date",
        f"{_SEX} AS sex",
        "n_name AS race",
        "r_name AS ethnicity",
        f"year({_BIRTH}) AS birth_year",
        "'patients' AS source_table",
    ),
    "encounters": (
        _orders,
        "CAST(o_orderkey AS STRING) AS encounter_id",
        f"{_PATIENT} AS patient_id",
        f"{_ORDERED} AS encounter_start_date",
        f"{_LEFT} AS encounter_stop_date",
        "o_orderpriority AS encounter_class",
        "o_orderstatus AS code",
        "o_orderpriority AS description",
        "o_totalprice AS total_claim_cost",
        "'encounters' AS source_table",
    ),
    "conditions": (
        _lines,
        f"{_PATIENT} AS patient_id",
        "CAST(l_orderkey AS STRING) AS encounter_id",
        f"{_SHIPPED} AS condition_start_date",
        f"{_RESOLVED} AS condition_stop_date",
        "p_brand AS code",
        "p_type AS description",
        "'conditions' AS source_table",
    ),
    "medications": (
        _lines,
        f"{_PATIENT} AS patient_id",
        "CAST(l_orderkey AS STRING) AS encounter_id",
        f"{_SHIPPED} AS medication_start_date",
        f"date_add({_SHIPPED}, CAST(l_quantity AS INT)) AS medication_stop_date",
        "p_brand AS code",
        "p_type AS description",
        "l_quantity AS dispenses",
        "l_extendedprice AS total_cost",
        "'medications' AS source_table",
    ),
    "observations": (
        _events,
        "CAST(user_id AS STRING) AS patient_id",
        "CAST(NULL AS STRING) AS encounter_id",
        "to_date(ts) AS observation_date",
        "event_type AS code",
        "event_type AS description",
        "CAST(value AS STRING) AS value_raw",
        "value AS value_numeric",
        "'unit' AS units",
        "'observations' AS source_table",
    ),
    "procedures": (
        _lines,
        f"{_PATIENT} AS patient_id",
        "CAST(l_orderkey AS STRING) AS encounter_id",
        f"{_SHIPPED} AS procedure_start_date",
        f"{_SHIPPED} AS procedure_stop_date",
        "p_brand AS code",
        "p_type AS description",
        "l_extendedprice AS base_cost",
        "'procedures' AS source_table",
    ),
    "careplans": (
        _orders,
        "CAST(o_orderkey AS STRING) AS careplan_id",
        f"{_PATIENT} AS patient_id",
        "CAST(o_orderkey AS STRING) AS encounter_id",
        f"{_ORDERED} AS careplan_start_date",
        "CAST(NULL AS DATE) AS careplan_stop_date",
        "o_orderstatus AS code",
        "o_orderpriority AS description",
        "'careplans' AS source_table",
    ),
    # Observations moved into the years of the cohort, for the follow-up summaries.
    "labs": (
        _events,
        "CAST(user_id AS STRING) AS patient_id",
        "date_add(DATE'1995-01-01', CAST(event_id * 37 % 2490 AS INT)) AS observation_date",
        "event_type AS code",
        "value AS value_numeric",
    ),
}


def _stamp(key: str, day: str) -> str:
    """Raw date text: mostly a UTC stamp, some plain, unpadded, unreadable or empty."""
    return f"""CASE {key} % 23 WHEN 3 THEN 'unknown' WHEN 7 THEN '2020-02-30' WHEN 11 THEN NULL
        WHEN 13 THEN CAST({day} AS STRING) WHEN 17 THEN date_format({day}, 'yyyy-M-d')
        ELSE CAST({day} AS STRING) || 'T08:30:00Z' END"""


def _money(key: str, amount: str) -> str:
    """Raw number text: mostly two decimals, some with exponents, units or nothing."""
    cents = f"CAST(CAST({amount} AS DECIMAL(18, 2)) AS STRING)"
    return f"""CASE {key} % 19 WHEN 2 THEN 'n/a' WHEN 5 THEN NULL WHEN 8 THEN {cents} || 'd'
        WHEN 11 THEN '1e3' WHEN 14 THEN '+' || {cents} ELSE {cents} END"""


_LINE_KEY = "(l_orderkey * 7 + l_linenumber)"

# Raw text tables: rows, and the columns as SQL expressions.
_BRONZE = {
    "patients": (
        _people,
        "CAST(c_custkey AS STRING) AS Id",
        f"CASE WHEN c_custkey % 97 = 0 THEN '1970-13-01' ELSE CAST({_BIRTH} AS STRING) END"
        " AS BIRTHDATE",
        f"CAST({_DEATH} AS STRING) AS DEATHDATE",
        f"{_SEX} AS GENDER",
        "n_name AS RACE",
        "r_name AS ETHNICITY",
        "c_name AS CITY",
        "lpad(CAST(c_nationkey AS STRING), 5, '0') AS ZIP",
    ),
    "encounters": (
        _orders,
        "CAST(o_orderkey AS STRING) AS Id",
        f"CAST({_ORDERED} AS STRING) || 'T08:30:00Z' AS START",
        f"{_stamp('o_orderkey', _LEFT)} AS STOP",
        f"{_PATIENT} AS PATIENT",
        "o_orderpriority AS ENCOUNTERCLASS",
        "o_orderstatus AS CODE",
        "o_orderpriority AS DESCRIPTION",
        f"{_money('o_orderkey', 'o_totalprice')} AS TOTAL_CLAIM_COST",
    ),
    "conditions": (
        _lines,
        f"CAST({_SHIPPED} AS STRING) || 'T08:30:00Z' AS START",
        f"{_stamp(_LINE_KEY, _RESOLVED)} AS STOP",
        f"{_PATIENT} AS PATIENT",
        "CAST(l_orderkey AS STRING) AS ENCOUNTER",
        "p_brand AS CODE",
        "p_type AS DESCRIPTION",
    ),
    "medications": (
        _lines,
        f"{_stamp(_LINE_KEY, _SHIPPED)} AS START",
        f"{_PATIENT} AS PATIENT",
        "CAST(l_orderkey AS STRING) AS ENCOUNTER",
        "p_brand AS CODE",
        "p_type AS DESCRIPTION",
        "CAST(CAST(l_quantity AS BIGINT) AS STRING) AS DISPENSES",
        f"{_money(_LINE_KEY, 'l_extendedprice')} AS TOTALCOST",
    ),
    "observations": (
        _events,
        f"{_stamp('event_id', 'to_date(ts)')} AS DATE",
        "CAST(user_id AS STRING) AS PATIENT",
        "event_type AS CODE",
        "event_type AS DESCRIPTION",
        f"{_money('event_id', 'value')} AS VALUE",
    ),
    "procedures": (
        _lines,
        f"{_stamp(_LINE_KEY, _SHIPPED)} AS START",
        f"{_PATIENT} AS PATIENT",
        "CAST(l_orderkey AS STRING) AS ENCOUNTER",
        "p_brand AS CODE",
        "p_type AS DESCRIPTION",
        f"{_money(_LINE_KEY, 'l_extendedprice')} AS BASE_COST",
    ),
    "careplans": (
        _orders,
        "CAST(o_orderkey AS STRING) AS Id",
        f"{_stamp('o_orderkey', _ORDERED)} AS START",
        f"{_PATIENT} AS PATIENT",
        "CAST(o_orderkey AS STRING) AS ENCOUNTER",
        "o_orderstatus AS CODE",
        "o_orderpriority AS DESCRIPTION",
    ),
}


def reference_layer(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Customers as patients, and references to them of mixed quality: part and order numbers
    run past the customer numbers, so some of those name no patient."""
    lines = source(spark, sf_dir, "lineitem")
    orders = source(spark, sf_dir, "orders")
    of_orders = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    key = {
        "patients": (source(spark, sf_dir, "customer"), "c_custkey"),
        "encounters": (orders, "o_custkey"),
        "conditions": (of_orders, "o_custkey"),
        "medications": (lines, "l_partkey"),
        "observations": (source(spark, sf_dir, "events"), "user_id"),
        "procedures": (lines, "l_suppkey"),
        "careplans": (orders, "o_orderkey"),
    }
    return {
        table: frame.selectExpr(f"CAST({column} AS STRING) AS patient_id")
        for table, (frame, column) in key.items()
    }
