"""Structure, reference and signal checks of a layer, as small frames.

A layer is a dict of table name -> DataFrame, or None for an absent table.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NullType

from ..functions.expr import distinct_with_null, has_code
from ..sources.layers import materialize
from ..spec import (
    BRONZE_CONTRACT,
    EVENT_TABLES,
    SILVER_CONTRACT,
    SILVER_DATES,
    TARGET_CODE,
    codes_text,
)

Layer = dict[str, DataFrame | None]


@dataclass(frozen=True)
class LayerRules:
    """What differs between the raw-text layer and the typed layer."""

    contract: dict[str, tuple[str, ...]]
    dates: dict[str, tuple[str, ...]]
    missing_columns_status: str
    patient_key: str
    reference_key: str
    missing_key_status: str
    code_column: str
    date_column: str | None
    absent_status: str


# Fixed labels of the two layers.
BRONZE = LayerRules(
    contract=BRONZE_CONTRACT,
    dates={},
    missing_columns_status="missing_core_columns",
    patient_key="Id",
    reference_key="PATIENT",
    missing_key_status="missing_patient_key_column",
    code_column="CODE",
    date_column=None,
    absent_status="absent_in_smoke_data",
)
SILVER = LayerRules(
    contract=SILVER_CONTRACT,
    dates=SILVER_DATES,
    missing_columns_status="missing_required_columns",
    patient_key="patient_id",
    reference_key="patient_id",
    missing_key_status="missing_patient_id_column",
    code_column="code",
    date_column="condition_start_date",
    absent_status="absent",
)

_DATE_CHECKS = "array<struct<column:string,dtype:string,is_date:boolean,null_count:bigint>>"
_NULL_COUNTS = "array<struct<column:string,null_count:bigint>>"


def measures(table: str, frame: DataFrame, rules: LayerRules) -> dict[str, Column]:
    """What the checks count in a table: its rows, and the nulls of its date columns."""
    dates = [c for c in rules.dates.get(table, ()) if c in frame.columns]
    nulls = {f"nulls_{c}": F.count_if(F.col(f"`{c}`").isNull()) for c in dates}
    return {"row_count": F.count(F.lit(1)), **nulls}


def table_checks(
    spark: SparkSession,
    layer: Layer,
    required,
    optional,
    rules: LayerRules,
    measured: dict[str, dict] | None = None,
) -> DataFrame:
    """One row per required table and per optional table that is present. Each table is read
    once, for its row count and all its null counts; a table whose `measures` were taken as it was
    written (`measured`, by table) is not read."""
    wanted = [(t, True) for t in required] + [
        (t, False) for t in optional if layer.get(t) is not None
    ]
    checks = [
        _table_check(spark, layer.get(table), table, is_required, position, rules, (measured or {}).get(table))
        for position, (table, is_required) in enumerate(wanted)
    ]
    return reduce(DataFrame.unionByName, checks)


def _table_check(spark, frame, table, required, position, rules, measured) -> DataFrame:
    columns = frame.columns if frame is not None else []
    absent = [c for c in rules.contract.get(table, ()) if c not in columns]
    dates = [c for c in rules.dates.get(table, ()) if c in columns]
    types = {f.name: f.dataType for f in frame.schema.fields} if frame is not None else {}
    # A column without any type (every value null) passes as a date.
    is_date = {c: isinstance(types[c], (DateType, NullType)) for c in dates}
    invalid = [c for c in dates if not is_date[c]]

    if frame is None:
        counts = spark.range(1).select(F.lit(None).cast("bigint").alias("row_count"))
    elif measured is not None:
        counts = spark.range(1).select(*[F.lit(measured[n]).cast("bigint").alias(n) for n in measures(table, frame, rules)])
    else:
        counts = frame.agg(*[c.alias(n) for n, c in measures(table, frame, rules).items()])
    if invalid:
        status = F.lit("invalid_date_dtypes")
    elif absent:
        status = F.lit(rules.missing_columns_status)
    elif frame is None:
        status = F.lit("missing")
    else:
        status = F.when(F.col("row_count") == 0, "empty").otherwise("present")

    first_date = rules.dates.get(table, ())[:1]
    return counts.select(
        F.lit(position).alias("position"),
        F.lit(table).alias("table_name"),
        F.lit(required).alias("required"),
        F.lit(frame is not None).alias("exists"),
        "row_count",
        F.lit(len(columns) if frame is not None else None).cast("int").alias("column_count"),
        _texts(columns).alias("columns"),
        _texts(absent if frame is not None else []).alias("missing_columns"),
        _texts(invalid).alias("invalid_date_columns"),
        F.array(
            *[
                F.struct(
                    F.lit(c).alias("column"),
                    F.lit(types[c].simpleString()).alias("dtype"),
                    F.lit(is_date[c]).alias("is_date"),
                    F.col(f"nulls_{c}").alias("null_count"),
                )
                for c in dates
            ]
        ).cast(_DATE_CHECKS).alias("date_column_checks"),
        F.array(
            *[
                F.struct(F.lit(c).alias("column"), F.col(f"nulls_{c}").alias("null_count"))
                for c in first_date
                if c in dates
            ]
        ).cast(_NULL_COUNTS).alias("required_date_null_counts"),
        (F.lit("missing") if frame is None else status).alias("status"),
    )


def reference_checks(
    spark: SparkSession, layer: Layer, tables, rules: LayerRules, patients: str = "patients"
) -> DataFrame:
    """One row per event table: distinct patient references, and how many name no patient.

    One shuffle for all tables: every id carries a bit for the table it was seen in, ids merge
    by `bit_or` before they move, and the merged ids are counted. Null ids take no part.
    """
    people = layer.get(patients)
    status: dict[str, str] = {}
    for table in tables:
        frame = layer.get(table)
        if people is None or frame is None:
            status[table] = "missing_input"
        elif rules.patient_key not in people.columns or rules.reference_key not in frame.columns:
            status[table] = rules.missing_key_status
    checked = [t for t in tables if t not in status]
    bit = {t: 1 << (i + 1) for i, t in enumerate(checked)}

    if checked:
        seen = [_ids(people, rules.patient_key, 1)] + [
            _ids(layer[t], rules.reference_key, bit[t]) for t in checked
        ]
        merged = reduce(DataFrame.unionByName, seen).groupBy("id").agg(
            F.bit_or("seen").alias("seen")
        )
        refers = {t: F.col("seen").bitwiseAND(bit[t]) != 0 for t in checked}
        unknown = F.col("seen").bitwiseAND(1) == 0
        counts = merged.agg(
            *[F.count_if(refers[t]).alias(f"unique_{t}") for t in checked],
            *[F.count_if(refers[t] & unknown).alias(f"unknown_{t}") for t in checked],
        )
    else:
        counts = spark.range(1)

    rows = []
    for position, table in enumerate(tables):
        known = table in bit
        none = F.lit(None).cast("bigint")
        missed = F.col(f"unknown_{table}") if known else none
        rows.append(
            F.struct(
                F.lit(position).alias("position"),
                F.lit(table).alias("table_name"),
                F.lit(known).alias("checked"),
                missed.alias("unknown_patient_reference_count"),
                (F.col(f"unique_{table}") if known else none).alias(
                    "unique_patient_reference_count"
                ),
                (
                    F.when(missed == 0, "passed").otherwise("failed")
                    if known
                    else F.lit(status[table])
                ).alias("status"),
            )
        )
    if not rows:
        return spark.createDataFrame(
            [],
            "position int, table_name string, checked boolean, "
            "unknown_patient_reference_count bigint, unique_patient_reference_count bigint, "
            "status string",
        )
    return counts.select(F.inline(F.array(*rows)))


def _ids(frame: DataFrame, key: str, bit: int) -> DataFrame:
    return frame.select(
        F.col(f"`{key}`").cast("string").alias("id"), F.lit(bit).alias("seen")
    ).where(F.col("id").isNotNull())


def target_signal(
    spark: SparkSession, conditions: DataFrame | None, rules: LayerRules, code: str = TARGET_CODE
) -> DataFrame:
    """One row: rows and distinct patients with the target code, dated or not, and in the typed
    layer the first and last date."""
    needed = [rules.code_column, rules.reference_key]
    if rules.date_column:
        needed.append(rules.date_column)
    problem = None
    if conditions is None:
        problem = "conditions_missing"
    else:
        lacking = [c for c in needed if c not in conditions.columns]
        if lacking and rules.date_column:
            problem = f"conditions_missing_columns: {sorted(lacking)}"
        elif lacking:
            kind = "code" if lacking[0] == rules.code_column else "patient"
            problem = f"conditions_missing_{kind}_column"
    dated = rules.date_column is not None
    if problem:
        none = F.lit(None)
        return spark.range(1).select(
            F.lit(False).alias("checked"),
            F.lit(codes_text(code)).alias("target_code"),
            none.cast("bigint").alias("condition_row_count"),
            none.cast("bigint").alias("patient_count"),
            *([none.cast("date").alias("earliest_date"), none.cast("date").alias("latest_date")]
              if dated else []),
            F.lit(problem).alias("status"),
        )
    hits = conditions.where(has_code(code, rules.code_column))
    n = F.count(F.lit(1))
    dates = (
        [F.min(rules.date_column).alias("earliest_date"),
         F.max(rules.date_column).alias("latest_date")]
        if dated
        else []
    )
    return hits.agg(
        F.lit(True).alias("checked"),
        F.lit(codes_text(code)).alias("target_code"),
        n.alias("condition_row_count"),
        distinct_with_null(F.col(rules.reference_key)).alias("patient_count"),
        *dates,
        F.when(n > 0, "present").otherwise(rules.absent_status).alias("status"),
    )


def verdict(tables: DataFrame, references: DataFrame, rules: LayerRules) -> DataFrame:
    """One row: how many checks failed, which tables failed them, and whether all passed."""
    required = F.col("required")
    missing = required & ~F.col("exists")
    empty = required & (F.col("status") == "empty")
    lacking = required & (F.size("missing_columns") > 0)
    invalid = F.col("status") == "invalid_date_dtypes"
    failed = references.agg(
        F.struct(
            F.count_if(F.col("status") == "failed").alias("n"),
            _tables_where(F.col("status") == "failed").alias("names"),
        ).alias("failed")
    )
    out = tables.agg(
        F.count_if(required).alias("required_table_count"),
        F.count_if(~required).alias("optional_table_count_present"),
        F.count_if(missing).alias("missing_required_table_count"),
        F.count_if(empty).alias("empty_required_table_count"),
        F.count_if(lacking).alias("tables_missing_columns_count"),
        F.count_if(invalid).alias("tables_with_invalid_date_dtypes_count"),
        _tables_where(missing).alias("missing_required_tables"),
        _tables_where(empty).alias("empty_required_tables"),
        _tables_where(lacking).alias("tables_missing_columns"),
        _tables_where(invalid).alias("tables_with_invalid_date_dtypes"),
    ).select(
        "*",
        failed.scalar().getField("n").alias("failed_patient_reference_table_count"),
        failed.scalar().getField("names").alias("failed_patient_reference_tables"),
    )
    counts = (
        "missing_required_table_count",
        "empty_required_table_count",
        "tables_missing_columns_count",
        "tables_with_invalid_date_dtypes_count",
        "failed_patient_reference_table_count",
    )
    passed = reduce(lambda a, b: a & b, [F.col(c) == 0 for c in counts])
    return out.withColumn("structural_checks_passed", passed)


def bronze_quality(
    spark: SparkSession, layer: Layer, required, optional=(), code: str = TARGET_CODE, measured: dict | None = None
) -> dict[str, DataFrame]:
    """Check frames of the raw-text layer. References are checked for every event table that is
    required or present; the signal does not influence the verdict. The references, a row per table,
    are written first: their check is the most expensive one, and the verdict reads it too."""
    tables = table_checks(spark, layer, required, optional, BRONZE, measured)
    to_check = [t for t in EVENT_TABLES if t in required or layer.get(t) is not None]
    references = materialize(reference_checks(spark, layer, to_check, BRONZE), "references")
    signal = target_signal(spark, layer.get("conditions"), BRONZE, code)
    return {
        "tables": tables,
        "references": references,
        "signal": signal,
        "verdict": verdict(tables, references, BRONZE),
    }


def silver_quality(
    spark: SparkSession, layer: Layer, required, code: str = TARGET_CODE, measured: dict | None = None
) -> dict[str, DataFrame]:
    """Check frames of the typed layer: required tables only. The references are written first."""
    tables = table_checks(spark, layer, required, (), SILVER, measured)
    to_check = [t for t in EVENT_TABLES if t in required]
    references = materialize(reference_checks(spark, layer, to_check, SILVER), "references")
    signal = target_signal(spark, layer.get("conditions"), SILVER, code)
    return {
        "tables": tables,
        "references": references,
        "signal": signal,
        "verdict": verdict(tables, references, SILVER),
    }


def _texts(values) -> Column:
    return F.from_json(F.lit(json.dumps(list(values))), "array<string>")


def _tables_where(wanted: Column) -> Column:
    """Names of the wanted check rows in check order; one entry per table at most."""
    picked = F.array_sort(F.collect_list(F.when(wanted, F.struct("position", "table_name"))))
    return F.transform(picked, lambda item: item["table_name"])
