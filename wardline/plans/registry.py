"""The registered queries: every operator, run over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.expr import clean_level, completed_years, days_between, lenient_double
from ..functions.quantiles import exact_quantiles
from ..operators import cohort as cohorts
from ..operators import followup, funnel, intervals, quality, rules, summary, survival
from ..operators.normalize import normalize
from ..sources import files, layers, layout, raw_csv
from ..spec import CORE_TABLES, LAB_USES, MEDICATION_USES, SILVER_DATES, Scenario
from ..streaming.live_cohort import LiveCohort
from . import bindings, study
from .ledger import Ledger
from .bindings import (
    BOUND_STUDY,
    FOLLOWUP_CONCEPTS,
    LAB_CONCEPTS,
    MANY_CODES_STUDY,
    OTHER_STUDY,
    REFERENCE_DATE,
)

Query = Callable[[SparkSession, str], DataFrame]

HASH_BUCKET = 500
BLANK_LINE_PARTS = 16
RECURRENCE_DAYS = 180
CLUSTER_FILES = 128
# Bounds that a clustered table is read with.
CLUSTER_BOUNDS = {
    "code": {"code": {"Brand#3"}},
    "patients": {"patient_id": ("20", "21")},
    "days": {"condition_start_date": (date(1998, 1, 1), date(1998, 2, 28))},
    "all": {"code": {"Brand#5"}, "patient_id": ("1", "3"), "condition_start_date": (date(1997, 1, 1), None)},
}
# Tables with difficult texts, and their columns.
CELL_TABLES = {
    "documents": ("doc_id", "text", "lang", "source", "n_chars"),
    "conversations": ("conv_id", "turn", "role", "text"),
    "pages": ("page_id", "url", "html"),
}
# Outputs of the whole study, and what is added up over their rows.
STUDY_VALUES = {
    "index_cohort": "observable_history_days_before_index",
    "attrition": "remaining_n",
    "final_cohort": "age_at_index",
    "followup_window": "follow_up_days",
    "medication_exposure": "medication_rows",
    "utilization": "encounters",
    "cost_summary": "total",
    "lab_summary": "results",
    "lab_trajectory": "results",
    "survival_table": "deaths",
    "baseline_window": "baseline_encounter_count",
    "exclusion_in_followup": "row_count",
    "date_parse_check": "unreadable",
    "future_date_check": "after_reference_date",
    "model_person": "year_of_birth",
    "model_visit_occurrence": "1",
    "model_condition_occurrence": "condition_source_value LIKE 'Brand#1%'",
    "model_drug_exposure": "quantity",
    "model_measurement": "value_as_number",
    "model_procedure_occurrence": "1",
}
# Common-model table -> end of its query's name.
MODEL_KEYS = {
    "person": "person", "visit_occurrence": "visit", "condition_occurrence": "condition",
    "drug_exposure": "drug", "measurement": "measurement", "procedure_occurrence": "procedure",
}


def _three(spark, sf_dir):
    return tuple(
        bindings.silver(spark, sf_dir, t) for t in ("patients", "conditions", "encounters")
    )


def index_cohort(spark, sf_dir, spec=BOUND_STUDY):
    return cohorts.index_cohort(*_three(spark, sf_dir), spec)


def index_cohort_staged(spark, sf_dir, limit=None):
    """The form the study runs: index events written first, then one of two joins by their size."""
    return cohorts.index_cohort(
        *_three(spark, sf_dir), BOUND_STUDY,
        stage=lambda events: layers.materialize(events, "index_events"), limit=limit,
    )


def live_cohort(spark, sf_dir):
    """The index cohort from parts of the three tables, later events before earlier ones, so that index
    dates move back with every part."""
    patients, conditions, encounters = _three(spark, sf_dir)
    live = LiveCohort(spark, layers.scratch_dir(spark, "live"), BOUND_STUDY)
    late, middle = "DATE'2000-01-01'", "DATE'1997-06-01'"

    def cut(frame, day):
        yield frame.where(f"{day} >= {late}")
        yield frame.where(f"{day} IS NULL OR ({day} >= {middle} AND {day} < {late})")
        yield frame.where(f"{day} < {middle}")

    number = F.coalesce(F.col("patient_id").try_cast("bigint"), F.lit(0)) % 3
    parts = zip(
        cut(conditions, "condition_start_date"),
        (patients.where(number == n) for n in range(3)),
        cut(encounters, "encounter_start_date"),
    )
    for batch, (events, people, visits) in enumerate(parts):
        live.add("conditions", events, batch)
        live.add("patients", people, batch)
        live.add("encounters", visits, batch)
    return live.current()


def _final(spark, sf_dir):
    return cohorts.final_cohort(index_cohort(spark, sf_dir))


# --- raw files -------------------------------------------------------------------------------


def _write_raw(frames: dict[str, DataFrame], spark: SparkSession) -> str:
    raw_dir = layers.scratch_dir(spark, "raw")
    for table, frame in frames.items():
        layers.write_csv(frame, f"{raw_dir}/{table}.csv")
    return raw_dir


def _write_packed(spark, sf_dir) -> str:
    """All raw tables as packed text, a fifth of its size; the joined order lines go when it is written."""
    raw_dir = layers.scratch_dir(spark, "raw")
    with layers.scratch(spark), layers.freed_shuffles(spark):
        for table, frame in bindings.bronze_tables(spark, sf_dir).items():
            layers.write_csv(frame, f"{raw_dir}/{table}.csv", packed=True)
    return raw_dir


def bronze_csv_roundtrip(spark, sf_dir):
    raw_dir = _write_packed(spark, sf_dir)
    converted = raw_csv.raw_to_bronze(spark, raw_dir, layers.scratch_dir(spark, "bronze"))
    return converted.select(
        "table_name",
        "row_count",
        "column_count",
        F.array_join("columns", ",").alias("columns"),
        "status",
    )


def raw_inventory(spark, sf_dir):
    frames = bindings.bronze_tables(spark, sf_dir)
    del frames["careplans"]
    frames["regions"] = bindings.source(spark, sf_dir, "region")
    found = raw_csv.raw_inventory(
        spark,
        _write_raw(frames, spark),
        [f"{t}.csv" for t in CORE_TABLES],
        ["allergies.csv"],
    )
    return found.select(
        "position",
        "filename",
        "required",
        "expected",
        "exists",
        "row_count",
        F.array_join("header", ",").alias("header"),
        "status",
    )


def partitioned_rewrite(spark, sf_dir):
    """Orders in a folder per month, named by a text like 0003: one folder is rewritten, one is thinned,
    the others stay; then the table is read back."""
    root = layers.scratch_dir(spark, "partitioned")
    orders = bindings.source(spark, sf_dir, "orders").selectExpr(
        "lpad(CAST(month(o_orderdate) AS STRING), 4, '0') AS month_code", "o_orderkey", "o_totalprice"
    )
    layers.write_table(orders, root, "orders", ["month_code"])
    some = orders.where("month_code = '0003' OR (month_code = '0007' AND o_orderkey % 2 = 0)")
    changed = some.withColumn("o_orderkey", F.expr("IF(month_code = '0003', -o_orderkey, o_orderkey)"))
    layers.write_table(changed, root, "orders", ["month_code"], replace="folders")
    found = layers.read_table(spark, root, "orders")
    return found.groupBy("month_code").agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum("o_orderkey").alias("key_sum"),
        F.round(F.sum("o_totalprice"), 2).alias("total"),
    )


def clustered_reads(spark, sf_dir):
    """Conditions laid out by code, patient and day at once: rows within bounds on each and on all, and
    whether at most half of the files were opened."""
    root = layers.scratch_dir(spark, "clustered")
    columns = ["code", "patient_id", "condition_start_date"]
    conditions = bindings.silver(spark, sf_dir, "conditions")
    with layers.small_tasks(conditions):
        conditions = layers.materialize(conditions, "conditions")
    layout.write_clustered(conditions, root, "conditions", columns, CLUSTER_FILES)
    whole = layout.files_to_read(spark, root, "conditions").count()
    parts = []
    for name, bounds in CLUSTER_BOUNDS.items():
        opened = layout.files_to_read(spark, root, "conditions", **bounds).count()
        rows = layout.read_within(spark, root, "conditions", **bounds)
        parts.append(
            rows.agg(
                F.lit(name).alias("bounds"),
                F.count(F.lit(1)).alias("row_count"),
                F.count_distinct("encounter_id").alias("encounters"),
                F.lit(2 * opened <= whole).alias("skips_half"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def raw_file_hash(spark, sf_dir):
    """Customers written as text files of HASH_BUCKET numbers each, then hashed per file."""
    root = layers.scratch_dir(spark, "hash")
    line = F.concat_ws(",", F.col("c_custkey").cast("string"), "c_name", "c_mktsegment")
    (
        bindings.source(spark, sf_dir, "customer")
        .select(F.floor(F.col("c_custkey") / HASH_BUCKET).alias("bucket"), "c_custkey",
                line.alias("value"))
        .repartition("bucket")
        .sortWithinPartitions("bucket", "c_custkey")
        .select("bucket", "value")
        .write.partitionBy("bucket")
        .text(root)
    )
    entries = [
        files.entry(f"{root}/{name}")
        for name in files.list_directory(root, "")
        if name.startswith("bucket=")
    ]
    sizes = spark.createDataFrame(
        [(e.path, e.size_bytes) for e in entries], "table string, size_bytes bigint"
    )
    return files.table_digests(spark, entries).join(sizes, "table").select(
        F.regexp_extract("table", r"bucket=(\d+)", 1).cast("bigint").alias("bucket"),
        "size_bytes",
        "sha256",
    )


# --- normalisation and checks ----------------------------------------------------------------


def _silver_query(table: str) -> Query:
    return lambda spark, sf_dir: normalize(table, bindings.bronze(spark, sf_dir, table))


def silver_missing_columns(spark, sf_dir):
    few = bindings.bronze(spark, sf_dir, "observations").select("PATIENT", "DATE", "CODE")
    return normalize("observations", few)


def _flawed_bronze(spark, sf_dir) -> quality.Layer:
    """Conditions without codes, no procedure rows, no care plans."""
    layer: quality.Layer = dict(bindings.bronze_tables(spark, sf_dir))
    layer["conditions"] = layer["conditions"].drop("CODE")
    layer["procedures"] = layer["procedures"].where(F.col("CODE").isNull())
    layer["careplans"] = None
    return layer


def bronze_contract_check(spark, sf_dir):
    checks = quality.table_checks(
        spark, _flawed_bronze(spark, sf_dir), CORE_TABLES, (), quality.BRONZE
    )
    return checks.select(
        "table_name",
        "required",
        "exists",
        "row_count",
        "column_count",
        F.array_join("missing_columns", ",").alias("missing_columns"),
        "status",
    )


def bronze_verdict(spark, sf_dir):
    found = quality.bronze_quality(spark, _flawed_bronze(spark, sf_dir), CORE_TABLES)["verdict"]
    lists = (
        "missing_required_tables",
        "empty_required_tables",
        "tables_missing_columns",
        "failed_patient_reference_tables",
    )
    return found.select(
        "required_table_count",
        "optional_table_count_present",
        "missing_required_table_count",
        "empty_required_table_count",
        "tables_missing_columns_count",
        "failed_patient_reference_table_count",
        *[F.array_join(c, ",").alias(c) for c in lists],
        "structural_checks_passed",
    )


def silver_contract_check(spark, sf_dir):
    layer = bindings.silver_tables(spark, sf_dir)
    layer["patients"] = layer["patients"].withColumn(
        "birth_date", F.col("birth_date").cast("string")
    )
    checks = quality.table_checks(spark, layer, CORE_TABLES, (), quality.SILVER)
    return checks.select(
        "table_name", "row_count", "status", F.inline("date_column_checks")
    ).select(
        "table_name",
        F.col("column").alias("column_name"),
        "is_date",
        "row_count",
        "null_count",
        "status",
    )


def silver_contract_measured(spark, sf_dir):
    """The contract checks of the typed layer, counted while its tables are written, not by scans."""
    layer = bindings.silver_tables(spark, sf_dir)
    layer["patients"] = layer["patients"].withColumn("birth_date", F.col("birth_date").cast("string"))
    root, measured, written = layers.scratch_dir(spark, "measured"), {}, {}
    for table, frame in layer.items():
        _, measured[table] = layers.write_measured(frame, root, table, quality.measures(table, frame, quality.SILVER))
        written[table] = layers.read_table(spark, root, table)
    checks = quality.table_checks(spark, written, CORE_TABLES, (), quality.SILVER, measured)
    return checks.select("table_name", "row_count", "status", F.inline("date_column_checks")).select(
        "table_name", F.col("column").alias("column_name"), "is_date", "row_count", "null_count", "status"
    )


def study_resume(spark, sf_dir):
    """Raw files to index cohort three times, the third time with other conditions: what each run did
    with each stage, and the rows of the cohort after it."""
    root = layers.scratch_dir(spark, "resume")
    tables = ("patients", "encounters", "conditions")
    frames = bindings.bronze_tables(spark, sf_dir, tables)
    scenario = Scenario(
        "resume", "Resume", f"{root}/raw", f"{root}/bronze", f"{root}/silver", f"{root}/gold", f"{root}/reports",
        required_files=tuple(f"{t}.csv" for t in tables), optional_files=(),
    )
    parts = []
    for run in (1, 2, 3):
        if run == 3:
            frames = {"conditions": frames["conditions"].where("CODE <> 'Brand#10'")}
        for table, frame in frames.items() if run != 2 else ():
            layers.write_csv(frame, f"{scenario.raw_dir}/{table}.csv")
        ledger = Ledger(spark, f"{scenario.report_dir}/stages", reuse=True)
        inventory = raw_csv.raw_inventory(spark, scenario.raw_dir, scenario.required_files)
        study.convert_changed(spark, scenario, inventory, ledger)
        study.normalize_changed(spark, scenario, ledger)
        found = ledger.stage(
            "index_cohort", [f"silver_{t}" for t in tables], None,
            lambda: {"cohort": study.build_index_cohort(spark, scenario.silver_dir, scenario.gold_dir, BOUND_STUDY)[0]},
            {"cohort": layers.table_path(scenario.gold_dir, study.INDEX_TABLE)},
        )
        rows, excluded = found["cohort"].agg(
            F.count(F.lit(1)), F.count_if("has_prior_t1dm_before_index")
        ).first()
        parts.append(
            ledger.report().select(
                F.lit(run).alias("run"), "stage", "status", F.lit(rows).cast("bigint").alias("cohort_rows"),
                F.lit(excluded).cast("bigint").alias("with_prior"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def silver_verdict(spark, sf_dir):
    found = quality.silver_quality(spark, bindings.silver_tables(spark, sf_dir), CORE_TABLES)
    return found["verdict"].select(
        "required_table_count",
        "missing_required_table_count",
        "empty_required_table_count",
        "tables_missing_columns_count",
        "tables_with_invalid_date_dtypes_count",
        "failed_patient_reference_table_count",
        "structural_checks_passed",
    )


def patient_reference_check(spark, sf_dir):
    layer = bindings.reference_layer(spark, sf_dir)
    return quality.reference_checks(
        spark, layer, [t for t in CORE_TABLES if t != "patients"], quality.SILVER
    )


def target_signal(spark, sf_dir):
    conditions = bindings.silver(spark, sf_dir, "conditions")
    return quality.target_signal(spark, conditions, quality.SILVER, BOUND_STUDY.target_code)


def bronze_target_signal(spark, sf_dir):
    conditions = bindings.bronze(spark, sf_dir, "conditions")
    return quality.target_signal(
        spark, conditions, quality.BRONZE, BOUND_STUDY.window_exclusion_code
    )


# --- cohort ----------------------------------------------------------------------------------


def first_event_per_patient(spark, sf_dir):
    conditions = bindings.silver(spark, sf_dir, "conditions")
    return cohorts.first_event_per_patient(conditions, BOUND_STUDY.target_code)


def first_observed(spark, sf_dir):
    return cohorts.first_observed(bindings.silver(spark, sf_dir, "encounters"))


def _exclusion(code, flag, first_date, row_count, include_index_date) -> Query:
    def query(spark, sf_dir):
        conditions = bindings.silver(spark, sf_dir, "conditions")
        index = cohorts.first_event_per_patient(conditions, BOUND_STUDY.target_code)
        return cohorts.exclusion_flags(
            conditions,
            index.select("patient_id", "index_date"),
            code,
            flag,
            first_date,
            row_count,
            include_index_date,
        )

    return query


def _encounter_days(spark, sf_dir):
    return cohorts.rows_per_day(
        bindings.silver(spark, sf_dir, "encounters"), "encounter_start_date"
    )


def age_at_event(spark, sf_dir):
    patients = bindings.silver(spark, sf_dir, "patients").select("patient_id", "birth_date")
    return _encounter_days(spark, sf_dir).join(patients, "patient_id", "left").select(
        "patient_id",
        "encounter_start_date",
        "birth_date",
        completed_years(F.col("birth_date"), F.col("encounter_start_date")).alias("age"),
        F.col("row_count").alias("encounters"),
    )


def history_days(spark, sf_dir):
    first = cohorts.first_observed(bindings.silver(spark, sf_dir, "encounters"))
    return _encounter_days(spark, sf_dir).join(first, "patient_id").select(
        "patient_id",
        "encounter_start_date",
        days_between(F.col("first_observed_date"), F.col("encounter_start_date")).alias(
            "history_days"
        ),
        F.col("row_count").alias("encounters"),
    )


def _ruled(spark, sf_dir):
    """The index cohort of the study with many rules, one row per patient, and the rules it meets."""
    patients, conditions, encounters = _three(spark, sf_dir)
    cohort = cohorts.index_cohort(patients, conditions, encounters, MANY_CODES_STUDY).distinct()
    cohort = layers.materialize(cohort, "index_cohort")
    return cohort, rules.rule_flags(conditions, cohort, MANY_CODES_STUDY.rules)


def rule_flags(spark, sf_dir):
    return _ruled(spark, sf_dir)[1]


def ruled_cohort(spark, sf_dir):
    cohort, flags = _ruled(spark, sf_dir)
    found = rules.with_rules(cohort, flags, MANY_CODES_STUDY.rules)
    kept = ["patient_id", "index_date", "index_condition_code", "meets_final_phase1_rules", "meets_all_rules"]
    return found.select(*kept, *[c for r in MANY_CODES_STUDY.rules for c in (f"has_{r.rule_id}", f"{r.rule_id}_row_count")])


def index_summary(spark, sf_dir, spec=BOUND_STUDY):
    patients, conditions, encounters = _three(spark, sf_dir)
    cohort = cohorts.index_cohort(patients, conditions, encounters, spec)
    return funnel.index_summary(patients, conditions, encounters, cohort, spec)


def attrition(spark, sf_dir):
    return funnel.attrition(
        bindings.silver(spark, sf_dir, "patients"), index_cohort(spark, sf_dir), BOUND_STUDY
    )


def written_records(spark, sf_dir):
    """What readers of written outputs rely on: the index cohort's rows stand in report order within and
    across its files, and every line of a manifest carries kind, run and a UTC time."""
    root = layers.scratch_dir(spark, "written")
    cohort = layers.materialize(index_cohort(spark, sf_dir), "index_cohort")
    layers.write_table(cohorts.report_order(cohort), root, "cohort")
    steps = funnel.attrition(bindings.silver(spark, sf_dir, "patients"), cohort, BOUND_STUDY)
    layers.write_manifest(steps, f"{root}/attrition", "attrition", {"scenario_id": "bound"})

    file, place = F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("place")
    # Null dates and patients come first, as the order has them.
    key = F.struct(
        F.col("index_date").isNotNull(), "index_date", F.col("patient_id").isNotNull(), "patient_id"
    ).alias("key")
    rows = layers.read_table(spark, root, "cohort").select(file, place, key)
    before = F.lag("key").over(Window.partitionBy("file").orderBy("place"))
    per_file = rows.withColumn("wrong", F.coalesce(before > F.col("key"), F.lit(False))).groupBy("file").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("wrong").alias("wrong"), F.min("key").alias("low"), F.max("key").alias("high")
    )
    # A row per file: the files follow each other by name.
    last = F.lag("high").over(Window.orderBy("file"))
    order = per_file.withColumn("wrong", F.col("wrong") + F.coalesce(last > F.col("low"), F.lit(False)).cast("int")).agg(
        F.lit("index_cohort").alias("output"), F.sum("n").alias("row_count"), F.sum("wrong").alias("wrong")
    )
    line = F.from_json("value", "manifest_type string, generated_at_utc string, provenance struct<scenario_id:string>")
    told = spark.read.text(f"{root}/attrition").select(line.alias("x"))
    good = (
        (F.col("x.manifest_type") == "attrition")
        & (F.col("x.provenance.scenario_id") == "bound")
        & F.col("x.generated_at_utc").rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\+00:00$")
    )
    lines = told.agg(
        F.lit("attrition manifest").alias("output"), F.count(F.lit(1)).alias("row_count"), F.count_if(~F.coalesce(good, F.lit(False))).alias("wrong")
    )
    return order.unionByName(lines)


def final_age_stats(spark, sf_dir):
    return funnel.final_summary(index_cohort(spark, sf_dir))


def numeric_summary(spark, sf_dir):
    stats = summary.numeric_statistics(index_cohort(spark, sf_dir), summary.NUMERIC)
    return stats.withColumns({c: F.round(c, 6) for c in ("mean", "sd")})


def categorical_summary(spark, sf_dir):
    cohort = layers.materialize(index_cohort(spark, sf_dir), "index_cohort")
    rows = summary.categorical_rows(cohort, summary.CATEGORICAL, summary.patient_total(cohort))
    return rows.select(
        "section",
        "variable",
        "level",
        "n",
        "denominator",
        (F.col("row_order") % summary.ROWS_PER_VARIABLE).cast("bigint").alias("level_order"),
        "percent",
    )


def baseline_table(spark, sf_dir):
    return summary.baseline_characteristics(layers.materialize(_final(spark, sf_dir), "final"))


def _csv_of(frame: DataFrame) -> DataFrame:
    return frame.select(*[F.col(c).cast("string").alias(c) for c in frame.columns])


def bronze_cells(spark, sf_dir):
    """Every cell of three tables with quotes, line breaks and long texts, after a round trip
    through CSV files and the conversion."""
    raw_dir = _write_raw(
        {t: _csv_of(bindings.source(spark, sf_dir, t)) for t in CELL_TABLES}, spark
    )
    bronze_dir = layers.scratch_dir(spark, "bronze")
    raw_csv.raw_to_bronze(spark, raw_dir, bronze_dir).collect()
    parts = []
    for table, columns in CELL_TABLES.items():
        frame = layers.read_table(spark, bronze_dir, table)
        width = max(map(len, CELL_TABLES.values()))
        cells = [F.col(c) for c in columns] + [F.lit(None).cast("string")] * (width - len(columns))
        parts.append(
            frame.select(
                F.lit(table).alias("table_name"), *[c.alias(f"cell_{i}") for i, c in enumerate(cells)]
            )
        )
    return reduce(DataFrame.unionByName, parts)


def bronze_expected_only(spark, sf_dir):
    """Conversion of the expected files only, one of them absent and one without a header."""
    frames = {t: _csv_of(bindings.source(spark, sf_dir, t)) for t in ("nation", "region", "supplier")}
    raw_dir = _write_raw(frames, spark)
    spark.range(0).select(F.lit("").alias("value")).repartition(1).write.text(f"{raw_dir}/part.csv")
    found = raw_csv.raw_to_bronze(
        spark, raw_dir, layers.scratch_dir(spark, "bronze"),
        ["nation.csv", "supplier.csv", "part.csv", "absent.csv"],
    )
    return found.select("table_name", "row_count", "column_count", "status")


def raw_inventory_blank_lines(spark, sf_dir):
    """Record counts of files in which blank lines stand between the records, with and without a
    record that spans lines."""
    orders = bindings.source(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"))
    raw_dir = layers.scratch_dir(spark, "raw")
    for name, note in (("plain", "'n'"), ("spanning", "'\"two' || chr(10) || chr(10) || 'lines\"'")):
        line = f"CAST(k AS STRING) || ',' || {note} || IF(k % 3 = 0, chr(10), '')"
        # Part files by ranges of the key, a header before the first record of each.
        dealt = orders.repartitionByRange(BLANK_LINE_PARTS, "k").sortWithinPartitions("k")
        first = "(monotonically_increasing_id() & 8589934591) = 0"
        lines = dealt.selectExpr(f"IF({first}, 'key,note' || chr(10), '') || {line} AS value")
        lines.write.text(f"{raw_dir}/{name}.csv")
    found = raw_csv.raw_inventory(spark, raw_dir, ["plain.csv", "spanning.csv"])
    return found.select("filename", "row_count", F.array_join("header", ",").alias("header"), "status")


def study_outputs(spark, sf_dir):
    """The whole study run on raw files made of the given tables: rows of every output, and a
    value of each that stands for its content."""
    root = layers.scratch_dir(spark, "study")
    raw_dir = _write_packed(spark, sf_dir)
    scenario = Scenario(
        "bound", "Bound tables", raw_dir, f"{root}/bronze", f"{root}/silver", f"{root}/gold",
        f"{root}/reports", reference_date=REFERENCE_DATE,
    )
    sets = {**bindings.study_concepts(FOLLOWUP_CONCEPTS, MEDICATION_USES),
            **bindings.study_concepts(LAB_CONCEPTS, LAB_USES)}
    out = study.run_study(spark, scenario, BOUND_STUDY, sets)
    parts = [
        out[table].agg(
            F.lit(table).alias("output"),
            F.count(F.lit(1)).alias("row_count"),
            F.coalesce(F.round(F.sum(F.expr(value).cast("double")), 4), F.lit(0.0)).alias("value"),
        )
        for table, value in STUDY_VALUES.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def end_to_end(spark, sf_dir):
    """Raw text -> typed tables -> cohort -> funnel in one plan."""
    patients, conditions, encounters = (
        normalize(t, bindings.bronze(spark, sf_dir, t))
        for t in ("patients", "conditions", "encounters")
    )
    cohort = cohorts.index_cohort(patients, conditions, encounters, BOUND_STUDY)
    return funnel.attrition(patients, cohort, BOUND_STUDY)


# --- beyond the baseline report --------------------------------------------------------------


def _kept_final(spark, sf_dir):
    """The final cohort written out, and the encounters of its patients."""
    final = layers.materialize(_final(spark, sf_dir), "final")
    (seen,) = cohorts.of_patients(final, bindings.silver(spark, sf_dir, "encounters"))
    return final, seen


def _windows(spark, sf_dir):
    return followup.followup_window(*_kept_final(spark, sf_dir), BOUND_STUDY)


def _kept_windows(spark, sf_dir):
    """Follow-up windows written out, for summaries that read them more than once."""
    return layers.materialize(_windows(spark, sf_dir), "windows")


def concept_signal(spark, sf_dir):
    return followup.concept_signal(
        bindings.silver(spark, sf_dir, "medications"),
        "medication_start_date",
        FOLLOWUP_CONCEPTS,
    )


def date_parse_check(spark, sf_dir):
    return followup.date_parse_check(bindings.bronze_tables(spark, sf_dir))


def future_date_check(spark, sf_dir):
    return followup.future_date_check(
        bindings.silver_tables(spark, sf_dir), SILVER_DATES, REFERENCE_DATE
    )


def baseline_window(spark, sf_dir):
    return followup.baseline_window(*_kept_final(spark, sf_dir), BOUND_STUDY)


def pregnancy_followup(spark, sf_dir):
    windows = _kept_windows(spark, sf_dir)
    (conditions,) = cohorts.of_patients(windows, bindings.silver(spark, sf_dir, "conditions"))
    return cohorts.exclusion_flags(
        conditions,
        windows.select("patient_id", "index_date", "follow_up_end"),
        BOUND_STUDY.window_exclusion_code,
        "has_event_in_window",
        "first_date",
        "row_count",
        include_index_date=True,
        earliest=F.date_sub("index_date", BOUND_STUDY.baseline_days),
        latest=F.col("follow_up_end"),
    )


def medication_exposure(spark, sf_dir, limit=None):
    return followup.medication_exposure(
        bindings.silver(spark, sf_dir, "medications"),
        _kept_windows(spark, sf_dir),
        FOLLOWUP_CONCEPTS,
        limit,
    )


def utilization(spark, sf_dir, limit=None):
    return followup.utilization(
        bindings.silver(spark, sf_dir, "encounters"), _kept_windows(spark, sf_dir), limit
    )


def _patient_costs(spark, sf_dir, limit=None):
    costs = {
        table: (bindings.silver(spark, sf_dir, table), day, cost)
        for table, day, cost in (
            ("encounters", "encounter_start_date", "total_claim_cost"),
            ("medications", "medication_start_date", "total_cost"),
            ("procedures", "procedure_start_date", "base_cost"),
        )
    }
    return followup.patient_costs(costs, _kept_windows(spark, sf_dir), limit)


def _rounded_costs(per_patient, digits):
    """Sums of doubles differ in their last bits with the order of rows: rounded to be compared."""
    found = followup.cost_summary(layers.materialize(per_patient, "costs"))
    rounded = ("total", "mean", "sd", "min", "q1", "median", "q3", "max")
    return found.withColumns({c: F.round(c, digits) for c in rounded})


def cost_summary(spark, sf_dir, limit=None):
    return _rounded_costs(_patient_costs(spark, sf_dir, limit), 5)


def cost_extremes(spark, sf_dir):
    """The costs of a lifetime per customer, with amounts of every size and raw text that holds no
    finite number: half cents, 1e17, 1e400."""
    windows = bindings.source(spark, sf_dir, "customer").selectExpr(
        "CAST(c_custkey AS STRING) AS patient_id", "DATE'1900-01-01' AS index_date",
        "DATE'2100-01-01' AS follow_up_end",
    )
    orders = bindings.source(spark, sf_dir, "orders").selectExpr(
        "CAST(o_custkey AS STRING) AS patient_id", "to_date(o_orderdate) AS day",
        f"{bindings.EXTREME_AMOUNT} AS amount",
    )
    typed = orders.withColumn("amount", lenient_double(F.col("amount")))
    costs = {"large": (typed, "day", "amount"), "small": (typed.where("amount < 1000"), "day", "amount")}
    found = followup.cost_summary(
        layers.materialize(followup.patient_costs(costs, layers.materialize(windows, "windows")), "costs")
    )
    # Twelve digits: amounts from half a cent to 1e17 stand in one table.
    numbers = ("total", "mean", "sd", "min", "q1", "median", "q3", "max")
    return found.select("kind", "patients", *[_digits(F.col(c)).alias(c) for c in numbers])


def _digits(value):
    """A number with nine significant digits, as text."""
    return F.format_string("%.8e", value)


def quantiles_many_groups(spark, sf_dir):
    """Quartiles of the order totals of every customer: as many groups as customers."""
    orders = bindings.source(spark, sf_dir, "orders").select("o_custkey", "o_totalprice")
    found = exact_quantiles(orders, "o_custkey", "o_totalprice", followup.QUARTILES)
    return found.withColumns({c: F.round(c, 4) for c in followup.QUARTILES})


def _lab_rows(spark, sf_dir, limit=None):
    rows = followup.lab_rows(
        bindings.silver(spark, sf_dir, "labs"), _kept_windows(spark, sf_dir), LAB_CONCEPTS, limit
    )
    return layers.materialize(rows, "lab_rows")


def lab_summary(spark, sf_dir, limit=None):
    rows = _lab_rows(spark, sf_dir, limit)
    return followup.lab_report(rows).withColumns(
        {c: F.round(c, 6) for c in ("mean", "q1", "median", "q3")}
    )


def lab_trajectory(spark, sf_dir):
    steps = followup.lab_trajectory(_lab_rows(spark, sf_dir))
    return steps.withColumns({c: F.round(c, 6) for c in ("mean", "sd")})


def lab_extremes(spark, sf_dir):
    """Mean and spread of results that are tiny, or large and close together."""
    rows = bindings.source(spark, sf_dir, "events").selectExpr(
        "event_type AS concept_set", "CAST(user_id AS STRING) AS patient_id",
        f"{bindings.EXTREME_RESULT} AS value_numeric", "CAST(1 AS BIGINT) AS results",
        "CAST(event_id % 400 AS BIGINT) AS day", "TRUE AS before_end",
    )
    steps = followup.lab_trajectory(layers.materialize(rows, "lab_extremes"))
    return steps.select(
        "concept_set", "step", "results", _digits(F.col("mean")).alias("mean"),
        F.format_string("%.3e", "sd").alias("sd"),
    )


def survival_table(spark, sf_dir):
    table = followup.survival_table(_windows(spark, sf_dir))
    return table.withColumn("survival", F.round("survival", 9))


def events_in_windows(spark, sf_dir):
    """Encounters and their costs around every day with a target event of a patient: windows that
    overlap, of three lengths."""
    conditions = bindings.silver(spark, sf_dir, "conditions")
    day = F.col("condition_start_date")
    targets = conditions.where((F.col("code") == BOUND_STUDY.target_code) & day.isNotNull())
    around = [("before", -30, -1), ("after", 0, 90), ("around", -365, 365)]
    kinds = F.array(*[
        F.struct(F.lit(n).alias("kind"), F.date_add(day, a).alias("window_start"), F.date_add(day, b).alias("window_end"))
        for n, a, b in around
    ])
    windows = targets.select("patient_id", day).distinct().select("patient_id", F.inline(kinds))
    encounters = bindings.silver(spark, sf_dir, "encounters")
    found = intervals.events_in_windows(
        encounters, "encounter_start_date", layers.materialize(windows, "windows"), cost=F.col("total_claim_cost")
    )
    return found.withColumn("cost", F.round("cost", 2))


def recurrent_index(spark, sf_dir):
    wanted = F.col("code") == BOUND_STUDY.target_code
    conditions = bindings.silver(spark, sf_dir, "conditions").where(wanted)
    days = layers.materialize(conditions.select("patient_id", "code", "condition_start_date"), "wanted-days")
    return intervals.recurrent_index(days, wanted, "condition_start_date", RECURRENCE_DAYS)


def _era_query(name: str) -> Query:
    table, code, start, end, _ = intervals.ERAS[name]

    def query(spark, sf_dir):
        spans = bindings.silver(spark, sf_dir, table).select("patient_id", *([code] if code else []), start, end)
        with layers.small_tasks(spans):
            spans = layers.materialize(spans, "era-spans")
        return intervals.era_table(name, spans)

    return query


def _lab_values(spark, sf_dir) -> DataFrame:
    labs = bindings.silver(spark, sf_dir, "labs").where("value_numeric IS NOT NULL")
    return followup.coded_events(labs, LAB_CONCEPTS).select(
        "concept_set", "patient_id", "observation_date", "value_numeric"
    )


def _per_lab(points: DataFrame) -> DataFrame:
    """The points once for each laboratory concept set."""
    names = F.array(*[F.lit(n) for n in LAB_CONCEPTS])
    return points.select("*", F.explode(names).alias("concept_set"))


def lab_nearest_index(spark, sf_dir):
    """The result nearest to the index date of each patient of the final cohort."""
    points = _per_lab(_kept_windows(spark, sf_dir).select("patient_id", "index_date"))
    return intervals.values_at(
        _lab_values(spark, sf_dir), points, ["patient_id", "concept_set"], "observation_date", "value_numeric",
        "index_date", nearest=True,
    )


def lab_carried_forward(spark, sf_dir):
    """Results carried forward to the index date and every 90 days of follow-up: per step the patients
    with a value, their mean, and how old the values are."""
    points = _per_lab(intervals.step_points(_kept_windows(spark, sf_dir)))
    found = intervals.values_at(
        _lab_values(spark, sf_dir), points, ["patient_id", "concept_set"], "observation_date", "value_numeric", "point_day"
    )
    return found.groupBy("concept_set", "step").agg(
        F.count(F.lit(1)).alias("patients"),
        F.count("value").alias("with_value"),
        F.round(F.avg("value"), 6).alias("mean"),
        F.round(F.avg(F.datediff("point_day", "value_day")), 6).alias("mean_age_days"),
    )


def _stratified(spark, sf_dir) -> DataFrame:
    """Follow-up windows with the patient's sex as a clean level."""
    final, seen = _kept_final(spark, sf_dir)
    sex = final.groupBy("patient_id").agg(F.min("sex").alias("sex"))
    windows = followup.followup_window(final, seen, BOUND_STUDY).join(sex, "patient_id")
    return layers.materialize(windows.withColumn("sex", clean_level(F.col("sex"))), "strata")


def survival_by_stratum(spark, sf_dir):
    found = survival.survival_by_stratum(_stratified(spark, sf_dir), "sex")
    return found.withColumns({c: F.round(c, 9) for c in ("survival", "standard_error")})


def log_rank(spark, sf_dir):
    found = survival.log_rank(_stratified(spark, sf_dir), "sex")
    return found.withColumns({c: F.round(c, 6) for c in ("expected", "variance", "chi_square")})


def common_model(spark, sf_dir):
    """Row counts, persons and date range of every common-model table."""
    tables = followup.common_model(bindings.silver_tables(spark, sf_dir))
    day = {
        "person": "birth_date",
        "visit_occurrence": "visit_start_date",
        "condition_occurrence": "condition_start_date",
        "drug_exposure": "drug_exposure_start_date",
        "measurement": "measurement_date",
        "procedure_occurrence": "procedure_date",
    }
    return followup.model_profile(tables, day)


def _model_query(target: str) -> Query:
    source, _ = followup.COMMON_MODEL[target]
    return lambda spark, sf_dir: followup.common_model_table(
        target, bindings.silver(spark, sf_dir, source)
    )


def queries() -> dict[str, Query]:
    registered: dict[str, Query] = {
        "bronze_csv_roundtrip": bronze_csv_roundtrip,
        "raw_inventory": raw_inventory,
        "raw_file_hash": raw_file_hash,
        "partitioned_rewrite": partitioned_rewrite,
        "clustered_reads": clustered_reads,
    }
    for table in CORE_TABLES:
        registered[f"silver_{table}"] = _silver_query(table)
    registered.update(
        {
            "silver_missing_columns": silver_missing_columns,
            "bronze_contract_check": bronze_contract_check,
            "bronze_verdict": bronze_verdict,
            "silver_contract_check": silver_contract_check,
            "silver_contract_measured": silver_contract_measured,
            "study_resume": study_resume,
            "silver_verdict": silver_verdict,
            "patient_reference_check": patient_reference_check,
            "target_signal": target_signal,
            "bronze_target_signal": bronze_target_signal,
            "first_event_per_patient": first_event_per_patient,
            "first_observed": first_observed,
            "exclusion_strict": _exclusion(
                BOUND_STUDY.prior_exclusion_code,
                "has_prior_t1dm_before_index",
                "first_prior_t1dm_date",
                "prior_t1dm_row_count",
                False,
            ),
            "exclusion_inclusive": _exclusion(
                BOUND_STUDY.window_exclusion_code,
                "has_pregnancy_window_before_or_at_index",
                "first_pregnancy_window_date",
                "pregnancy_window_row_count",
                True,
            ),
            "age_at_event": age_at_event,
            "history_days": history_days,
            "index_cohort": index_cohort,
            "index_cohort_codes": lambda spark, sf_dir: index_cohort(spark, sf_dir, MANY_CODES_STUDY),
            "live_cohort": live_cohort,
            "rule_flags": rule_flags,
            "ruled_cohort": ruled_cohort,
            "index_summary": index_summary,
            "attrition": attrition,
            "final_cohort": _final,
            "written_records": written_records,
            "final_age_stats": final_age_stats,
            "numeric_summary": numeric_summary,
            "categorical_summary": categorical_summary,
            "baseline_table": baseline_table,
            "study_parameters": lambda spark, sf_dir: index_summary(spark, sf_dir, OTHER_STUDY),
            "end_to_end": end_to_end,
            "concept_signal": concept_signal,
            "date_parse_check": date_parse_check,
            "future_date_check": future_date_check,
            "followup_window": _windows,
            "baseline_window": baseline_window,
            "pregnancy_followup": pregnancy_followup,
            "medication_exposure": medication_exposure,
            "utilization": utilization,
            "cost_summary": cost_summary,
            "lab_summary": lab_summary,
            "lab_trajectory": lab_trajectory,
            "survival_table": survival_table,
            "events_in_windows": events_in_windows,
            "recurrent_index": recurrent_index,
            "lab_nearest_index": lab_nearest_index,
            "lab_carried_forward": lab_carried_forward,
            "survival_by_stratum": survival_by_stratum,
            "log_rank": log_rank,
            "common_model": common_model,
            "index_cohort_staged": index_cohort_staged,
            "index_cohort_staged_large": lambda spark, sf_dir: index_cohort_staged(spark, sf_dir, 0),
            "medication_exposure_large": lambda spark, sf_dir: medication_exposure(spark, sf_dir, 0),
            "utilization_large": lambda spark, sf_dir: utilization(spark, sf_dir, 0),
            "cost_summary_large": lambda spark, sf_dir: cost_summary(spark, sf_dir, 0),
            "lab_summary_large": lambda spark, sf_dir: lab_summary(spark, sf_dir, 0),
            "bronze_cells": bronze_cells,
            "bronze_expected_only": bronze_expected_only,
            "raw_inventory_blank_lines": raw_inventory_blank_lines,
            "study_outputs": study_outputs,
            "cost_extremes": cost_extremes,
            "lab_extremes": lab_extremes,
            "quantiles_many_groups": quantiles_many_groups,
        }
    )
    for name in intervals.ERAS:
        registered[name] = _era_query(name)
    for target in followup.COMMON_MODEL:
        registered[f"common_model_{MODEL_KEYS[target]}"] = _model_query(target)
    return registered
