"""The whole study over layer folders: raw CSV -> bronze -> silver -> cohort -> reports.

Every stage reads what the stage before wrote, so a lost executor or a restart never repeats
more than one stage, and no plan grows across stages.
"""

from __future__ import annotations

from dataclasses import asdict
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expr import clean_level
from ..operators import cohort as cohorts
from ..operators import followup, funnel, intervals, quality, rules, summary, survival
from ..operators.normalize import normalize
from ..sources import layers, raw_csv
from ..spec import (
    CONCEPT_SETS,
    CORE_TABLES,
    LAB_USES,
    MEDICATION_USES,
    SILVER_DATES,
    Scenario,
    StudySpec,
    concept_version,
    sets_for,
    table_names,
)
from .ledger import Ledger

NORMALIZATION_SCHEMA = (
    "table_name string, bronze_path string, silver_path string, input_row_count bigint, "
    "output_row_count bigint, input_column_count int, output_column_count int, "
    "output_columns array<string>, status string, error string, measures map<string,bigint>"
)

INDEX_TABLE = "t2dm_index_cohort"
ATTRITION_TABLE = "t2dm_attrition"
FINAL_TABLE = "t2dm_final_cohort"
BASELINE_TABLE = "baseline_characteristics"
# Follow-up summaries that are reports too: a few rows each.
REPORTED = (
    "medication_exposure", "lab_summary", "lab_trajectory", "utilization", "cost_summary",
    "survival_table", "survival_by_sex", "log_rank_by_sex",
)


def bronze_to_silver(
    spark: SparkSession, bronze_dir: str, silver_dir: str, tables=()
) -> DataFrame:
    """Normalise the given tables (default: all seven). One row per table: normalized, missing,
    or failed; a failure does not stop the others. `measures` are what the checks count in a table,
    taken while it was written."""
    def one(table):
        source = layers.table_path(bronze_dir, table)
        if not layers.table_exists(bronze_dir, table):
            return (table, source, None, None, None, None, None, None, "missing", None, None)
        try:
            return _normalize_table(spark, bronze_dir, silver_dir, table)
        except Exception as error:  # isolated on purpose: reported as this table's status
            return (table, source, None, None, None, None, None, None, "failed", str(error), None)

    rows = layers.side_by_side([partial(one, table) for table in tables or CORE_TABLES])
    return spark.createDataFrame(rows, NORMALIZATION_SCHEMA)


def _normalize_table(spark, bronze_dir, silver_dir, table) -> tuple:
    exact = layers.exact_names(spark)
    # A task sorts what it reads.
    exact.conf.set("spark.sql.files.maxPartitionBytes", str(layers.TASK_BYTES))
    raw = layers.read_table(exact, bronze_dir, table)
    typed = normalize(table, raw)
    if "code" in typed.columns:
        # Sorted inside each file (no shuffle), a filter on a few codes skips most Parquet pages.
        typed = typed.sortWithinPartitions("code", "patient_id")
    wanted = quality.measures(table, typed, quality.SILVER)
    path, seen = layers.write_measured(typed, silver_dir, table, wanted)
    # A projection: the rows that were read are those that were written.
    return (
        table, layers.table_path(bronze_dir, table), path, seen["row_count"], seen["row_count"],
        len(raw.columns), len(typed.columns), typed.columns, "normalized", None, seen,
    )


def measured_tables(records: DataFrame) -> dict[str, dict]:
    """Table -> what was measured as it was written, from normalisation or conversion records."""
    if "measures" in records.columns:
        return {r.table_name: r.measures for r in records.where("status = 'normalized'").collect()}
    return {r.table_name: {"row_count": r.row_count} for r in records.where("status = 'converted'").collect()}


def normalization_summary(records: DataFrame) -> DataFrame:
    status = F.col("status")
    return records.agg(
        F.count(F.lit(1)).alias("requested_table_count"),
        F.count_if(status == "normalized").alias("normalized_count"),
        F.count_if(status == "missing").alias("missing_count"),
        F.count_if(status == "failed").alias("failed_count"),
        F.bool_and(status == "normalized").alias("all_normalized"),
    )


def build_index_cohort(
    spark: SparkSession, silver_dir: str, gold_dir: str, spec: StudySpec
) -> tuple[DataFrame, DataFrame]:
    """Write the index cohort; returns it and its one-row summary."""
    hint = "Run bronze_to_silver first."
    patients, conditions, encounters = (
        layers.need_table(spark, silver_dir, t, hint)
        for t in ("patients", "conditions", "encounters")
    )
    built = cohorts.index_cohort(
        patients,
        conditions,
        encounters,
        spec,
        stage=lambda events: layers.materialize(events, "index_events"),
    )
    layers.write_table(cohorts.report_order(built), gold_dir, INDEX_TABLE)
    written = layers.read_table(spark, gold_dir, INDEX_TABLE)
    return written, funnel.index_summary(patients, conditions, encounters, written, spec)


def build_attrition(
    spark: SparkSession, silver_dir: str, gold_dir: str, spec: StudySpec, csv_path=None
) -> DataFrame:
    patients = layers.need_table(spark, silver_dir, "patients", "Run bronze_to_silver first.")
    index = layers.need_table(spark, gold_dir, INDEX_TABLE, "Run build_index_cohort first.")
    steps = layers.in_report_order(
        funnel.attrition(patients, index, spec), "step_number", keep=True
    )
    return _write_report(spark, steps, gold_dir, ATTRITION_TABLE, csv_path)


def build_final_cohort(
    spark: SparkSession, gold_dir: str, csv_path=None
) -> tuple[DataFrame, DataFrame]:
    """Write the eligible cohort; returns it and its one-row summary."""
    index = layers.need_table(spark, gold_dir, INDEX_TABLE, "Run build_index_cohort first.")
    layers.write_table(cohorts.report_order(cohorts.final_cohort(index)), gold_dir, FINAL_TABLE)
    written = layers.read_table(spark, gold_dir, FINAL_TABLE)
    if csv_path:
        layers.write_csv(cohorts.report_order(written), csv_path)
    return written, funnel.final_summary(index)


def build_baseline(spark: SparkSession, gold_dir: str, csv_path=None) -> DataFrame:
    final = layers.need_table(spark, gold_dir, FINAL_TABLE, "Run build_final_cohort first.")
    report = layers.in_report_order(summary.baseline_characteristics(final), "row_order")
    return _write_report(spark, report, gold_dir, BASELINE_TABLE, csv_path)


def build_followup(
    spark: SparkSession,
    silver_dir: str,
    gold_dir: str,
    spec: StudySpec,
    medication_classes: dict,
    lab_sets: dict,
) -> dict[str, DataFrame]:
    """Write the follow-up windows of the final cohort and the summaries over them: exposure by
    medication class, laboratory summary and trajectory, utilisation, cost, survival. Concept sets
    as in `spec.CONCEPT_SETS`."""
    final = layers.need_table(spark, gold_dir, FINAL_TABLE, "Run build_final_cohort first.")
    encounters, medications, observations, procedures = (
        layers.need_table(spark, silver_dir, t, "Run bronze_to_silver first.")
        for t in ("encounters", "medications", "observations", "procedures")
    )

    def written(frame: DataFrame, table: str) -> DataFrame:
        layers.write_table(frame, gold_dir, table)
        return layers.read_table(spark, gold_dir, table)

    (seen,) = cohorts.of_patients(final, encounters)
    windows = written(followup.followup_window(final, seen, spec), "followup_window")
    costs = written(
        followup.patient_costs(
            {
                "encounters": (encounters, "encounter_start_date", "total_claim_cost"),
                "medications": (medications, "medication_start_date", "total_cost"),
                "procedures": (procedures, "procedure_start_date", "base_cost"),
            },
            windows,
        ),
        "patient_costs",
    )
    labs = written(
        followup.lab_rows(observations, windows, lab_sets),
        "lab_rows",
    )
    out = {
        "medication_exposure": followup.medication_exposure(
            medications, windows, medication_classes
        ),
        "lab_summary": followup.lab_report(labs),
        "lab_trajectory": followup.lab_trajectory(labs),
        "utilization": followup.utilization(encounters, windows),
        "cost_summary": followup.cost_summary(costs),
        "survival_table": followup.survival_table(windows),
        **_compared(final, windows),
    }
    return {
        "followup_window": windows,
        **{table: written(frame, table) for table, frame in out.items()},
    }


def _compared(final: DataFrame, windows: DataFrame) -> dict[str, DataFrame]:
    """Survival by the patients' sex, where the cohort tells it."""
    sex = final.groupBy("patient_id").agg(F.min("sex").alias("sex"))
    strata = windows.join(sex, "patient_id").withColumn("sex", clean_level(F.col("sex")))
    return {
        "survival_by_sex": survival.survival_by_stratum(strata, "sex"),
        "log_rank_by_sex": survival.log_rank(strata, "sex"),
    }


def build_common_model(
    spark: SparkSession, silver_dir: str, model_dir: str
) -> dict[str, DataFrame]:
    """Write the common-data-model tables, the eras and periods derived from events among them."""
    silver = {
        t: layers.need_table(spark, silver_dir, t, "Run bronze_to_silver first.")
        for t, _ in followup.COMMON_MODEL.values()
    }
    tables = followup.common_model(silver)
    tables |= {name: intervals.era_table(name, silver[entry[0]]) for name, entry in intervals.ERAS.items()}
    for name, frame in tables.items():
        layers.write_table(frame, model_dir, name)
    return {name: layers.read_table(spark, model_dir, name) for name in tables}


def build_rules(
    spark: SparkSession, silver_dir: str, gold_dir: str, spec: StudySpec
) -> dict[str, DataFrame]:
    """Write the further rules' flags of the index cohort's patients, and the cohort with them."""
    index = layers.need_table(spark, gold_dir, INDEX_TABLE, "Run build_index_cohort first.")
    conditions = layers.need_table(spark, silver_dir, "conditions", "Run bronze_to_silver first.")
    # Copied patient rows have equal anchors: one row per patient is enough for the flags.
    anchors = index.drop(*[c for c in index.columns if not c.endswith("_date") and c != "patient_id"])
    known = layers.materialize(anchors.distinct(), "rule-anchors")
    layers.write_table(rules.rule_flags(conditions, known, spec.rules, limit=cohorts.BROADCAST_BYTES), gold_dir, "rule_flags")
    flags = layers.read_table(spark, gold_dir, "rule_flags")
    layers.write_table(cohorts.report_order(rules.with_rules(index, flags, spec.rules)), gold_dir, "ruled_cohort")
    return {"rule_flags": flags, "ruled_cohort": layers.read_table(spark, gold_dir, "ruled_cohort")}


def _write_report(spark, frame, gold_dir, table, csv_path) -> DataFrame:
    layers.write_table(frame, gold_dir, table)
    written = layers.read_table(spark, gold_dir, table)
    if csv_path:
        layers.write_csv(written, csv_path)
    return written


def build_windows(
    spark: SparkSession, silver_dir: str, gold_dir: str, spec: StudySpec
) -> dict[str, DataFrame]:
    """Write the baseline-window flags of the final cohort, and its patients with an event of the
    window exclusion between the start of the baseline window and the end of follow-up."""
    final = layers.need_table(spark, gold_dir, FINAL_TABLE, "Run build_final_cohort first.")
    windows = layers.need_table(spark, gold_dir, "followup_window", "Run build_followup first.")
    encounters, conditions = (
        layers.need_table(spark, silver_dir, t, "Run bronze_to_silver first.")
        for t in ("encounters", "conditions")
    )
    encounters, conditions = cohorts.of_patients(final, encounters, conditions)
    out = {
        "baseline_window": followup.baseline_window(final, encounters, spec),
        "exclusion_in_followup": cohorts.exclusion_flags(
            conditions,
            windows.select("patient_id", "index_date", "follow_up_end"),
            spec.window_exclusion_code,
            "has_event_in_window",
            "first_date",
            "row_count",
            include_index_date=True,
            earliest=F.date_sub("index_date", spec.baseline_days),
            latest=F.col("follow_up_end"),
        ),
    }
    for table, frame in out.items():
        layers.write_table(frame, gold_dir, table)
    return {table: layers.read_table(spark, gold_dir, table) for table in out}


def run_study(
    spark: SparkSession,
    scenario: Scenario,
    spec: StudySpec = StudySpec(),
    concept_sets: dict = CONCEPT_SETS,
    reuse: bool = False,
) -> dict[str, DataFrame]:
    """All stages in order, each with its manifest under the report folder: inventory, conversion,
    checks, normalisation, cohorts, funnel, baseline report, follow-up summaries, window flags, further
    rules, common data model. Every manifest names the run, and the digest of the concept sets it used.
    What the stages write for their own use is deleted at the end.

    Every stage is recorded with its fingerprint (see `ledger`). With `reuse` a stage whose inputs,
    parameters, code and files are those of its record is not run again: after a cut the run goes on
    where it stopped, after a change of a raw file what depends on it is rerun. `stages` in the result
    and in the manifests says which. Raw files are read for their digests in any case."""
    with layers.scratch(spark), layers.freed_shuffles(spark):
        return _all_stages(spark, scenario, spec, concept_sets, reuse)


def _all_stages(spark, scenario, spec, concept_sets, reuse) -> dict[str, DataFrame]:
    required = table_names(scenario.required_files)
    optional = table_names(scenario.optional_files)
    reports = scenario.report_dir.rstrip("/")
    bronze_dir, silver_dir, gold_dir = scenario.bronze_dir, scenario.silver_dir, scenario.gold_dir
    origin = {
        "scenario_id": scenario.scenario_id,
        "scenario_name": scenario.name,
        "reference_date": scenario.reference_date,
        "concept_sets_version": concept_version(concept_sets),
        **{f"generator_{k}": v for k, v in scenario.generator.items()},
    }
    ledger = Ledger(spark, f"{reports}/stages", reuse)
    rules_of = asdict(spec)

    def manifest(frame: DataFrame, kind: str) -> None:
        layers.write_manifest(frame, f"{reports}/manifests/{kind}", kind, origin)

    def gold(table: str) -> str:
        return layers.table_path(gold_dir, table)

    out: dict[str, DataFrame] = {}
    manifest(followup.concept_frame(spark, concept_sets), "concept_sets")
    inventory = layers.materialize(
        raw_csv.raw_inventory(spark, scenario.raw_dir, scenario.required_files, scenario.optional_files), "inventory"
    )
    manifest(inventory, "raw_inventory")
    manifest(raw_csv.inventory_summary(inventory, scenario.raw_dir), "raw_inventory_summary")
    out["raw_inventory"] = spark.createDataFrame(inventory.collect(), inventory.schema)

    conversion = convert_changed(spark, scenario, inventory, ledger)
    manifest(conversion, "bronze_conversion")
    manifest(raw_csv.conversion_summary(conversion), "bronze_conversion_summary")
    out["bronze_conversion"] = conversion

    of_bronze = [f"bronze_{t}" for t in required + optional if f"bronze_{t}" in ledger.prints]
    bronze = layers.read_present(layers.exact_names(spark), bronze_dir, required + optional)
    checks = ledger.stage(
        "bronze_checks", of_bronze, [required, optional, spec.target_code],
        lambda: quality.bronze_quality(spark, bronze, required, optional, spec.target_code, measured_tables(conversion)),
    )
    for name, frame in checks.items():
        manifest(frame, f"bronze_qa_{name}")
        out[f"bronze_{name}"] = frame

    readable = {t: f for t, f in bronze.items() if f is not None and t in CORE_TABLES}
    if readable:
        found = ledger.stage("bronze_dates", of_bronze, None, lambda: {"dates": followup.date_parse_check(readable)})
        out["date_parse_check"] = found["dates"]
        manifest(out["date_parse_check"], "bronze_qa_dates")

    normalized = normalize_changed(spark, scenario, ledger)
    manifest(normalized, "silver_normalization")
    manifest(normalization_summary(normalized), "silver_normalization_summary")
    out["silver_normalization"] = normalized

    of_silver = [f"silver_{t}" for t in CORE_TABLES if f"silver_{t}" in ledger.prints]
    silver = layers.read_present(spark, silver_dir, required)
    checks = ledger.stage(
        "silver_checks", of_silver, [required, spec.target_code],
        lambda: quality.silver_quality(spark, silver, required, spec.target_code, measured_tables(normalized)),
    )
    for name, frame in checks.items():
        manifest(frame, f"silver_qa_{name}")
        out[f"silver_{name}"] = frame

    if scenario.reference_date:
        typed = {t: f for t, f in silver.items() if f is not None}
        found = ledger.stage(
            "silver_future_dates", of_silver, scenario.reference_date,
            lambda: {"dates": followup.future_date_check(typed, SILVER_DATES, scenario.reference_date)},
        )
        out["future_date_check"] = found["dates"]
        manifest(out["future_date_check"], "silver_qa_future_dates")

    def after(*tables):
        return [f"silver_{t}" for t in tables if f"silver_{t}" in ledger.prints]

    prefix = f"{reports}/tables/{scenario.scenario_id}"

    def index_stage():
        cohort, counts = build_index_cohort(spark, silver_dir, gold_dir, spec)
        return {"cohort": cohort, "counts": counts}

    found = ledger.stage(
        "index_cohort", after("patients", "conditions", "encounters"), rules_of, index_stage, {"cohort": gold(INDEX_TABLE)}
    )
    out["index_cohort"] = found["cohort"]
    manifest(found["counts"], "t2dm_index_cohort")

    csv = f"{prefix}_t2dm_attrition.csv"
    found = ledger.stage(
        "attrition", [*after("patients"), "index_cohort"], csv,
        lambda: {"steps": build_attrition(spark, silver_dir, gold_dir, spec, csv)}, {"steps": gold(ATTRITION_TABLE)}, [csv],
    )
    out["attrition"] = found["steps"]
    manifest(out["attrition"], "t2dm_attrition_table")

    final_csv = f"{prefix}_t2dm_final_cohort.csv"

    def final_stage():
        cohort, counts = build_final_cohort(spark, gold_dir, final_csv)
        return {"cohort": cohort, "counts": counts}

    found = ledger.stage("final_cohort", ["index_cohort"], final_csv, final_stage, {"cohort": gold(FINAL_TABLE)}, [final_csv])
    out["final_cohort"] = found["cohort"]
    manifest(found["counts"], "t2dm_final_cohort")

    baseline_csv = f"{prefix}_baseline_characteristics.csv"
    found = ledger.stage(
        "baseline", ["final_cohort"], baseline_csv,
        lambda: {"report": build_baseline(spark, gold_dir, baseline_csv)}, {"report": gold(BASELINE_TABLE)}, [baseline_csv],
    )
    out["baseline"] = found["report"]
    rows = out["baseline"].agg(F.count(F.lit(1)).alias("n")).scalar()
    manifest(
        summary.baseline_summary(out["final_cohort"]).withColumn("baseline_table_rows", rows),
        "baseline_characteristics",
    )

    medication_sets, lab_sets = sets_for(concept_sets, MEDICATION_USES), sets_for(concept_sets, LAB_USES)
    reported = {name: f"{prefix}_{name}.csv" for name in REPORTED}

    def followup_stage():
        built = build_followup(spark, silver_dir, gold_dir, spec, medication_sets, lab_sets)
        for name, place in reported.items():
            layers.write_csv(built[name], place)
        return built

    beyond = ledger.stage(
        "followup", ["final_cohort", *after("encounters", "medications", "observations", "procedures")],
        [rules_of, medication_sets, lab_sets, prefix], followup_stage,
        {name: gold(name) for name in ("followup_window", *REPORTED)}, list(reported.values()),
    )
    beyond |= ledger.stage(
        "windows", ["followup", *after("encounters", "conditions")], rules_of,
        lambda: build_windows(spark, silver_dir, gold_dir, spec),
        {name: gold(name) for name in ("baseline_window", "exclusion_in_followup")},
    )
    if spec.rules:
        manifest(rules.rule_frame(spark, spec.rules), "rules")
        beyond |= ledger.stage(
            "rules", ["index_cohort", *after("conditions")], rules_of, lambda: build_rules(spark, silver_dir, gold_dir, spec),
            {name: gold(name) for name in ("rule_flags", "ruled_cohort")},
        )
    model_dir = scenario.model_dir or f"{gold_dir.rstrip('/')}/model"
    model = ledger.stage(
        "common_model", of_silver, model_dir, lambda: build_common_model(spark, silver_dir, model_dir),
        {name: layers.table_path(model_dir, name) for name in (*followup.COMMON_MODEL, *intervals.ERAS)},
    )
    sizes = [
        frame.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"))
        for name, frame in {**beyond, **model}.items()
    ]
    manifest(reduce(DataFrame.unionByName, sizes), "study_outputs")
    out["stages"] = ledger.report()
    manifest(out["stages"], "stages")
    return {**out, **beyond, **{f"model_{name}": frame for name, frame in model.items()}}


def convert_changed(spark, scenario, inventory, ledger) -> DataFrame:
    """The conversion's records: of files that are as they were when converted the kept ones, others
    are converted now."""
    present = {r.filename: r for r in inventory.where("status = 'present'").collect()}
    wanted = [n for n in scenario.expected_files if n in present]
    changed, records = [], []
    for name in wanted:
        (table,) = table_names([name])
        stage, path = f"bronze_{table}", layers.table_path(scenario.bronze_dir, table)
        ledger.describe(stage, {"raw": present[name].sha256}, present[name].path)
        reused = ledger.stands(stage, [path])
        ledger.note(stage, reused)
        if reused:
            records += ledger.frames(stage)["record"].collect()
        else:
            changed.append(name)
    if changed:
        fresh = raw_csv.raw_to_bronze(spark, scenario.raw_dir, scenario.bronze_dir, changed, inventory=inventory)
        for row in fresh.collect():
            records.append(row)
            if row.status == "converted":
                stage = f"bronze_{row.table_name}"
                ledger.keep(stage, {"record": spark.createDataFrame([row], fresh.schema)}, [row.bronze_parquet])
    order = {n: i for i, n in enumerate(sorted(wanted))}
    records.sort(key=lambda r: order[r.source_csv.rstrip("/").rsplit("/", 1)[-1]])
    return spark.createDataFrame(records, raw_csv.CONVERSION_SCHEMA)


def normalize_changed(spark, scenario, ledger) -> DataFrame:
    """The normalisation's records, like those of the conversion."""
    kept, changed = {}, []
    for table in CORE_TABLES:
        stage, path = f"silver_{table}", layers.table_path(scenario.silver_dir, table)
        if f"bronze_{table}" not in ledger.prints:
            changed.append(table)
            continue
        ledger.describe(stage, [f"bronze_{table}"], None)
        reused = ledger.stands(stage, [path])
        ledger.note(stage, reused)
        if reused:
            kept[table] = ledger.frames(stage)["record"].first()
        else:
            changed.append(table)
    if changed:
        found = bronze_to_silver(spark, scenario.bronze_dir, scenario.silver_dir, changed)
        for row in found.collect():
            kept[row.table_name] = row
            if row.status == "normalized" and f"bronze_{row.table_name}" in ledger.prints:
                record = spark.createDataFrame([row], found.schema)
                ledger.keep(f"silver_{row.table_name}", {"record": record}, [row.silver_path])
    records = [kept[table] for table in CORE_TABLES]
    return spark.createDataFrame(records, NORMALIZATION_SCHEMA)
