"""SQL text of the registered queries, written independently of the DataFrame plans."""

from __future__ import annotations

from ..spec import StudySpec
from .bindings import (
    BOUND_STUDY,
    FOLLOWUP_CONCEPTS,
    LAB_CONCEPTS,
    MANY_CODES_STUDY,
    OTHER_STUDY,
    REFERENCE_DATE,
)

_PEOPLE = """customer JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey
    JOIN (VALUES (1), (2)) AS c(copy) ON copy = 1 OR c_custkey % 50 = 0"""
_PATIENT = """CASE WHEN o_orderkey % 97 = 0 THEN NULL
    WHEN o_orderkey % 101 = 0 THEN concat('unknown-', o_custkey) ELSE CAST(o_custkey AS VARCHAR) END"""
_SEX = """CASE WHEN c_custkey % 17 = 0 THEN '   ' WHEN c_custkey % 17 = 2 THEN NULL
    WHEN c_custkey % 17 = 1 THEN concat(' ', c_mktsegment, '  ') ELSE c_mktsegment END"""
_LINES = "lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey"
_BIRTH = "(DATE '1930-01-01' + CAST((c_custkey * 7919) % 21000 AS INTEGER))"
_DEATH = (
    "(CASE WHEN c_custkey % 11 = 0 THEN DATE '1996-01-01'"
    " + CAST((c_custkey * 104729) % 3000 AS INTEGER) END)"
)
_LINE_KEY = "(l_orderkey * 7 + l_linenumber)"

SILVER_CTE = {
    "patients": f"""
        SELECT CAST(c_custkey AS VARCHAR) AS patient_id, {_BIRTH} AS birth_date,
               {_DEATH} AS death_date, {_SEX} AS sex, n_name AS race,
               r_name AS ethnicity, CAST(year({_BIRTH}) AS INTEGER) AS birth_year,
               'patients' AS source_table
        FROM {_PEOPLE}""",
    "encounters": f"""
        SELECT CAST(o_orderkey AS VARCHAR) AS encounter_id,
               {_PATIENT} AS patient_id,
               CAST(o_orderdate AS DATE) AS encounter_start_date,
               CAST(o_orderdate AS DATE) + CAST(o_orderkey % 4 AS INTEGER) AS encounter_stop_date,
               o_orderpriority AS encounter_class, o_orderstatus AS code,
               o_orderpriority AS description, o_totalprice AS total_claim_cost
        FROM orders""",
    "conditions": f"""
        SELECT {_PATIENT} AS patient_id,
               CAST(l_orderkey AS VARCHAR) AS encounter_id,
               CAST(l_shipdate AS DATE) AS condition_start_date,
               CASE WHEN l_linestatus = 'F' THEN CAST(l_shipdate AS DATE) + 30 END
                   AS condition_stop_date,
               p_brand AS code, p_type AS description
        FROM {_LINES}""",
    "medications": f"""
        SELECT {_PATIENT} AS patient_id,
               CAST(l_orderkey AS VARCHAR) AS encounter_id,
               CAST(l_shipdate AS DATE) AS medication_start_date,
               CAST(l_shipdate AS DATE) + CAST(l_quantity AS INTEGER) AS medication_stop_date,
               p_brand AS code, p_type AS description, l_quantity AS dispenses,
               l_extendedprice AS total_cost
        FROM {_LINES}""",
    "observations": """
        SELECT CAST(user_id AS VARCHAR) AS patient_id, CAST(NULL AS VARCHAR) AS encounter_id,
               CAST(ts AS DATE) AS observation_date, event_type AS code,
               event_type AS description, CAST(value AS VARCHAR) AS value_raw,
               value AS value_numeric, 'unit' AS units
        FROM events""",
    "procedures": f"""
        SELECT {_PATIENT} AS patient_id,
               CAST(l_orderkey AS VARCHAR) AS encounter_id,
               CAST(l_shipdate AS DATE) AS procedure_start_date,
               CAST(l_shipdate AS DATE) AS procedure_stop_date,
               p_brand AS code, p_type AS description, l_extendedprice AS base_cost
        FROM {_LINES}""",
    "careplans": f"""
        SELECT CAST(o_orderkey AS VARCHAR) AS careplan_id,
               {_PATIENT} AS patient_id,
               CAST(o_orderkey AS VARCHAR) AS encounter_id,
               CAST(o_orderdate AS DATE) AS careplan_start_date,
               CAST(NULL AS DATE) AS careplan_stop_date,
               o_orderstatus AS code, o_orderpriority AS description
        FROM orders""",
    "labs": """
        SELECT CAST(user_id AS VARCHAR) AS patient_id,
               DATE '1995-01-01' + CAST((event_id * 37) % 2490 AS INTEGER) AS observation_date,
               event_type AS code, value AS value_numeric
        FROM events""",
}


def _iso(day: str) -> str:
    return f"strftime({day}, '%Y-%m-%d')"


def _stamp(key: str, day: str) -> str:
    return f"""CASE {key} % 23 WHEN 3 THEN 'unknown' WHEN 7 THEN '2020-02-30' WHEN 11 THEN NULL
        WHEN 13 THEN {_iso(day)} WHEN 17 THEN strftime({day}, '%Y-%-m-%-d')
        ELSE {_iso(day)} || 'T08:30:00Z' END"""


def _money(key: str, amount: str) -> str:
    cents = f"printf('%.2f', {amount})"
    return f"""CASE {key} % 19 WHEN 2 THEN 'n/a' WHEN 5 THEN NULL WHEN 8 THEN {cents} || 'd'
        WHEN 11 THEN '1e3' WHEN 14 THEN '+' || {cents} ELSE {cents} END"""


_SHIP = "CAST(l_shipdate AS DATE)"
_ORDERED = "CAST(o_orderdate AS DATE)"
_STOP_CONDITION = f"(CASE WHEN l_linestatus = 'F' THEN {_SHIP} + 30 END)"

BRONZE_CTE = {
    "patients": f"""
        SELECT CAST(c_custkey AS VARCHAR) AS "Id",
               CASE WHEN c_custkey % 97 = 0 THEN '1970-13-01' ELSE {_iso(_BIRTH)} END
                   AS "BIRTHDATE",
               {_iso(_DEATH)} AS "DEATHDATE", {_SEX} AS "GENDER", n_name AS "RACE",
               r_name AS "ETHNICITY", c_name AS "CITY",
               lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS "ZIP"
        FROM {_PEOPLE}""",
    "encounters": f"""
        SELECT CAST(o_orderkey AS VARCHAR) AS "Id", {_iso(_ORDERED)} || 'T08:30:00Z' AS "START",
               {_stamp("o_orderkey", f"({_ORDERED} + CAST(o_orderkey % 4 AS INTEGER))")} AS "STOP",
               {_PATIENT} AS "PATIENT", o_orderpriority AS "ENCOUNTERCLASS",
               o_orderstatus AS "CODE", o_orderpriority AS "DESCRIPTION",
               {_money("o_orderkey", "o_totalprice")} AS "TOTAL_CLAIM_COST"
        FROM orders""",
    "conditions": f"""
        SELECT {_iso(_SHIP)} || 'T08:30:00Z' AS "START",
               {_stamp(_LINE_KEY, _STOP_CONDITION)} AS "STOP",
               {_PATIENT} AS "PATIENT", CAST(l_orderkey AS VARCHAR) AS "ENCOUNTER",
               p_brand AS "CODE", p_type AS "DESCRIPTION"
        FROM {_LINES}""",
    "medications": f"""
        SELECT {_stamp(_LINE_KEY, _SHIP)} AS "START", {_PATIENT} AS "PATIENT",
               CAST(l_orderkey AS VARCHAR) AS "ENCOUNTER", p_brand AS "CODE",
               p_type AS "DESCRIPTION", printf('%.0f', l_quantity) AS "DISPENSES",
               {_money(_LINE_KEY, "l_extendedprice")} AS "TOTALCOST"
        FROM {_LINES}""",
    "observations": f"""
        SELECT {_stamp("event_id", "CAST(ts AS DATE)")} AS "DATE",
               CAST(user_id AS VARCHAR) AS "PATIENT", event_type AS "CODE",
               event_type AS "DESCRIPTION", {_money("event_id", "value")} AS "VALUE"
        FROM events""",
    "procedures": f"""
        SELECT {_stamp(_LINE_KEY, _SHIP)} AS "START", {_PATIENT} AS "PATIENT",
               CAST(l_orderkey AS VARCHAR) AS "ENCOUNTER", p_brand AS "CODE",
               p_type AS "DESCRIPTION", {_money(_LINE_KEY, "l_extendedprice")} AS "BASE_COST"
        FROM {_LINES}""",
    "careplans": f"""
        SELECT CAST(o_orderkey AS VARCHAR) AS "Id", {_stamp("o_orderkey", _ORDERED)} AS "START",
               {_PATIENT} AS "PATIENT", CAST(o_orderkey AS VARCHAR) AS "ENCOUNTER",
               o_orderstatus AS "CODE", o_orderpriority AS "DESCRIPTION"
        FROM orders""",
}

# Columns of the raw tables as bound, in order.
BRONZE_COLUMNS = {
    "patients": ["Id", "BIRTHDATE", "DEATHDATE", "GENDER", "RACE", "ETHNICITY", "CITY", "ZIP"],
    "encounters": ["Id", "START", "STOP", "PATIENT", "ENCOUNTERCLASS", "CODE", "DESCRIPTION",
                   "TOTAL_CLAIM_COST"],
    "conditions": ["START", "STOP", "PATIENT", "ENCOUNTER", "CODE", "DESCRIPTION"],
    "medications": ["START", "PATIENT", "ENCOUNTER", "CODE", "DESCRIPTION", "DISPENSES",
                    "TOTALCOST"],
    "observations": ["DATE", "PATIENT", "CODE", "DESCRIPTION", "VALUE"],
    "procedures": ["START", "PATIENT", "ENCOUNTER", "CODE", "DESCRIPTION", "BASE_COST"],
    "careplans": ["Id", "START", "PATIENT", "ENCOUNTER", "CODE", "DESCRIPTION"],
}


def with_tables(ctes: dict[str, str], body: str) -> str:
    heads = ",\n".join(f"{name} AS ({text})" for name, text in ctes.items())
    return f"WITH {heads}\n{body}"


def sql_date(column: str) -> str:
    head = f"substr({column}, 1, 10)"
    return (
        f"CASE WHEN regexp_matches({head}, '^[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}$')"
        f" THEN CAST(try_strptime({head}, '%Y-%m-%d') AS DATE) END"
    )


def sql_number(column: str) -> str:
    return (
        f"CASE WHEN regexp_matches({column},"
        " '^[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?$')"
        f" THEN TRY_CAST({column} AS DOUBLE) END"
    )


_SILVER_OF = {
    "patients": """SELECT "Id" AS patient_id, {d:BIRTHDATE} AS birth_date,
        {d:DEATHDATE} AS death_date, "GENDER" AS sex, "RACE" AS race, "ETHNICITY" AS ethnicity,
        {null} AS marital_status, "CITY" AS city, {null} AS state, {null} AS county, "ZIP" AS zip,
        CAST(year({d:BIRTHDATE}) AS INTEGER) AS birth_year, 'patients' AS source_table""",
    "encounters": """SELECT "Id" AS encounter_id, "PATIENT" AS patient_id,
        {d:START} AS encounter_start_date, {d:STOP} AS encounter_stop_date,
        {null} AS organization_id, {null} AS provider_id, {null} AS payer_id,
        "ENCOUNTERCLASS" AS encounter_class, "CODE" AS code, "DESCRIPTION" AS description,
        {null} AS reason_code, {null} AS reason_description, {none} AS base_encounter_cost,
        {n:TOTAL_CLAIM_COST} AS total_claim_cost, {none} AS payer_coverage,
        'encounters' AS source_table""",
    "conditions": """SELECT "PATIENT" AS patient_id, "ENCOUNTER" AS encounter_id,
        {d:START} AS condition_start_date, {d:STOP} AS condition_stop_date, "CODE" AS code,
        "DESCRIPTION" AS description, 'conditions' AS source_table""",
    "medications": """SELECT "PATIENT" AS patient_id, "ENCOUNTER" AS encounter_id,
        {null} AS payer_id, {d:START} AS medication_start_date,
        CAST(NULL AS DATE) AS medication_stop_date, "CODE" AS code,
        "DESCRIPTION" AS description, {none} AS base_cost, {none} AS payer_coverage,
        {n:DISPENSES} AS dispenses, {n:TOTALCOST} AS total_cost, {null} AS reason_code,
        {null} AS reason_description, 'medications' AS source_table""",
    "observations": """SELECT "PATIENT" AS patient_id, {null} AS encounter_id,
        {d:DATE} AS observation_date, {null} AS category, "CODE" AS code,
        "DESCRIPTION" AS description, "VALUE" AS value_raw, {n:VALUE} AS value_numeric,
        {null} AS units, {null} AS value_type, 'observations' AS source_table""",
    "procedures": """SELECT "PATIENT" AS patient_id, "ENCOUNTER" AS encounter_id,
        {d:START} AS procedure_start_date, CAST(NULL AS DATE) AS procedure_stop_date,
        "CODE" AS code, "DESCRIPTION" AS description, {n:BASE_COST} AS base_cost,
        {null} AS reason_code, {null} AS reason_description, 'procedures' AS source_table""",
    "careplans": """SELECT "Id" AS careplan_id, "PATIENT" AS patient_id,
        "ENCOUNTER" AS encounter_id, {d:START} AS careplan_start_date,
        CAST(NULL AS DATE) AS careplan_stop_date, "CODE" AS code, "DESCRIPTION" AS description,
        {null} AS reason_code, {null} AS reason_description, 'careplans' AS source_table""",
}


def _normalized(table: str, source: str) -> str:
    """Typed form of the raw table `source`."""
    text = _SILVER_OF[table].replace("{null}", "CAST(NULL AS VARCHAR)")
    text = text.replace("{none}", "CAST(NULL AS DOUBLE)")
    for column in BRONZE_COLUMNS[table]:
        text = text.replace(f"{{d:{column}}}", sql_date(f'"{column}"'))
        text = text.replace(f"{{n:{column}}}", sql_number(f'"{column}"'))
    return f"{text} FROM {source}"


# --- cohort ----------------------------------------------------------------------------------

_AGE = """CAST(year({i}) - year({b})
    - CASE WHEN month({i}) > month({b})
             OR (month({i}) = month({b}) AND day({i}) >= day({b})) THEN 0 ELSE 1 END AS INTEGER)"""


def _age(index: str, birth: str) -> str:
    return _AGE.replace("{i}", index).replace("{b}", birth)


def _in(codes) -> str:
    several = codes if isinstance(codes, tuple) else (codes,)
    return "IN (" + ", ".join(f"'{c}'" for c in several) + ")"


def _shown(codes) -> str:
    return codes if isinstance(codes, str) else "|".join(codes)


def cohort_ctes(study=BOUND_STUDY) -> dict[str, str]:
    """Index cohort on top of the CTEs patients, conditions and encounters."""
    rules = (study.target_code, study.prior_exclusion_code, study.window_exclusion_code)
    in_t, in_p, in_w = map(_in, rules)
    t, p, w = map(_shown, rules)
    return {
        "first_event": f"""
            SELECT * EXCLUDE (rn) FROM (
                SELECT patient_id, condition_start_date AS index_date,
                       encounter_id AS index_encounter_id, code AS index_condition_code,
                       description AS index_condition_description,
                       count(*) OVER (PARTITION BY patient_id) AS t2dm_condition_row_count,
                       row_number() OVER (PARTITION BY patient_id
                           ORDER BY condition_start_date, encounter_id NULLS FIRST,
                                    description NULLS FIRST, code) AS rn
                FROM conditions WHERE code {in_t} AND condition_start_date IS NOT NULL)
            WHERE rn = 1""",
        "first_seen": """
            SELECT patient_id, min(encounter_start_date) AS first_observed_date
            FROM encounters WHERE encounter_start_date IS NOT NULL GROUP BY patient_id""",
        "prior": f"""
            SELECT c.patient_id, TRUE AS has_prior_t1dm_before_index,
                   min(condition_start_date) AS first_prior_t1dm_date,
                   count(*) AS prior_t1dm_row_count
            FROM conditions c JOIN first_event f ON c.patient_id = f.patient_id
            WHERE c.code {in_p} AND condition_start_date < index_date GROUP BY c.patient_id""",
        "pregnancy": f"""
            SELECT c.patient_id, TRUE AS has_pregnancy_window_before_or_at_index,
                   min(condition_start_date) AS first_pregnancy_window_date,
                   count(*) AS pregnancy_window_row_count
            FROM conditions c JOIN first_event f ON c.patient_id = f.patient_id
            WHERE c.code {in_w} AND condition_start_date <= index_date GROUP BY c.patient_id""",
        "joined": f"""
            SELECT f.patient_id, f.index_date, f.index_encounter_id, f.index_condition_code,
                   f.index_condition_description, f.t2dm_condition_row_count, birth_date,
                   death_date, sex, race, ethnicity, first_observed_date,
                   coalesce(has_prior_t1dm_before_index, FALSE) AS has_prior_t1dm_before_index,
                   first_prior_t1dm_date, coalesce(prior_t1dm_row_count, 0) AS prior_t1dm_row_count,
                   coalesce(has_pregnancy_window_before_or_at_index, FALSE)
                       AS has_pregnancy_window_before_or_at_index,
                   first_pregnancy_window_date,
                   coalesce(pregnancy_window_row_count, 0) AS pregnancy_window_row_count,
                   {_age("f.index_date", "birth_date")} AS age_at_index,
                   CAST(f.index_date - first_observed_date AS BIGINT)
                       AS observable_history_days_before_index
            FROM first_event f
            LEFT JOIN patients p ON f.patient_id = p.patient_id
            LEFT JOIN first_seen s ON f.patient_id = s.patient_id
            LEFT JOIN prior r ON f.patient_id = r.patient_id
            LEFT JOIN pregnancy g ON f.patient_id = g.patient_id""",
        "cohort": f"""
            SELECT *,
                   meets_adult_age_rule AND meets_baseline_history_rule
                       AND meets_prior_t1dm_exclusion_rule AND meets_pregnancy_exclusion_rule
                       AS meets_final_phase1_rules
            FROM (SELECT *,
                   coalesce(age_at_index >= {study.minimum_age_years}, FALSE)
                       AS meets_adult_age_rule,
                   coalesce(observable_history_days_before_index >= {study.baseline_days}, FALSE)
                       AS meets_baseline_history_rule,
                   NOT has_prior_t1dm_before_index AS meets_prior_t1dm_exclusion_rule,
                   NOT has_pregnancy_window_before_or_at_index AS meets_pregnancy_exclusion_rule,
                   '{t}' AS target_t2dm_code, '{p}' AS prior_t1dm_exclusion_code,
                   '{w}' AS pregnancy_exclusion_code,
                   CAST({study.baseline_days} AS INTEGER) AS baseline_days_required,
                   '{study.cohort_name}' AS cohort_name
            FROM joined)""",
        "final": "SELECT * FROM cohort WHERE meets_final_phase1_rules",
    }


def _rule_ctes(study: StudySpec) -> dict[str, str]:
    """`people`, a row per patient of the cohort, and `flags`, each rule by a condition of its own."""
    parts = []
    for r in study.rules:
        low = f"{r.anchor} + ({r.from_days})" if r.from_days is not None else None
        high = f"{r.last_anchor} + ({r.to_days})" if r.to_days is not None else None
        bounds = [f"day {'>' if r.from_strict else '>='} {low}"] if low else []
        bounds += [f"day {'<' if r.strict else '<='} {high}"] if high else []
        parts.append(f"""SELECT patient_id, '{r.rule_id}' AS rule_id, min(day) AS first_date, max(day) AS last_date,
            count(*) AS row_count FROM people JOIN dated USING (patient_id)
            WHERE {" AND ".join([f"code {_in(r.codes)}", *bounds])}
            GROUP BY patient_id HAVING count(*) >= {r.least}""")
    return {
        "people": "SELECT DISTINCT * FROM cohort",
        "dated": "SELECT patient_id, code, condition_start_date AS day FROM conditions WHERE condition_start_date IS NOT NULL",
        "flags": " UNION ALL ".join(parts),
    }


def _ruled_cohort(study: StudySpec) -> str:
    columns, meets = [], []
    for r in study.rules:
        found = f"(SELECT max(row_count) FROM flags f WHERE f.patient_id = p.patient_id AND f.rule_id = '{r.rule_id}')"
        columns.append(f"{found} IS NOT NULL AS has_{r.rule_id}, CAST(coalesce({found}, 0) AS BIGINT) AS {r.rule_id}_row_count")
        meets.append(("" if r.kind == "require" else "NOT ") + f"has_{r.rule_id}")
    return f"""SELECT *, {" AND ".join(meets)} AS meets_all_rules FROM (
        SELECT patient_id, index_date, index_condition_code, meets_final_phase1_rules, {", ".join(columns)}
        FROM people p)"""


def _silver_ctes(*tables: str) -> dict[str, str]:
    return {t: SILVER_CTE[t] for t in tables}


def on_cohort(body: str, study=BOUND_STUDY, *more: str, **extra: str) -> str:
    ctes = _silver_ctes("patients", "conditions", "encounters", *more)
    ctes.update(cohort_ctes(study))
    ctes.update(extra)
    return with_tables(ctes, body)


_DISTINCT = "(count(DISTINCT {c}) + CASE WHEN count(*) > count({c}) THEN 1 ELSE 0 END)"


def _distinct(column: str) -> str:
    return f"CAST({_DISTINCT.replace('{c}', column)} AS BIGINT)"


_SUMMARY_COLUMNS = f"""
    (SELECT count(*) FROM patients) AS patients_total,
    (SELECT count(*) FROM conditions) AS conditions_total,
    (SELECT count(*) FROM encounters) AS encounters_total,
    (SELECT count(*) FROM conditions WHERE code = '{{t}}' AND condition_start_date IS NOT NULL)
        AS t2dm_condition_rows,
    (SELECT count(*) FROM first_event) AS t2dm_patient_count,
    (SELECT count(*) FROM cohort) AS index_cohort_rows,
    (SELECT count(*) FROM cohort WHERE meets_adult_age_rule) AS adult_index_cohort_rows,
    (SELECT count(*) FROM cohort WHERE NOT meets_adult_age_rule) AS underage_index_cohort_rows,
    (SELECT count(*) FROM cohort WHERE meets_adult_age_rule AND meets_baseline_history_rule)
        AS baseline_history_eligible_rows,
    (SELECT count(*) FROM cohort WHERE meets_adult_age_rule AND NOT meets_baseline_history_rule)
        AS baseline_history_ineligible_rows,
    (SELECT count(*) FROM cohort WHERE meets_adult_age_rule AND meets_baseline_history_rule
        AND NOT meets_prior_t1dm_exclusion_rule) AS prior_t1dm_excluded_rows,
    (SELECT count(*) FROM cohort WHERE meets_adult_age_rule AND meets_baseline_history_rule
        AND meets_prior_t1dm_exclusion_rule AND NOT meets_pregnancy_exclusion_rule)
        AS pregnancy_window_excluded_rows,
    (SELECT count(*) FROM final) AS final_phase1_eligible_rows"""


def _summary(study) -> str:
    return "SELECT " + _SUMMARY_COLUMNS.replace("{t}", study.target_code)


def _attrition(study=BOUND_STUDY) -> str:
    """Each step's distinct patients by its own query, chained to the step before."""
    adult = "meets_adult_age_rule"
    history = f"{adult} AND meets_baseline_history_rule"
    no_prior = f"{history} AND NOT has_prior_t1dm_before_index"
    no_window = f"{no_prior} AND NOT has_pregnancy_window_before_or_at_index"
    steps = [
        ("patients", "TRUE", "raw_synthea_population",
         "Raw Synthea population with patient records",
         "Starting population from silver patients table."),
        ("cohort", "TRUE", "has_t2dm_diagnosis",
         "At least one qualifying Type 2 Diabetes Mellitus diagnosis",
         f"Uses SNOMED code {study.target_code} from silver conditions table."),
        ("cohort", adult, "adult_at_index",
         f"Age >= {study.minimum_age_years} years at first qualifying T2DM index date",
         "Age calculated at the first qualifying T2DM diagnosis date."),
        ("cohort", history, f"baseline_history_{study.baseline_days}_days",
         f"At least {study.baseline_days} days of observable history before index date",
         "Observable history currently measured from earliest encounter date to index date."),
        ("cohort", no_prior, "exclude_prior_type_1_diabetes",
         "No prior Type 1 Diabetes Mellitus diagnosis before index date",
         f"Uses SNOMED code {study.prior_exclusion_code} before the T2DM index date."),
        ("cohort", no_window, "exclude_pregnancy_window",
         "No pregnancy or gestational-window diagnosis before or at index date",
         f"Uses SNOMED code {study.window_exclusion_code} before or at the T2DM index date."),
        ("cohort", "meets_final_phase1_rules", "final_analytical_cohort",
         "Final Phase 1 analytical cohort",
         "Patients meeting adult age, baseline history, and exclusion rules."),
    ]
    counted = " UNION ALL ".join(
        f"SELECT CAST({i + 1} AS BIGINT) AS step_number, '{sid}' AS step_id, '{criterion}' AS"
        f" criterion, '{notes}' AS notes,"
        f" (SELECT {_distinct('patient_id')} FROM {table} WHERE {rule}) AS remaining_n"
        for i, (table, rule, sid, criterion, notes) in enumerate(steps)
    )
    return f"""SELECT step_number, step_id, criterion,
        coalesce(lag(remaining_n) OVER w, remaining_n) AS input_n,
        coalesce(lag(remaining_n) OVER w, remaining_n) - remaining_n AS excluded_n,
        remaining_n, notes
        FROM ({counted}) WINDOW w AS (ORDER BY step_number)"""


_NUMERIC = (
    (1, "Demographics", "Age at index, years", "age_at_index"),
    (5, "Baseline observation", "Observable history before index, days",
     "observable_history_days_before_index"),
)
_CATEGORICAL = (
    (2, "Demographics", "Sex", "sex"),
    (3, "Demographics", "Race", "race"),
    (4, "Demographics", "Ethnicity", "ethnicity"),
)


def _numeric_statistics(source: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT CAST({pos} AS INTEGER) AS position, '{section}' AS section,
            '{label}' AS variable, count({c}) AS n, avg(CAST({c} AS DOUBLE)) AS mean,
            CASE WHEN count({c}) > 1 THEN stddev_samp(CAST({c} AS DOUBLE)) WHEN count({c}) = 1
                THEN 0.0 END AS sd,
            quantile_cont(CAST({c} AS DOUBLE), 0.25) AS q1,
            quantile_cont(CAST({c} AS DOUBLE), 0.5) AS median,
            quantile_cont(CAST({c} AS DOUBLE), 0.75) AS q3,
            CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max
            FROM {source}"""
        for pos, section, label, c in _NUMERIC
    )


def _level_rows(source: str) -> str:
    levels = " UNION ALL ".join(
        f"""SELECT {pos} AS position, '{section}' AS section, '{label}' AS variable,
            coalesce(nullif(trim({c}), ''), 'Missing') AS level FROM {source}"""
        for pos, section, label, c in _CATEGORICAL
    )
    counted = f"""SELECT position, section, variable, level, count(*) AS n
        FROM ({levels}) GROUP BY position, section, variable, level"""
    return f"""SELECT *, (SELECT {_distinct('patient_id')} FROM {source}) AS denominator,
        row_number() OVER (PARTITION BY position ORDER BY n DESC, level) AS line
        FROM ({counted})"""


def _report(source: str) -> str:
    order = "CAST({p} AS BIGINT) * 1000000000000000 + {l} AS row_order"
    total = f"(SELECT {_distinct('patient_id')} FROM {source})"
    parts = [
        f"""SELECT {order.format(p=0, l=1)}, 'Cohort' AS section,
            'Final analytical cohort' AS variable, 'Overall' AS level, 'N' AS statistic,
            CAST({total} AS VARCHAR) AS value, {total} AS n, {total} AS denominator,
            CASE WHEN {total} > 0 THEN CAST(100.0 AS DOUBLE) END AS percent,
            'Patients meeting all Phase 1 cohort criteria.' AS notes"""
    ]
    texts = (
        (1, "Mean (SD)", "printf('%.1f (%.1f)', mean, sd)"),
        (2, "Median [Q1, Q3]", "printf('%.1f [%.1f, %.1f]', median, q1, q3)"),
        (3, "Min, Max", "printf('%.1f, %.1f', min, max)"),
    )
    for line, statistic, text in texts:
        parts.append(
            f"""SELECT {order.format(p="position", l=line)}, section, variable,
                'Overall' AS level, '{statistic}' AS statistic, {text} AS value, n,
                {total} AS denominator, CAST(NULL AS DOUBLE) AS percent, '' AS notes
                FROM ({_numeric_statistics(source)})"""
        )
    share = "CAST(n AS DOUBLE) / denominator * 100"
    parts.append(
        f"""SELECT {order.format(p="position", l="line")}, section, variable, level,
            'n (%)' AS statistic, n || ' (' || printf('%.1f', {share}) || '%)' AS value, n,
            denominator, CAST(printf('%.1f', {share}) AS DOUBLE) AS percent, '' AS notes
            FROM ({_level_rows(source)})"""
    )
    return " UNION ALL ".join(parts)


# --- follow-up -------------------------------------------------------------------------------

_FOLLOWUP = {
    "last_seen": """
        SELECT patient_id, max(encounter_start_date) AS last_observed_date
        FROM encounters GROUP BY patient_id""",
    "bounded": f"""
        SELECT c.patient_id, index_date,
               CAST(index_date + INTERVAL {BOUND_STUDY.follow_up_months} MONTH AS DATE) AS window_end,
               death_date, last_observed_date
        FROM (SELECT patient_id, min(index_date) AS index_date, min(death_date) AS death_date
              FROM final GROUP BY patient_id) c
        LEFT JOIN last_seen l ON c.patient_id = l.patient_id""",
    "windows": """
        SELECT patient_id, index_date, follow_up_end,
               CASE WHEN death_date <= follow_up_end THEN 'death'
                    WHEN window_end <= follow_up_end THEN 'window_end'
                    ELSE 'end_of_record' END AS end_reason,
               CAST(follow_up_end - index_date AS BIGINT) AS follow_up_days
        FROM (SELECT *, greatest(index_date, least(window_end,
                     coalesce(death_date, last_observed_date, window_end))) AS follow_up_end FROM bounded)""",
}


def _concepts(sets: dict) -> str:
    rows = ", ".join(
        f"('{name}', '{code}')" for name, (_, _, codes) in sets.items() for code, _ in codes
    )
    return f"SELECT * FROM (VALUES {rows}) AS v(concept_set, code)"


def on_followup(body: str, *more: str, **extra: str) -> str:
    return on_cohort(body, BOUND_STUDY, *more, **{**_FOLLOWUP, **extra})


_IN_WINDOW = "BETWEEN w.index_date AND w.follow_up_end"

_COST_KINDS = (
    ("encounters", "encounters", "encounter_start_date", "total_claim_cost"),
    ("medications", "medications", "medication_start_date", "total_cost"),
    ("procedures", "procedures", "procedure_start_date", "base_cost"),
)
_COSTS = " UNION ALL ".join(
    f"""SELECT w.patient_id, '{kind}' AS kind,
        coalesce(sum(CAST(e.{cost} AS DOUBLE)), 0) AS cost
        FROM windows w LEFT JOIN {table} e
        ON e.patient_id = w.patient_id AND e.{day} {_IN_WINDOW} GROUP BY w.patient_id"""
    for kind, table, day, cost in _COST_KINDS
)

_LAB_ROWS = """SELECT k.concept_set, o.patient_id, o.value_numeric AS value,
    CAST(o.observation_date - w.index_date AS BIGINT) AS day,
    o.observation_date <= w.follow_up_end AS before_end
    FROM labs o JOIN concepts k ON o.code = k.code JOIN windows w ON o.patient_id = w.patient_id
    WHERE o.value_numeric IS NOT NULL"""


# --- checks ----------------------------------------------------------------------------------


def _bronze_count(table: str) -> str:
    return f"(SELECT count(*) FROM ({BRONZE_CTE[table]}))"


def _check_row(table, required, exists, rows, columns, missing, status) -> str:
    return (
        f"SELECT '{table}' AS table_name, {required} AS required, {exists} AS \"exists\","
        f" CAST({rows} AS BIGINT) AS row_count, CAST({columns} AS INTEGER) AS column_count,"
        f" '{missing}' AS missing_columns, '{status}' AS status"
    )


def _bronze_contract() -> str:
    rows = []
    for table, columns in BRONZE_COLUMNS.items():
        count, width, missing, status = _bronze_count(table), len(columns), "", "present"
        exists = "TRUE"
        if table == "conditions":
            width, missing, status = width - 1, "CODE", "missing_core_columns"
        if table == "procedures":
            count, status = "0", "empty"
        if table == "careplans":
            count, width, exists, status = "NULL", "NULL", "FALSE", "missing"
        rows.append(_check_row(table, "TRUE", exists, count, width, missing, status))
    return " UNION ALL ".join(rows)


def _verdict(ctes: dict, patient: str, key: str, tables: dict, body: str) -> str:
    """`body` over the CTE `found`: each table's rows and how many of its ids name no patient.
    `tables` maps a name to the rows to look at, None where the table is absent."""
    rows = " UNION ALL ".join(
        f"""SELECT {i} AS position, '{name}' AS name, (SELECT count(*) FROM {source}) AS n,
            (SELECT count(DISTINCT {patient}) FROM {source}
             WHERE {patient} NOT IN (SELECT {key} FROM patients)) AS unknown"""
        for i, (name, source) in enumerate(tables.items())
        if source
    )
    return with_tables({**ctes, "found": rows}, body)


def _bronze_verdict() -> str:
    """Care plans absent, conditions without codes and procedures emptied on purpose; everything
    else counted."""
    tables = {t: t for t in BRONZE_CTE if t not in ("patients", "careplans")}
    tables["procedures"] = """(SELECT * FROM procedures WHERE "CODE" IS NULL)"""
    return _verdict(
        BRONZE_CTE, '"PATIENT"', '"Id"', tables,
        f"""SELECT CAST({len(BRONZE_CTE)} AS BIGINT) AS required_table_count,
            CAST(0 AS BIGINT) AS optional_table_count_present,
            {len(BRONZE_CTE)} - 1 - count(*) AS missing_required_table_count,
            count(*) FILTER (WHERE n = 0) AS empty_required_table_count,
            CAST(1 AS BIGINT) AS tables_missing_columns_count,
            count(*) FILTER (WHERE unknown > 0) AS failed_patient_reference_table_count,
            'careplans' AS missing_required_tables,
            coalesce(string_agg(name, ',' ORDER BY position) FILTER (WHERE n = 0), '')
                AS empty_required_tables,
            'conditions' AS tables_missing_columns,
            coalesce(string_agg(name, ',' ORDER BY position) FILTER (WHERE unknown > 0), '')
                AS failed_patient_reference_tables,
            FALSE AS structural_checks_passed FROM found""",
    )


def _silver_verdict() -> str:
    tables = {t: t for t in SILVER_CTE if t not in ("patients", "labs")}
    return _verdict(
        _silver_ctes(*(t for t in SILVER_CTE if t != "labs")), "patient_id", "patient_id", tables,
        f"""SELECT CAST({len(tables) + 1} AS BIGINT) AS required_table_count,
            {len(tables)} - count(*) AS missing_required_table_count,
            count(*) FILTER (WHERE n = 0) AS empty_required_table_count,
            CAST(0 AS BIGINT) AS tables_missing_columns_count,
            CAST(0 AS BIGINT) AS tables_with_invalid_date_dtypes_count,
            count(*) FILTER (WHERE unknown > 0) AS failed_patient_reference_table_count,
            bool_and(n > 0 AND unknown = 0) AS structural_checks_passed FROM found""",
    )


def _silver_contract() -> str:
    """Null counts per date column; the birth date arrives as text and is reported as such."""
    columns = (
        ("patients", "birth_date", "FALSE", "invalid_date_dtypes"),
        ("patients", "death_date", "TRUE", "invalid_date_dtypes"),
        ("encounters", "encounter_start_date", "TRUE", "present"),
        ("encounters", "encounter_stop_date", "TRUE", "present"),
        ("conditions", "condition_start_date", "TRUE", "present"),
        ("conditions", "condition_stop_date", "TRUE", "present"),
        ("medications", "medication_start_date", "TRUE", "present"),
        ("medications", "medication_stop_date", "TRUE", "present"),
        ("observations", "observation_date", "TRUE", "present"),
        ("procedures", "procedure_start_date", "TRUE", "present"),
        ("procedures", "procedure_stop_date", "TRUE", "present"),
        ("careplans", "careplan_start_date", "TRUE", "present"),
        ("careplans", "careplan_stop_date", "TRUE", "present"),
    )
    return with_tables(
        _silver_ctes(*(t for t in SILVER_CTE if t != "labs")),
        " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, '{c}' AS column_name, {ok} AS is_date,"
            f" count(*) AS row_count, count(*) - count({c}) AS null_count, '{status}' AS status"
            f" FROM {t}"
            for t, c, ok, status in columns
        ),
    )


_REFERENCES = (
    ("encounters", "SELECT o_custkey AS r FROM orders"),
    ("conditions", "SELECT o_custkey AS r FROM lineitem JOIN orders ON l_orderkey = o_orderkey"),
    ("medications", "SELECT l_partkey AS r FROM lineitem"),
    ("observations", "SELECT user_id AS r FROM events"),
    ("procedures", "SELECT l_suppkey AS r FROM lineitem"),
    ("careplans", "SELECT o_orderkey AS r FROM orders"),
)


def _reference_check() -> str:
    parts = " UNION ALL ".join(
        f"""SELECT CAST({i} AS INTEGER) AS position, '{table}' AS table_name, TRUE AS checked,
            (SELECT count(DISTINCT r) FROM ({refs})
             WHERE r NOT IN (SELECT c_custkey FROM customer)) AS unknown_patient_reference_count,
            (SELECT count(DISTINCT r) FROM ({refs})) AS unique_patient_reference_count"""
        for i, (table, refs) in enumerate(_REFERENCES)
    )
    return (
        f"SELECT *, CASE WHEN unknown_patient_reference_count = 0 THEN 'passed'"
        f" ELSE 'failed' END AS status FROM ({parts})"
    )


def _flags(code: str, operator: str, flag: str, first: str, rows: str) -> str:
    return on_cohort(
        f"""SELECT c.patient_id, TRUE AS {flag}, min(condition_start_date) AS {first},
            count(*) AS {rows}
            FROM conditions c JOIN first_event f ON c.patient_id = f.patient_id
            WHERE c.code = '{code}' AND condition_start_date {operator} index_date
            GROUP BY c.patient_id"""
    )


RAW_DATES = (
    ("patients", "BIRTHDATE"), ("patients", "DEATHDATE"),
    ("encounters", "START"), ("encounters", "STOP"),
    ("conditions", "START"), ("conditions", "STOP"),
    ("medications", "START"), ("observations", "DATE"),
    ("procedures", "START"), ("careplans", "START"),
)


def _date_parse() -> str:
    parts = []
    for table, column in RAW_DATES:
        parsed = sql_date(f'"{column}"')
        parts.append(
            f"""SELECT '{table}' AS table_name, '{column}' AS column_name,
                count("{column}") AS filled,
                CAST(count(*) FILTER (WHERE "{column}" IS NOT NULL AND ({parsed}) IS NULL)
                    AS BIGINT) AS unreadable
                FROM {table}"""
        )
    return with_tables(
        BRONZE_CTE, f"SELECT *, unreadable = 0 AS passed FROM ({' UNION ALL '.join(parts)})"
    )


SILVER_DATE_COLUMNS = (
    ("patients", "birth_date"), ("patients", "death_date"),
    ("encounters", "encounter_start_date"), ("encounters", "encounter_stop_date"),
    ("conditions", "condition_start_date"), ("conditions", "condition_stop_date"),
    ("medications", "medication_start_date"), ("medications", "medication_stop_date"),
    ("observations", "observation_date"),
    ("procedures", "procedure_start_date"), ("procedures", "procedure_stop_date"),
    ("careplans", "careplan_start_date"), ("careplans", "careplan_stop_date"),
)


def _future_dates() -> str:
    parts = " UNION ALL ".join(
        f"""SELECT '{t}' AS table_name, '{c}' AS column_name,
            count(*) FILTER (WHERE {c} > DATE '{REFERENCE_DATE}') AS after_reference_date FROM {t}"""
        for t, c in SILVER_DATE_COLUMNS
    )
    return with_tables(
        _silver_ctes(*(t for t in SILVER_CTE if t != "labs")),
        f"SELECT *, after_reference_date = 0 AS passed FROM ({parts})",
    )


def _study_outputs() -> str:
    """Rows of each output of the whole study, from the raw text tables, and a sum over them."""
    ctes = {f"raw_{t}": text for t, text in BRONZE_CTE.items()}
    ctes.update({t: _normalized(t, f"raw_{t}") for t in BRONZE_CTE})
    ctes.update(cohort_ctes())
    ctes.update(_FOLLOWUP)
    ctes["drugs"], ctes["tests"] = _concepts(FOLLOWUP_CONCEPTS), _concepts(LAB_CONCEPTS)
    ctes["costs"] = _COSTS
    ctes["attrition"] = _attrition()
    ctes["results"] = """SELECT k.concept_set,
        CAST(o.observation_date - w.index_date AS BIGINT) AS day,
        o.observation_date >= w.index_date AND o.observation_date <= w.follow_up_end AS counts
        FROM observations o JOIN tests k ON o.code = k.code
        JOIN windows w ON o.patient_id = w.patient_id
        WHERE o.value_numeric IS NOT NULL AND o.observation_date IS NOT NULL"""
    ctes["raw_dates"] = " UNION ALL ".join(
        f"""SELECT count(*) FILTER (WHERE "{c}" IS NOT NULL AND ({sql_date(f'"{c}"')}) IS NULL) AS v
        FROM raw_{t}"""
        for t, c in RAW_DATES
    )
    ctes["late_dates"] = " UNION ALL ".join(
        f"SELECT count(*) FILTER (WHERE {c} > DATE '{REFERENCE_DATE}') AS v FROM {t}"
        for t, c in SILVER_DATE_COLUMNS
    )
    days = BOUND_STUDY.baseline_days
    values = {
        "index_cohort": "SELECT observable_history_days_before_index AS v FROM cohort",
        "attrition": "SELECT remaining_n AS v FROM attrition",
        "final_cohort": "SELECT age_at_index AS v FROM final",
        "followup_window": "SELECT follow_up_days AS v FROM windows",
        "medication_exposure": f"""SELECT count(*) AS v FROM medications m
            JOIN drugs k ON m.code = k.code JOIN windows w ON m.patient_id = w.patient_id
            WHERE m.medication_start_date {_IN_WINDOW} GROUP BY concept_set""",
        "utilization": f"""SELECT count(*) AS v FROM encounters e
            JOIN windows w ON e.patient_id = w.patient_id
            WHERE e.encounter_start_date {_IN_WINDOW} GROUP BY encounter_class""",
        "cost_summary": "SELECT sum(cost) AS v FROM costs GROUP BY kind",
        "lab_summary": "SELECT count(*) FILTER (WHERE counts) AS v FROM results GROUP BY concept_set",
        "lab_trajectory": """SELECT count(*) AS v FROM results WHERE counts
            GROUP BY concept_set, day // 90""",
        "survival_table": """SELECT count(*) FILTER (WHERE end_reason = 'death') AS v
            FROM windows GROUP BY follow_up_days""",
        "baseline_window": f"""SELECT (SELECT count(*) FROM encounters e
            WHERE e.patient_id = w.patient_id AND e.encounter_start_date < w.index_date
              AND e.encounter_start_date >= w.index_date - {days}) AS v FROM windows w""",
        "exclusion_in_followup": f"""SELECT count(*) AS v FROM conditions c
            JOIN windows w ON c.patient_id = w.patient_id
            WHERE c.code = '{BOUND_STUDY.window_exclusion_code}' AND c.condition_start_date
                BETWEEN w.index_date - {days} AND w.follow_up_end GROUP BY c.patient_id""",
        "date_parse_check": "SELECT v FROM raw_dates",
        "future_date_check": "SELECT v FROM late_dates",
        "model_person": "SELECT birth_year AS v FROM patients",
        "model_visit_occurrence": "SELECT 1 AS v FROM encounters",
        "model_condition_occurrence": """SELECT CASE WHEN code LIKE 'Brand#1%' THEN 1 ELSE 0 END
            AS v FROM conditions""",
        "model_drug_exposure": "SELECT dispenses AS v FROM medications",
        "model_measurement": "SELECT value_numeric AS v FROM observations",
        "model_procedure_occurrence": "SELECT 1 AS v FROM procedures",
    }
    body = " UNION ALL ".join(
        f"""SELECT '{name}' AS output, count(*) AS row_count,
            coalesce(round(sum(CAST(v AS DOUBLE)), 4), 0) AS value FROM ({text})"""
        for name, text in values.items()
    )
    return with_tables(ctes, body)


def _eras(table, start, stop, grace, name, count, code) -> str:
    """Islands of intervals by a flag and a running sum, and the days that none of them covers."""
    keys = "patient_id, code" if code else "patient_id"
    by = f"PARTITION BY {keys} ORDER BY s, e, r"
    return with_tables(
        _silver_ctes(table),
        f"""SELECT patient_id AS person_source_value, {f"code AS {code}," if code else ""}
            min(s) AS {name}_start_date, max(e) AS {name}_end_date, count(*) AS {count},
            CAST(max(e) - min(s) + 1 - sum(covered) AS BIGINT) AS gap_days
        FROM (SELECT *, sum(CASE WHEN reached IS NULL OR s > reached + {grace} THEN 1 ELSE 0 END)
                    OVER ({by} ROWS UNBOUNDED PRECEDING) AS island,
                greatest(0, e - greatest(s - 1, coalesce(reached, s - 1))) AS covered
              FROM (SELECT *, max(e) OVER ({by} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reached
                    FROM (SELECT {keys}, {start} AS s, greatest({start}, coalesce({stop}, {start})) AS e, row_number() OVER () AS r
                          FROM {table} WHERE {start} IS NOT NULL)))
        GROUP BY {keys}, island""",
    )


def oracle_sql() -> dict[str, str]:
    silver_from_text = {f"raw_{t}": BRONZE_CTE[t] for t in ("patients", "conditions", "encounters")}
    for t in ("patients", "conditions", "encounters"):
        silver_from_text[t] = _normalized(t, f"raw_{t}")
    silver_from_text.update(cohort_ctes())

    signal = f"WHERE code = '{BOUND_STUDY.target_code}'"
    sql = {
        f"silver_{t}": with_tables({f"raw_{t}": BRONZE_CTE[t]}, _normalized(t, f"raw_{t}"))
        for t in BRONZE_CTE
    }
    sql["silver_missing_columns"] = f"""
        SELECT CAST(user_id AS VARCHAR) AS patient_id, CAST(NULL AS VARCHAR) AS encounter_id,
            {sql_date(f"({_stamp('event_id', 'CAST(ts AS DATE)')})")} AS observation_date,
            CAST(NULL AS VARCHAR) AS category, event_type AS code,
            CAST(NULL AS VARCHAR) AS description, CAST(NULL AS VARCHAR) AS value_raw,
            CAST(NULL AS DOUBLE) AS value_numeric, CAST(NULL AS VARCHAR) AS units,
            CAST(NULL AS VARCHAR) AS value_type, 'observations' AS source_table
        FROM events"""
    sql["bronze_csv_roundtrip"] = " UNION ALL ".join(
        f"""SELECT '{t}' AS table_name, {_bronze_count(t)} AS row_count,
            CAST({len(c)} AS INTEGER) AS column_count, '{",".join(c)}' AS columns,
            'converted' AS status"""
        for t, c in BRONZE_COLUMNS.items()
    )
    inventoried = list(BRONZE_COLUMNS)
    inventory = [
        f"""SELECT CAST({i} AS INTEGER) AS position, '{t}.csv' AS filename, TRUE AS required,
            TRUE AS expected, {"FALSE" if t == "careplans" else "TRUE"} AS "exists",
            {"NULL" if t == "careplans" else _bronze_count(t)} AS row_count,
            '{"" if t == "careplans" else ",".join(BRONZE_COLUMNS[t])}' AS header,
            '{"missing" if t == "careplans" else "present"}' AS status"""
        for i, t in enumerate(inventoried)
    ]
    inventory.append(
        """SELECT 7, 'allergies.csv', FALSE, TRUE, FALSE, NULL, '', 'missing'"""
    )
    inventory.append(
        """SELECT 8, 'regions.csv', FALSE, FALSE, TRUE, (SELECT count(*) FROM region),
           'r_regionkey,r_name', 'present'"""
    )
    sql["raw_inventory"] = " UNION ALL ".join(inventory)
    ruled = _rule_ctes(MANY_CODES_STUDY)
    sql["index_cohort_codes"] = on_cohort("SELECT * FROM cohort", MANY_CODES_STUDY)
    sql["written_records"] = on_cohort(
        """SELECT 'index_cohort' AS output, count(*) AS row_count, CAST(0 AS BIGINT) AS wrong FROM cohort
           UNION ALL SELECT 'attrition manifest', 7, 0"""
    )
    sql["live_cohort"] = on_cohort("SELECT * FROM cohort")
    sql["rule_flags"] = on_cohort("SELECT * FROM flags", MANY_CODES_STUDY, **ruled)
    sql["ruled_cohort"] = on_cohort(_ruled_cohort(MANY_CODES_STUDY), MANY_CODES_STUDY, **ruled)
    sql["raw_file_hash"] = """
        SELECT bucket, CAST(strlen(body) AS BIGINT) AS size_bytes, sha256(body) AS sha256
        FROM (SELECT c_custkey // 500 AS bucket,
                     string_agg(c_custkey || ',' || c_name || ',' || c_mktsegment || chr(10), ''
                                ORDER BY c_custkey) AS body
              FROM customer GROUP BY 1)"""
    sql["partitioned_rewrite"] = """
        SELECT month_code, count(*) AS orders,
            CAST(sum(CASE month_code WHEN '0003' THEN -o_orderkey ELSE o_orderkey END) AS BIGINT) AS key_sum,
            round(sum(o_totalprice), 2) AS total
        FROM (SELECT *, lpad(CAST(month(o_orderdate) AS VARCHAR), 4, '0') AS month_code FROM orders)
        WHERE month_code <> '0007' OR o_orderkey % 2 = 0 GROUP BY month_code"""
    bounds = {
        "code": "code = 'Brand#3'",
        "patients": "patient_id BETWEEN '20' AND '21'",
        "days": "condition_start_date BETWEEN DATE '1998-01-01' AND DATE '1998-02-28'",
        "all": "code = 'Brand#5' AND patient_id BETWEEN '1' AND '3' AND condition_start_date >= DATE '1997-01-01'",
    }
    sql["clustered_reads"] = with_tables(
        _silver_ctes("conditions"),
        " UNION ALL ".join(
            f"""SELECT '{name}' AS bounds, count(*) AS row_count, count(DISTINCT encounter_id) AS encounters,
                TRUE AS skips_half FROM conditions WHERE {held}"""
            for name, held in bounds.items()
        ),
    )
    sql["bronze_contract_check"] = _bronze_contract()
    sql["bronze_verdict"] = _bronze_verdict()
    sql["silver_contract_check"] = _silver_contract()
    sql["silver_contract_measured"] = _silver_contract()
    sql["silver_verdict"] = _silver_verdict()
    resumed = with_tables(silver_from_text, "SELECT count(*) AS n, count(*) FILTER (has_prior_t1dm_before_index) AS p FROM cohort")
    sql["study_resume"] = f"""
        WITH stages(stage, table_name) AS (VALUES ('bronze_patients', 'patients'), ('bronze_encounters', 'encounters'),
            ('bronze_conditions', 'conditions'), ('silver_patients', 'patients'), ('silver_encounters', 'encounters'),
            ('silver_conditions', 'conditions'), ('index_cohort', 'conditions')),
        runs(run) AS (VALUES (1), (2), (3)),
        found AS ({resumed})
        SELECT run, stage,
            CASE WHEN run = 1 OR (run = 3 AND table_name = 'conditions') THEN 'ran' ELSE 'reused' END AS status,
            n AS cohort_rows, CASE WHEN run = 3 THEN 0 ELSE p END AS with_prior
        FROM stages, runs, found"""
    sql["patient_reference_check"] = _reference_check()
    sql["target_signal"] = with_tables(
        _silver_ctes("conditions"),
        f"""SELECT TRUE AS checked, '{BOUND_STUDY.target_code}' AS target_code,
            count(*) AS condition_row_count, {_distinct("patient_id")} AS patient_count,
            min(condition_start_date) AS earliest_date, max(condition_start_date) AS latest_date,
            CASE WHEN count(*) > 0 THEN 'present' ELSE 'absent' END AS status
            FROM conditions {signal}""",
    )
    sql["bronze_target_signal"] = with_tables(
        {"conditions": BRONZE_CTE["conditions"]},
        f"""SELECT TRUE AS checked, '{BOUND_STUDY.window_exclusion_code}' AS target_code,
           count(*) AS condition_row_count, {_distinct('"PATIENT"')} AS patient_count,
           CASE WHEN count(*) > 0 THEN 'present' ELSE 'absent_in_smoke_data' END AS status
           FROM conditions WHERE "CODE" = '{BOUND_STUDY.window_exclusion_code}'""",
    )
    sql["first_event_per_patient"] = on_cohort("SELECT * FROM first_event")
    sql["first_observed"] = on_cohort("SELECT * FROM first_seen")
    sql["exclusion_strict"] = _flags(
        BOUND_STUDY.prior_exclusion_code, "<", "has_prior_t1dm_before_index",
        "first_prior_t1dm_date", "prior_t1dm_row_count",
    )
    sql["exclusion_inclusive"] = _flags(
        BOUND_STUDY.window_exclusion_code, "<=", "has_pregnancy_window_before_or_at_index",
        "first_pregnancy_window_date", "pregnancy_window_row_count",
    )
    sql["age_at_event"] = with_tables(
        _silver_ctes("patients", "encounters"),
        f"""SELECT e.patient_id, encounter_start_date, birth_date,
            {_age("encounter_start_date", "birth_date")} AS age, encounters
            FROM (SELECT patient_id, encounter_start_date, count(*) AS encounters
                FROM encounters GROUP BY ALL) e
            LEFT JOIN patients p ON e.patient_id = p.patient_id""",
    )
    sql["history_days"] = with_tables(
        _silver_ctes("encounters"),
        """SELECT e.patient_id, encounter_start_date,
           CAST(encounter_start_date - first_day AS BIGINT) AS history_days,
           count(*) AS encounters
           FROM encounters e JOIN (SELECT patient_id, min(encounter_start_date) AS first_day
               FROM encounters GROUP BY patient_id) f ON e.patient_id = f.patient_id
           GROUP BY ALL""",
    )
    sql["index_cohort"] = on_cohort("SELECT * FROM cohort")
    sql["index_summary"] = on_cohort(_summary(BOUND_STUDY))
    sql["attrition"] = on_cohort(_attrition())
    sql["final_cohort"] = on_cohort("SELECT * FROM final")
    sql["final_age_stats"] = on_cohort(
        """SELECT (SELECT count(*) FROM cohort) AS index_cohort_rows,
           count(*) AS final_cohort_rows,
           (SELECT count(*) FROM cohort) - count(*) AS excluded_from_final_rows,
           min(age_at_index) AS min_age_at_index, max(age_at_index) AS max_age_at_index,
           avg(age_at_index) AS mean_age_at_index FROM final"""
    )
    sql["numeric_summary"] = on_cohort(
        f"""SELECT position, section, variable, n, round(mean, 6) AS mean, round(sd, 6) AS sd,
            q1, median, q3, min, max FROM ({_numeric_statistics("cohort")})"""
    )
    sql["categorical_summary"] = on_cohort(
        f"""SELECT section, variable, level, n, denominator, line AS level_order,
            CAST(printf('%.1f', CAST(n AS DOUBLE) / denominator * 100) AS DOUBLE) AS percent
            FROM ({_level_rows("cohort")})"""
    )
    sql["baseline_table"] = on_cohort(_report("final"))
    sql["study_parameters"] = on_cohort(_summary(OTHER_STUDY), OTHER_STUDY)
    sql["end_to_end"] = with_tables(silver_from_text, _attrition())

    followed = {"concepts": _concepts(FOLLOWUP_CONCEPTS)}
    sql["concept_signal"] = with_tables(
        {**_silver_ctes("medications"), **followed},
        f"""SELECT concept_set, count(*) AS row_count, {_distinct("patient_id")} AS patient_count,
           min(medication_start_date) AS earliest_date, max(medication_start_date) AS latest_date
           FROM medications m JOIN concepts k ON m.code = k.code GROUP BY concept_set""",
    )
    sql["date_parse_check"] = _date_parse()
    sql["future_date_check"] = _future_dates()
    sql["followup_window"] = on_followup("SELECT * FROM windows")
    sql["baseline_window"] = on_cohort(
        f"""SELECT f.patient_id, f.index_date, count(e.encounter_id) > 0 AS has_baseline_encounter,
            count(e.encounter_id) AS baseline_encounter_count
            FROM (SELECT patient_id, min(index_date) AS index_date FROM final GROUP BY 1) f
            LEFT JOIN encounters e ON e.patient_id = f.patient_id
                AND e.encounter_start_date >= f.index_date - {BOUND_STUDY.baseline_days}
                AND e.encounter_start_date < f.index_date
            GROUP BY f.patient_id, f.index_date"""
    )
    sql["pregnancy_followup"] = on_followup(
        f"""SELECT c.patient_id, TRUE AS has_event_in_window, min(condition_start_date) AS first_date,
            count(*) AS row_count
            FROM conditions c JOIN windows w ON c.patient_id = w.patient_id
            WHERE c.code = '{BOUND_STUDY.window_exclusion_code}'
              AND condition_start_date
                  BETWEEN w.index_date - {BOUND_STUDY.baseline_days} AND w.follow_up_end
            GROUP BY c.patient_id"""
    )
    sql["medication_exposure"] = on_followup(
        f"""SELECT concept_set, count(DISTINCT m.patient_id) AS exposed_patients,
            count(*) AS medication_rows, (SELECT count(*) FROM windows) AS cohort_patients,
            CAST(count(DISTINCT m.patient_id) AS DOUBLE) / (SELECT count(*) FROM windows) * 100
                AS exposed_percent
            FROM medications m JOIN concepts k ON m.code = k.code
            JOIN windows w ON m.patient_id = w.patient_id
            WHERE m.medication_start_date {_IN_WINDOW} GROUP BY concept_set""",
        "medications",
        **followed,
    )
    sql["utilization"] = on_followup(
        f"""SELECT encounter_class, count(*) AS encounters,
            count(DISTINCT e.patient_id) AS patients,
            (SELECT CAST(sum(follow_up_days) AS BIGINT) FROM windows) AS follow_up_days,
            count(*) / ((SELECT CAST(sum(follow_up_days) AS DOUBLE) FROM windows)
                / CAST(365.25 AS DOUBLE)) AS per_patient_year
            FROM encounters e JOIN windows w ON e.patient_id = w.patient_id
            WHERE e.encounter_start_date {_IN_WINDOW} GROUP BY encounter_class"""
    )
    sql["cost_summary"] = on_followup(
        """SELECT kind, count(*) AS patients, round(sum(cost), 5) AS total,
           round(avg(cost), 5) AS mean, round(stddev_samp(cost), 5) AS sd,
           round(min(cost), 5) AS min, round(max(cost), 5) AS max,
           round(quantile_cont(cost, 0.25), 5) AS q1,
           round(quantile_cont(cost, 0.5), 5) AS median,
           round(quantile_cont(cost, 0.75), 5) AS q3
           FROM costs GROUP BY kind""",
        "medications",
        "procedures",
        costs=_COSTS,
    )
    labs = {"concepts": _concepts(LAB_CONCEPTS), "lab_rows": _LAB_ROWS}
    sql["lab_summary"] = on_followup(
        """SELECT concept_set,
           count(*) FILTER (WHERE day >= 0 AND before_end) AS results,
           count(DISTINCT patient_id) FILTER (WHERE day >= 0 AND before_end) AS patients,
           round(avg(value) FILTER (WHERE day >= 0 AND before_end), 6) AS mean,
           min(value) FILTER (WHERE day >= 0 AND before_end) AS min,
           max(value) FILTER (WHERE day >= 0 AND before_end) AS max,
           count(DISTINCT patient_id) FILTER (WHERE day <= 0) AS patients_with_context,
           round(quantile_cont(value, 0.25) FILTER (WHERE day >= 0 AND before_end), 6) AS q1,
           round(quantile_cont(value, 0.5) FILTER (WHERE day >= 0 AND before_end), 6) AS median,
           round(quantile_cont(value, 0.75) FILTER (WHERE day >= 0 AND before_end), 6) AS q3
           FROM lab_rows GROUP BY concept_set""",
        "labs",
        **labs,
    )
    sql["lab_trajectory"] = on_followup(
        """SELECT concept_set, day // 90 AS step, count(*) AS results,
           round(avg(value), 6) AS mean,
           round(CASE WHEN count(*) > 1 THEN stddev_samp(value) ELSE 0.0 END, 6) AS sd
           FROM lab_rows WHERE day >= 0 AND before_end GROUP BY concept_set, step""",
        "labs",
        **labs,
    )
    sql["survival_table"] = on_followup(
        """SELECT day, CAST(at_risk AS BIGINT) AS at_risk, deaths, endings - deaths AS censored,
           round(product(1 - CAST(deaths AS DOUBLE) / CAST(at_risk AS DOUBLE)) OVER (ORDER BY day), 9)
               AS survival
           FROM (SELECT day, deaths, endings,
                        sum(endings) OVER (ORDER BY day DESC) AS at_risk
                 FROM (SELECT follow_up_days AS day, count(*) AS endings,
                              count(*) FILTER (WHERE end_reason = 'death') AS deaths
                       FROM windows GROUP BY 1))"""
    )
    sql["events_in_windows"] = with_tables(
        _silver_ctes("conditions", "encounters"),
        f"""SELECT w.patient_id, kind, window_start, window_end, count(encounter_start_date) AS events,
                min(encounter_start_date) AS first_event, max(encounter_start_date) AS last_event,
                round(sum(total_claim_cost), 2) AS cost
            FROM (SELECT DISTINCT patient_id, kind, condition_start_date + a AS window_start,
                         condition_start_date + b AS window_end
                  FROM conditions, (VALUES ('before', -30, -1), ('after', 0, 90), ('around', -365, 365)) AS k(kind, a, b)
                  WHERE code = '{BOUND_STUDY.target_code}' AND condition_start_date IS NOT NULL) w
            LEFT JOIN encounters e ON e.patient_id = w.patient_id
                AND encounter_start_date BETWEEN window_start AND window_end
            GROUP BY ALL""",
    )
    sql["recurrent_index"] = with_tables(
        _silver_ctes("conditions"),
        f"""SELECT patient_id, day AS index_date,
                CAST(row_number() OVER (PARTITION BY patient_id ORDER BY day) AS INTEGER) AS index_number
            FROM (SELECT patient_id, day, lag(day) OVER (PARTITION BY patient_id ORDER BY day) AS earlier
                  FROM (SELECT DISTINCT patient_id, condition_start_date AS day FROM conditions
                        WHERE code = '{BOUND_STUDY.target_code}' AND patient_id IS NOT NULL
                            AND condition_start_date IS NOT NULL))
            WHERE earlier IS NULL OR day > earlier + 180""",
    )
    sql["drug_era"] = _eras("medications", "medication_start_date", "medication_stop_date", 30, "drug_era", "drug_exposure_count", "drug_source_value")
    sql["condition_era"] = _eras("conditions", "condition_start_date", "condition_stop_date", 30, "condition_era", "condition_occurrence_count", "condition_source_value")
    sql["observation_period"] = _eras("encounters", "encounter_start_date", "encounter_stop_date", 365, "observation_period", "visit_count", None)
    lab_values = {
        **labs,
        "lab_values": """SELECT DISTINCT concept_set, patient_id, observation_date AS day, value_numeric AS v
            FROM labs JOIN concepts USING (code)
            WHERE observation_date IS NOT NULL AND value_numeric IS NOT NULL AND patient_id IS NOT NULL""",
        "lab_sets": "SELECT * FROM (VALUES " + ", ".join(f"('{n}')" for n in LAB_CONCEPTS) + ") AS s(concept_set)",
    }
    sql["lab_nearest_index"] = on_followup(
        """SELECT patient_id, index_date, concept_set, v AS value, day AS value_day FROM (
            SELECT w.patient_id, w.index_date, s.concept_set, v, day, row_number() OVER (
                PARTITION BY w.patient_id, s.concept_set ORDER BY abs(day - index_date) NULLS LAST, day, v DESC) AS rn
            FROM windows w CROSS JOIN lab_sets s
            LEFT JOIN lab_values l ON l.patient_id = w.patient_id AND l.concept_set = s.concept_set)
           WHERE rn = 1""",
        "labs",
        **lab_values,
    )
    sql["lab_carried_forward"] = on_followup(
        """SELECT concept_set, step, count(*) AS patients, count(v) AS with_value, round(avg(v), 6) AS mean,
            round(avg(point_day - day), 6) AS mean_age_days
           FROM (
            SELECT p.*, s.concept_set, v, day, row_number() OVER (
                PARTITION BY p.patient_id, step, s.concept_set ORDER BY day DESC NULLS LAST, v DESC) AS rn
            FROM (SELECT patient_id, CAST(unnest(range(follow_up_days // 90 + 1)) AS INTEGER) AS step,
                         index_date + 90 * step AS point_day FROM windows) p
            CROSS JOIN lab_sets s
            LEFT JOIN lab_values l ON l.patient_id = p.patient_id AND l.concept_set = s.concept_set AND day <= point_day)
           WHERE rn = 1 GROUP BY concept_set, step""",
        "labs",
        **lab_values,
    )
    strata = {
        "strata": f"""SELECT w.*, coalesce(nullif(trim(x.sex), ''), 'Missing') AS stratum
            FROM windows w JOIN (SELECT patient_id, min(sex) AS sex FROM final GROUP BY patient_id) x
            ON w.patient_id = x.patient_id""",
        "risk": """SELECT stratum, day, endings, deaths, sum(endings) OVER (PARTITION BY stratum ORDER BY day DESC) AS n
            FROM (SELECT stratum, follow_up_days AS day, count(*) AS endings,
                         count(*) FILTER (WHERE end_reason = 'death') AS deaths FROM strata GROUP BY ALL)""",
    }
    sql["survival_by_stratum"] = on_followup(
        """SELECT stratum, day, CAST(n AS BIGINT) AS at_risk, deaths, endings - deaths AS censored, round(s, 9) AS survival,
            round(s * sqrt(g), 9) AS standard_error
           FROM (SELECT *, product(1 - deaths / n) OVER (PARTITION BY stratum ORDER BY day) AS s,
                    sum(CASE WHEN deaths < n THEN deaths / (n * (n - deaths)) ELSE 0 END)
                        OVER (PARTITION BY stratum ORDER BY day) AS g
                 FROM (SELECT * REPLACE (CAST(n AS DOUBLE) AS n) FROM risk))""",
        **strata,
    )
    sql["log_rank"] = on_followup(
        """SELECT stratum, patients, observed, round(coalesce(e, 0), 6) AS expected, round(coalesce(v, 0), 6) AS variance,
            CASE WHEN v > 1e-12 THEN round((observed - e) * (observed - e) / v, 6) END AS chi_square
           FROM (SELECT stratum, count(*) AS patients, count(*) FILTER (WHERE end_reason = 'death') AS observed
                 FROM strata GROUP BY stratum)
           LEFT JOIN (
            SELECT stratum, sum(d * own / n) AS e,
                sum(CASE WHEN n > 1 THEN d * (n - d) / (n - 1) * (own / n) * (1 - own / n) ELSE 0 END) AS v
            FROM (SELECT s.stratum, t.day, t.d,
                    (SELECT CAST(count(*) AS DOUBLE) FROM strata w WHERE w.follow_up_days >= t.day) AS n,
                    (SELECT CAST(count(*) AS DOUBLE) FROM strata w WHERE w.follow_up_days >= t.day
                        AND w.stratum = s.stratum) AS own
                  FROM (SELECT DISTINCT stratum FROM strata) s,
                    (SELECT follow_up_days AS day, count(*) AS d FROM strata WHERE end_reason = 'death' GROUP BY 1) t)
            GROUP BY stratum) USING (stratum)""",
        **strata,
    )
    model = {
        "person": ("patients", "birth_date"),
        "visit_occurrence": ("encounters", "encounter_start_date"),
        "condition_occurrence": ("conditions", "condition_start_date"),
        "drug_exposure": ("medications", "medication_start_date"),
        "measurement": ("observations", "observation_date"),
        "procedure_occurrence": ("procedures", "procedure_start_date"),
    }
    sql["common_model"] = with_tables(
        _silver_ctes(*(t for t, _ in model.values())),
        " UNION ALL ".join(
            f"""SELECT '{target}' AS table_name, count(*) AS row_count,
                count(DISTINCT patient_id) AS person_count, min({day}) AS first_date,
                max({day}) AS last_date FROM {table}"""
            for target, (table, day) in model.items()
        ),
    )
    narrow = {
        "person": """SELECT patient_id AS person_source_value, birth_year AS year_of_birth,
            birth_date, death_date, sex AS gender_source_value, race AS race_source_value,
            ethnicity AS ethnicity_source_value FROM patients""",
        "visit": """SELECT encounter_id AS visit_source_value, patient_id AS person_source_value,
            encounter_start_date AS visit_start_date, encounter_stop_date AS visit_end_date,
            encounter_class AS visit_type FROM encounters""",
        "condition": """SELECT patient_id AS person_source_value,
            encounter_id AS visit_source_value, condition_start_date,
            condition_stop_date AS condition_end_date, code AS condition_source_value
            FROM conditions""",
        "drug": """SELECT patient_id AS person_source_value, encounter_id AS visit_source_value,
            medication_start_date AS drug_exposure_start_date,
            medication_stop_date AS drug_exposure_end_date, code AS drug_source_value,
            dispenses AS quantity FROM medications""",
        "measurement": """SELECT patient_id AS person_source_value,
            encounter_id AS visit_source_value, observation_date AS measurement_date,
            code AS measurement_source_value, value_numeric AS value_as_number,
            units AS unit_source_value FROM observations""",
        "procedure": """SELECT patient_id AS person_source_value,
            encounter_id AS visit_source_value, procedure_start_date AS procedure_date,
            code AS procedure_source_value FROM procedures""",
    }
    for name, body in narrow.items():
        sql[f"common_model_{name}"] = with_tables(_silver_ctes(body.rsplit(" ", 1)[1]), body)
    for name in ("medication_exposure", "utilization", "cost_summary", "lab_summary"):
        sql[f"{name}_large"] = sql[name]
    sql["index_cohort_staged"] = sql["index_cohort_staged_large"] = sql["index_cohort"]
    statistics = ", ".join(
        f"printf('%.8e', {expression}) AS {name}"
        for name, expression in (
            ("total", "sum(cost)"), ("mean", "avg(cost)"), ("sd", "stddev_samp(cost)"),
            ("min", "min(cost)"), ("q1", "quantile_cont(cost, 0.25)"),
            ("median", "quantile_cont(cost, 0.5)"), ("q3", "quantile_cont(cost, 0.75)"),
            ("max", "max(cost)"),
        )
    )
    sql["study_outputs"] = _study_outputs()
    sql["bronze_cells"] = """
        SELECT 'documents' AS table_name, CAST(doc_id AS VARCHAR) AS cell_0,
            nullif(text, '') AS cell_1, nullif(lang, '') AS cell_2, nullif(source, '') AS cell_3,
            CAST(n_chars AS VARCHAR) AS cell_4 FROM documents
        UNION ALL SELECT 'conversations', CAST(conv_id AS VARCHAR), CAST(turn AS VARCHAR),
            nullif(role, ''), nullif(text, ''), NULL FROM conversations
        UNION ALL SELECT 'pages', CAST(page_id AS VARCHAR), nullif(url, ''), nullif(html, ''),
            NULL, NULL FROM pages"""
    sql["bronze_expected_only"] = """
        SELECT 'nation' AS table_name, (SELECT count(*) FROM nation) AS row_count,
            CAST(3 AS INTEGER) AS column_count, 'converted' AS status
        UNION ALL SELECT 'supplier', (SELECT count(*) FROM supplier), 4, 'converted'
        UNION ALL SELECT 'part', NULL, NULL, 'failed'"""
    sql["raw_inventory_blank_lines"] = """
        SELECT name AS filename, (SELECT count(*) FROM orders) AS row_count, 'key,note' AS header,
            'present' AS status FROM (VALUES ('plain.csv'), ('spanning.csv')) AS f(name)"""
    sql["cost_extremes"] = f"""
        WITH amounts AS (
            SELECT o_custkey, CAST(CASE o_orderkey % 7 WHEN 0 THEN 10.005 WHEN 1 THEN 1e17
                WHEN 2 THEN NULL WHEN 3 THEN 0.00004 WHEN 4 THEN NULL ELSE trunc(o_totalprice) END
                AS DOUBLE) AS amount FROM orders),
        costs AS (
            SELECT 'large' AS kind, c_custkey, coalesce(sum(amount), 0) AS cost
            FROM customer LEFT JOIN amounts ON c_custkey = o_custkey GROUP BY c_custkey
            UNION ALL
            SELECT 'small', c_custkey, coalesce(sum(amount), 0)
            FROM customer LEFT JOIN amounts ON c_custkey = o_custkey AND amount < 1000
            GROUP BY c_custkey)
        SELECT kind, count(*) AS patients, {statistics} FROM costs GROUP BY kind"""
    sql["lab_extremes"] = """
        SELECT concept_set, step, count(*) AS results, printf('%.8e', avg(v)) AS mean,
            printf('%.3e', CASE WHEN count(*) > 1 THEN stddev_samp(v) ELSE 0.0 END) AS sd
        FROM (SELECT event_type AS concept_set, CAST((event_id % 400) // 90 AS BIGINT) AS step,
            CASE event_type WHEN 'click' THEN CAST(0.00004 AS DOUBLE) + (event_id % 3) * CAST(1e-6 AS DOUBLE)
                WHEN 'view' THEN CAST(1e9 AS DOUBLE) + (event_id % 3) * CAST(0.125 AS DOUBLE)
                ELSE value END AS v FROM events)
        GROUP BY concept_set, step"""
    sql["quantiles_many_groups"] = """
        SELECT o_custkey, round(quantile_cont(o_totalprice, 0.25), 4) AS q1,
            round(quantile_cont(o_totalprice, 0.5), 4) AS median,
            round(quantile_cont(o_totalprice, 0.75), 4) AS q3
        FROM orders GROUP BY o_custkey"""
    return sql
