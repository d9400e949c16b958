"""Study, scenario and table definitions: plain frozen values handed to the plans."""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# They must equal the published study definition for equal results.
# ---------------------------------------------------------------------------
TARGET_CODE = "44054006"
PRIOR_EXCLUSION_CODE = "46635009"
WINDOW_EXCLUSION_CODE = "77386006"
MINIMUM_AGE_YEARS = 18
BASELINE_DAYS = 365
FOLLOW_UP_MONTHS = 24
COHORT_NAME = "t2dm_index_cohort"

REQUIRED_RAW_FILES = (
    "patients.csv",
    "encounters.csv",
    "conditions.csv",
    "medications.csv",
    "observations.csv",
    "procedures.csv",
    "careplans.csv",
)
OPTIONAL_RAW_FILES = (
    "allergies.csv",
    "immunizations.csv",
    "devices.csv",
    "payer_transitions.csv",
    "payers.csv",
    "providers.csv",
    "organizations.csv",
    "claims.csv",
    "claims_transactions.csv",
)

# Columns a raw (all-string) table must have.
BRONZE_CONTRACT = {
    "patients": ("Id", "BIRTHDATE"),
    "encounters": ("Id", "START", "PATIENT", "CODE", "DESCRIPTION"),
    "conditions": ("START", "PATIENT", "CODE", "DESCRIPTION"),
    "medications": ("START", "PATIENT", "CODE", "DESCRIPTION"),
    "observations": ("DATE", "PATIENT", "CODE", "DESCRIPTION"),
    "procedures": ("START", "PATIENT", "CODE", "DESCRIPTION"),
    "careplans": ("Id", "START", "PATIENT", "CODE", "DESCRIPTION"),
}

# Columns a typed table must have.
SILVER_CONTRACT = {
    "patients": (
        "patient_id", "birth_date", "death_date", "sex", "race", "ethnicity",
        "birth_year", "source_table",
    ),
    "encounters": (
        "encounter_id", "patient_id", "encounter_start_date", "encounter_stop_date",
        "code", "description", "source_table",
    ),
    "conditions": (
        "patient_id", "encounter_id", "condition_start_date", "condition_stop_date",
        "code", "description", "source_table",
    ),
    "medications": (
        "patient_id", "encounter_id", "medication_start_date", "medication_stop_date",
        "code", "description", "source_table",
    ),
    "observations": (
        "patient_id", "encounter_id", "observation_date", "code", "description",
        "value_raw", "value_numeric", "units", "source_table",
    ),
    "procedures": (
        "patient_id", "encounter_id", "procedure_start_date", "procedure_stop_date",
        "code", "description", "source_table",
    ),
    "careplans": (
        "careplan_id", "patient_id", "encounter_id", "careplan_start_date",
        "careplan_stop_date", "code", "description", "source_table",
    ),
}

# Typed date columns; the first one of each table is the one that should not be null.
SILVER_DATES = {
    "patients": ("birth_date", "death_date"),
    "encounters": ("encounter_start_date", "encounter_stop_date"),
    "conditions": ("condition_start_date", "condition_stop_date"),
    "medications": ("medication_start_date", "medication_stop_date"),
    "observations": ("observation_date",),
    "procedures": ("procedure_start_date", "procedure_stop_date"),
    "careplans": ("careplan_start_date", "careplan_stop_date"),
}

# Silver layouts in output order: (source column, output column, kind).
SILVER_LAYOUT = {
    "patients": (
        ("Id", "patient_id", "text"),
        ("BIRTHDATE", "birth_date", "date"),
        ("DEATHDATE", "death_date", "date"),
        ("GENDER", "sex", "text"),
        ("RACE", "race", "text"),
        ("ETHNICITY", "ethnicity", "text"),
        ("MARITAL", "marital_status", "text"),
        ("CITY", "city", "text"),
        ("STATE", "state", "text"),
        ("COUNTY", "county", "text"),
        ("ZIP", "zip", "text"),
        ("BIRTHDATE", "birth_year", "year"),
    ),
    "encounters": (
        ("Id", "encounter_id", "text"),
        ("PATIENT", "patient_id", "text"),
        ("START", "encounter_start_date", "date"),
        ("STOP", "encounter_stop_date", "date"),
        ("ORGANIZATION", "organization_id", "text"),
        ("PROVIDER", "provider_id", "text"),
        ("PAYER", "payer_id", "text"),
        ("ENCOUNTERCLASS", "encounter_class", "text"),
        ("CODE", "code", "text"),
        ("DESCRIPTION", "description", "text"),
        ("REASONCODE", "reason_code", "text"),
        ("REASONDESCRIPTION", "reason_description", "text"),
        ("BASE_ENCOUNTER_COST", "base_encounter_cost", "number"),
        ("TOTAL_CLAIM_COST", "total_claim_cost", "number"),
        ("PAYER_COVERAGE", "payer_coverage", "number"),
    ),
    "conditions": (
        ("PATIENT", "patient_id", "text"),
        ("ENCOUNTER", "encounter_id", "text"),
        ("START", "condition_start_date", "date"),
        ("STOP", "condition_stop_date", "date"),
        ("CODE", "code", "text"),
        ("DESCRIPTION", "description", "text"),
    ),
    "medications": (
        ("PATIENT", "patient_id", "text"),
        ("ENCOUNTER", "encounter_id", "text"),
        ("PAYER", "payer_id", "text"),
        ("START", "medication_start_date", "date"),
        ("STOP", "medication_stop_date", "date"),
        ("CODE", "code", "text"),
        ("DESCRIPTION", "description", "text"),
        ("BASE_COST", "base_cost", "number"),
        ("PAYER_COVERAGE", "payer_coverage", "number"),
        ("DISPENSES", "dispenses", "number"),
        ("TOTALCOST", "total_cost", "number"),
        ("REASONCODE", "reason_code", "text"),
        ("REASONDESCRIPTION", "reason_description", "text"),
    ),
    "observations": (
        ("PATIENT", "patient_id", "text"),
        ("ENCOUNTER", "encounter_id", "text"),
        ("DATE", "observation_date", "date"),
        ("CATEGORY", "category", "text"),
        ("CODE", "code", "text"),
        ("DESCRIPTION", "description", "text"),
        ("VALUE", "value_raw", "text"),
        ("VALUE", "value_numeric", "number"),
        ("UNITS", "units", "text"),
        ("TYPE", "value_type", "text"),
    ),
    "procedures": (
        ("PATIENT", "patient_id", "text"),
        ("ENCOUNTER", "encounter_id", "text"),
        ("START", "procedure_start_date", "date"),
        ("STOP", "procedure_stop_date", "date"),
        ("CODE", "code", "text"),
        ("DESCRIPTION", "description", "text"),
        ("BASE_COST", "base_cost", "number"),
        ("REASONCODE", "reason_code", "text"),
        ("REASONDESCRIPTION", "reason_description", "text"),
    ),
    "careplans": (
        ("Id", "careplan_id", "text"),
        ("PATIENT", "patient_id", "text"),
        ("ENCOUNTER", "encounter_id", "text"),
        ("START", "careplan_start_date", "date"),
        ("STOP", "careplan_stop_date", "date"),
        ("CODE", "code", "text"),
        ("DESCRIPTION", "description", "text"),
        ("REASONCODE", "reason_code", "text"),
        ("REASONDESCRIPTION", "reason_description", "text"),
    ),
}

# Concept sets: name -> (vocabulary, use, ((code, display), ...)). Lists may be empty.
CONCEPT_SETS = {
    "type_2_diabetes_mellitus": (
        "SNOMED-CT", "target_condition", (("44054006", "Diabetes mellitus type 2"),),
    ),
    "type_1_diabetes_mellitus": (
        "SNOMED-CT", "exclusion", (("46635009", "Diabetes mellitus type 1"),),
    ),
    "pregnancy": (
        "SNOMED-CT", "exclusion_or_gestational_window_control", (("77386006", "Pregnancy"),),
    ),
    "heart_failure_hospitalization": (
        "SNOMED-CT", "possible_event_component", (("85232005", "Heart failure"),),
    ),
    "myocardial_infarction": (
        "SNOMED-CT", "possible_mace_component", (("57054005", "Acute myocardial infarction"),),
    ),
    "ischemic_stroke": (
        "SNOMED-CT", "possible_mace_component", (("230690007", "Cerebrovascular accident"),),
    ),
    "metformin": ("RxNorm", "baseline_treatment_context", (("860974", "Metformin"),)),
    "sglt2_inhibitors": (
        "RxNorm", "phase1_treatment_pattern_analysis",
        (("1537213", "Canagliflozin"), ("1373456", "Dapagliflozin")),
    ),
    "glp1_receptor_agonists": (
        "RxNorm", "phase1_treatment_pattern_analysis",
        (("1991302", "Semaglutide"), ("1151131", "Liraglutide")),
    ),
    "a1c": ("LOINC", "diabetes_monitoring_context", ()),
    "glucose": ("LOINC", "diabetes_monitoring_context", ()),
    "diabetes_monitoring": ("mixed", "monitoring_context", ()),
}
# ---------------------------------------------------------------------------
# End of fixed values.
# ---------------------------------------------------------------------------

# Which concept sets the follow-up summaries are about, by their declared use.
MEDICATION_USES = ("baseline_treatment_context", "phase1_treatment_pattern_analysis")
LAB_USES = ("diabetes_monitoring_context", "monitoring_context")


def sets_for(concept_sets: dict, uses) -> dict:
    return {name: entry for name, entry in concept_sets.items() if entry[1] in uses}


def concept_version(concept_sets: dict) -> str:
    """Digest of the sets' vocabularies, uses and codes: which codes a run used."""
    plain = json.dumps(concept_sets, sort_keys=True, ensure_ascii=True)
    return hashlib.sha256(plain.encode()).hexdigest()


CORE_TABLES = tuple(SILVER_LAYOUT)
EVENT_TABLES = tuple(name for name in CORE_TABLES if name != "patients")


def table_names(filenames) -> list[str]:
    """`patients.csv` -> `patients`: a table is named after its file's stem."""
    return [name.rsplit("/", 1)[-1].rsplit(".", 1)[0] for name in filenames]


def plain_codes(codes) -> str | tuple[str, ...]:
    """One code as text, several as a tuple without repeats."""
    if isinstance(codes, (tuple, list)):
        several = tuple(dict.fromkeys(str(c) for c in codes))
        return several[0] if len(several) == 1 else several
    return str(codes)


def codes_text(codes) -> str:
    """How outputs show a rule's codes; nothing reads it back."""
    return "|".join(codes) if isinstance(codes, (tuple, list)) else str(codes)


@dataclass(frozen=True)
class Rule:
    """Dated events with one of `codes` that lie within bounds count; `least` of them meet the rule.

    Bounds are days relative to a date of the patient: from `anchor` + `from_days` to `to_anchor`
    (`anchor` if not given) + `to_days`, both included unless `from_strict` or `strict`; a bound
    without days is open. An `exclude` rule must not be met, a `require` rule must."""

    rule_id: str
    codes: tuple[str, ...]
    anchor: str = "index_date"
    from_days: int | None = None
    to_days: int | None = 0
    to_anchor: str | None = None
    from_strict: bool = False
    strict: bool = False
    least: int = 1
    kind: str = "exclude"

    def __post_init__(self):
        codes = self.codes if isinstance(self.codes, (tuple, list)) else (self.codes,)
        object.__setattr__(self, "codes", tuple(dict.fromkeys(str(c) for c in codes)))
        if not self.rule_id.isidentifier():
            raise ValueError(f"A rule is named like a column: {self.rule_id!r}")
        if self.kind not in ("exclude", "require"):
            raise ValueError(f"A rule excludes or requires, got {self.kind!r}")
        if self.least < 1:
            raise ValueError(f"A rule needs one event at least, got {self.least}")

    @property
    def last_anchor(self) -> str:
        return self.to_anchor or self.anchor


@dataclass(frozen=True)
class StudySpec:
    """What qualifies, what excludes, and the thresholds. A rule holds one code, or several as a
    tuple; `from_concepts` takes them from concept sets. `rules` are further ones, see `Rule`."""

    target_code: str | tuple[str, ...] = TARGET_CODE
    prior_exclusion_code: str | tuple[str, ...] = PRIOR_EXCLUSION_CODE
    window_exclusion_code: str | tuple[str, ...] = WINDOW_EXCLUSION_CODE
    minimum_age_years: int = MINIMUM_AGE_YEARS
    baseline_days: int = BASELINE_DAYS
    follow_up_months: int = FOLLOW_UP_MONTHS
    cohort_name: str = COHORT_NAME
    rules: tuple[Rule, ...] = ()

    def __post_init__(self):
        object.__setattr__(self, "rules", tuple(self.rules))
        if len({r.rule_id for r in self.rules}) < len(self.rules):
            raise ValueError("Two rules have one name")
        for name in ("minimum_age_years", "baseline_days", "follow_up_months"):
            value = getattr(self, name)
            if isinstance(value, bool) or not isinstance(value, int) or value < 0:
                raise ValueError(f"{name} must be a non-negative integer, got {value!r}")
        for name in ("target_code", "prior_exclusion_code", "window_exclusion_code"):
            object.__setattr__(self, name, plain_codes(getattr(self, name)))

    @classmethod
    def from_concepts(
        cls,
        concept_sets: dict = CONCEPT_SETS,
        target: str = "type_2_diabetes_mellitus",
        prior_exclusion: str = "type_1_diabetes_mellitus",
        window_exclusion: str = "pregnancy",
        **other,
    ) -> StudySpec:
        """Rules with all codes of the named concept sets."""
        codes = [
            tuple(code for code, _ in concept_sets[name][2])
            for name in (target, prior_exclusion, window_exclusion)
        ]
        if not all(codes):
            raise ValueError("A rule's concept set has no codes")
        return cls(*codes, **other)


@dataclass(frozen=True)
class Scenario:
    """Where one run's layers live and which raw files it expects."""

    scenario_id: str
    name: str
    raw_dir: str
    bronze_dir: str
    silver_dir: str
    gold_dir: str
    report_dir: str
    required_files: tuple[str, ...] = REQUIRED_RAW_FILES
    optional_files: tuple[str, ...] = OPTIONAL_RAW_FILES
    generator: dict[str, str] = field(default_factory=dict)
    reference_date: str | None = None
    model_dir: str | None = None  # common data model; default: a folder of the gold layer

    @property
    def expected_files(self) -> tuple[str, ...]:
        return tuple(self.required_files) + tuple(self.optional_files)
