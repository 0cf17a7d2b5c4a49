"""Study rules and fixed values, kept apart from the operators that use them."""

from __future__ import annotations

from dataclasses import dataclass

# --- Fixed values: they decide results, so they are stated once, as text. ---

SEX_CODES = {"M": ("M", "MALE"), "F": ("F", "FEMALE")}

LABEL_WORDS = {"%": "pct", "/": "per", "+": "plus", "#": "num"}
LABEL_MAX_LENGTH = 55
LABEL_EMPTY = "unnamed"
LABEL_DIGIT_PREFIX = "lab_"

SPLIT_NAMES = ("train", "validation", "test")
SPLIT_WEIGHTS = (70, 15, 15)
SPLIT_SALT = "angina-v1"
CONTROL_SALT = "ctl"

TIER_BOUNDS = (("complete", 0.10), ("partial", 0.50), ("sparse", 0.90))
TIER_REST = "mostly_missing"

AGE_BANDS = (("under_45", 45), ("45_64", 65), ("65_79", 80))
AGE_BAND_REST = "80_plus"

LEAD_ORDER = ("I", "II", "III", "aVR", "aVL", "aVF", "V1", "V2", "V3", "V4", "V5", "V6")

METRIC_NAMES = ("roc_auc", "pr_auc", "f1", "recall", "precision", "accuracy")

# Fixed value: what stands for NULL in a surrogate key.
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"


@dataclass(frozen=True)
class StudyRules:
    """What makes a stay a case, a control, or a source of features."""

    # Fixed values of the study protocol.
    case_prefixes: tuple[str, ...] = ("I20", "I251")
    exclusion_prefixes: tuple[str, ...] = ("I",)
    code_version: int = 10
    unranked_sequence: int = 99
    adult_age: int = 18
    age_range: tuple[int, int] = (0, 120)
    acute_patterns: tuple[str, ...] = ("troponin", "ck-mb")
    target_patterns: tuple[str, ...] = (
        "troponin", "ck-mb", "ldl", "hdl", "cholesterol", "glucose",
        "creatinine", "hemoglobin", "hematocrit", "platelet", "potassium",
        "sodium", "bicarbonate", "urea nitrogen", "albumin",
        "white blood cells", "magnesium",
    )
    inside_stay_only: bool = True
    controls_per_case: float = 1
    minimum_controls: int = 1
    point_grace_hours: int = 12
    point_reach_hours: int = 72
    max_stay_hours: int = 8760
    case_name: str = "angina"
    control_name: str = "control"


RULES = StudyRules()
