"""Code maps (PRJ2) and the reason-code lookup (SC24).

All are plain CASE expressions built from literal tables, so they stay inside
whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values: must equal the migrated tracker's codes -------------------
SEVERITY_TO_REPORTED = {"A": "1 - Show-Stopper", "B": "2 - Critical", "C": "3 - Major", "D": "4 - Minor"}
PRIORITY_CODES = {"@": "P1", "ß": "P2", "*": "P3", "H": "P4"}
PRIORITY_DIGITS = {"@": "1", "ß": "2", "*": "3", "H": "4"}
DEFECT_DEFAULT_PRIORITY = "P5"
FIX_DEFAULT_PRIORITY = "P3"
SOURCE_LABELS = {
    "Unknown": "Unknown", "Configuration": "Configuration", "Style Guide Violatn": "StyleGuideViolation",
    "Spec Violation": "SpecViolation", "Design Error": "Design", "Design": "Design", "No Spec11": "NoSpec",
    "No Spec": "NoSpec", "Regression": "Regression", "DOCO": "Documentation",
    "Implementation Error": "Implementation",
}
FIX_TYPE_TO_PARENT_TYPE = {"F": "New Feature", "S": "Bug"}
FIX_TYPE_DEFAULT = "Feature Enhancement"
WAITING_ON_STATUS = {"Analyst": "Accepted", "Team Leader": "Development Complete",
                     "Release Mgr": "Development Complete", "Build": "Development Complete",
                     "QA": "Awaiting Verification", "Done": "Resolved"}
WAITING_DONE = ("Pull", "Done")
WAITING_REASONS = {"Future Release": "No Plans to Fix", "Need More Info": "Incomplete",
                   "Mystery": "Cannot Reproduce"}
CLOSED_REASONS = {"No Problem": "Works As Designed", "No Fix": "No Plans to Fix"}
CLOSED_REASON_DEFAULT = "No Longer Valid"
# history resolution items: lower-cased reason -> (to, toString)
HISTORY_REASONS = {"fixed": (1, "Fixed"), "no problem": (2, "Works as Designed"), "duplicate": (3, "Duplicate"),
                   "need more info": (4, "Incomplete"), "mystery": (5, "Cannot Reproduce"),
                   "no fix": (7, "No plans to fix")}
# defect log line types that become status history: lower-cased type -> (to, toString)
LOG_STATUS = {"reported": (1, "Open"), "wait": (3, "Accepted"), "closed": (6, "Resolved"), "open": (1, "Open")}
UNRESOLVED = ""
# ------------------------------------------------------------------------------


def map_code(col: Column, table: dict, default=None) -> Column:
    """Simple CASE ``col WHEN k THEN v ... ELSE default``; NULL input gives the default."""
    expr = None
    for key, value in table.items():
        expr = F.when(col == F.lit(key), F.lit(value)) if expr is None else expr.when(col == F.lit(key), F.lit(value))
    default_col = F.lit(default) if not isinstance(default, Column) else default
    return default_col if expr is None else expr.otherwise(default_col)


def reported_priority(severity: Column) -> Column:
    return map_code(severity, SEVERITY_TO_REPORTED, None).cast("string")


def priority(code: Column, default: str = DEFECT_DEFAULT_PRIORITY) -> Column:
    return map_code(code, PRIORITY_CODES, default)


def source_label(source: Column) -> Column:
    return map_code(source, SOURCE_LABELS, None).cast("string")


def defect_issue_type(prob_enh: Column) -> Column:
    return F.when(prob_enh == "E", "Feature Enhancement").otherwise("Bug")


def fix_parent_type(fix_type: Column) -> Column:
    return map_code(fix_type, FIX_TYPE_TO_PARENT_TYPE, FIX_TYPE_DEFAULT)


def fix_status(waiting_on: Column, is_released: Column) -> Column:
    """Fix status from the waiting-on code; ``Pull`` depends on the target catalog row."""
    pull = F.when(is_released == F.lit(False), "Awaiting Release").otherwise("Resolved")
    return F.when(waiting_on == "Pull", pull).otherwise(map_code(waiting_on, WAITING_ON_STATUS, None).cast("string"))


def fix_done_and_released(waiting_on: Column, is_released: Column) -> Column:
    return waiting_on.isin(*WAITING_DONE) & (is_released == F.lit(True))


def fix_parent_status(waiting_on: Column, is_released: Column) -> Column:
    return F.when(fix_done_and_released(waiting_on, is_released), "Resolved").otherwise("Awaiting Resolutions")


def fix_parent_resolution(waiting_on: Column, is_released: Column) -> Column:
    return F.when(fix_done_and_released(waiting_on, is_released), "Fixed").otherwise("Waiting")


def fix_resolution(waiting_on: Column) -> Column:
    return F.when(waiting_on.isin(*WAITING_DONE), "Fixed").otherwise(UNRESOLVED)


def reason_struct(reason: Column) -> Column:
    """SC24: reason code -> struct(to int, toString) or NULL when the code is not a known reason."""
    low = F.lower(reason)
    to = map_code(low, {k: v[0] for k, v in HISTORY_REASONS.items()}, None).cast("int")
    to_string = map_code(low, {k: v[1] for k, v in HISTORY_REASONS.items()}, None).cast("string")
    return F.when(to.isNotNull(), F.struct(to.alias("to"), to_string.alias("toString")))
