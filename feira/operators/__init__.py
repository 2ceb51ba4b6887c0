"""Operators over whole DataFrames."""

from feira.operators.assign import assign_nearest
from feira.operators.audit import dropped_by_rule, orphans, row_audit, rule_audit
from feira.operators.curve import along_curve
from feira.operators.dedup import distinct_rows, keep_first
from feira.operators.lookup import translate_or_keep

__all__ = [
    "along_curve",
    "assign_nearest",
    "distinct_rows",
    "dropped_by_rule",
    "keep_first",
    "orphans",
    "row_audit",
    "rule_audit",
    "translate_or_keep",
]
