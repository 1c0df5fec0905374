from lumbung.operators.conform import distinct_values, stack_values, union_all
from lumbung.operators.dedup import dedup_by_key, pick_per_entity
from lumbung.operators.dimensions import date_dimension, value_dimension
from lumbung.operators.facts import Flag, KeyLookup, build_fact
from lumbung.operators.gate import (
    Rule,
    at_least,
    not_after,
    quality_gate,
    reject_report,
    required,
    tag_rejects,
    within,
)
from lumbung.operators.load import audit_columns, new_batch_id, new_rows
from lumbung.operators.lookup import bounded, lookup, salted_lookup

__all__ = [
    "Flag",
    "KeyLookup",
    "Rule",
    "at_least",
    "audit_columns",
    "bounded",
    "build_fact",
    "date_dimension",
    "dedup_by_key",
    "distinct_values",
    "lookup",
    "new_batch_id",
    "new_rows",
    "not_after",
    "pick_per_entity",
    "quality_gate",
    "reject_report",
    "required",
    "salted_lookup",
    "stack_values",
    "tag_rejects",
    "union_all",
    "value_dimension",
    "within",
]
