from lumbung.functions.clean import (
    blank_to_unknown,
    category_of,
    equality_flag,
    first_existing_column,
    literal_tags,
    ordinal_rank,
    prefixed_id,
    presence_flag,
    recode,
    rescale,
    safe_date,
    text_key,
    threshold_label,
    whole_number,
)
from lumbung.functions.identity import (
    collision_report,
    global_id,
    key_collisions,
    packed_id,
    pii_hash,
    surrogate_key,
    unpacked_id,
)
from lumbung.functions.standardize import Mapping, standardize, standardize_with_table

__all__ = [
    "Mapping",
    "blank_to_unknown",
    "category_of",
    "collision_report",
    "equality_flag",
    "first_existing_column",
    "global_id",
    "key_collisions",
    "literal_tags",
    "ordinal_rank",
    "packed_id",
    "pii_hash",
    "prefixed_id",
    "presence_flag",
    "recode",
    "rescale",
    "safe_date",
    "standardize",
    "standardize_with_table",
    "surrogate_key",
    "text_key",
    "threshold_label",
    "unpacked_id",
    "whole_number",
]
