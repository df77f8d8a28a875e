from tillroll.operators.cleanse import (
    apply_defaults,
    bad_timestamps,
    cast_faults,
    cast_strict,
    conform,
    normalize_nulls,
    rejected_rows,
    rename_columns,
    required_keys,
    split_casts,
    standardize_text,
)
from tillroll.operators.fingerprint import fingerprint_checks, read_fingerprint
from tillroll.operators.keys import assign_dense_key, extend_dense_key
from tillroll.operators.lookup import known_only, lookup
from tillroll.operators.quality import (
    distinct_dense_keys,
    fk_violations,
    length_violations,
    null_violations,
    pk_violations,
    range_violations,
    row_checks,
)
from tillroll.operators.ranking import dedupe, top_n_per_group

__all__ = [
    "apply_defaults",
    "assign_dense_key",
    "bad_timestamps",
    "cast_faults",
    "cast_strict",
    "conform",
    "dedupe",
    "distinct_dense_keys",
    "extend_dense_key",
    "fingerprint_checks",
    "fk_violations",
    "length_violations",
    "known_only",
    "lookup",
    "normalize_nulls",
    "null_violations",
    "pk_violations",
    "range_violations",
    "read_fingerprint",
    "rejected_rows",
    "rename_columns",
    "required_keys",
    "row_checks",
    "split_casts",
    "standardize_text",
    "top_n_per_group",
]
