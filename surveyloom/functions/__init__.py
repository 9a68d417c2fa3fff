"""Column functions: each takes and returns a Spark ``Column``."""

from .cells import (  # noqa: F401
    any_reported,
    as_number,
    between,
    code_levels,
    composite_id,
    count_positive,
    flag,
    flag_all,
    flag_contains,
    flag_eq,
    flag_in,
    flag_reported,
    if_else,
    label_rules,
    map_values,
    norm_cat,
    normalize_text,
    null_if_nan,
    ratio,
    row_sum,
    safe_divide,
    strip_accents,
    zfill,
)
