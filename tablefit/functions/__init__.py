from tablefit.functions.expr import (
    as_col,
    clamp_min,
    hex_hash,
    hash_bucket,
    null_safe_mean,
    recode_above,
    recode_equal,
    round_half_away,
    safe_ratio,
    ordinal_class,
)

__all__ = [
    "as_col",
    "clamp_min",
    "hex_hash",
    "hash_bucket",
    "null_safe_mean",
    "recode_above",
    "recode_equal",
    "safe_ratio",
    "round_half_away",
    "ordinal_class",
]
