"""Scalar Column functions."""

from trendspark.functions.scalars import (  # noqa: F401
    epoch_ms_to_timestamp,
    kda_adjusted,
    kda_strict,
    patch_from_version,
    per_minute,
    queue_name,
    safe_divide,
    seconds_to_minutes,
    split_identifier,
    surrogate_key,
    win_label,
)
