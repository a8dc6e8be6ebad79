"""Column expressions shared by the operators (all JVM-side, no Python UDFs)."""

from handoff.functions.columns import (
    is_missing,
    nan_to_null,
    pseudo_score,
    ratio,
    right_closed_bucket,
    seeded_hash,
    strip_text,
)
from handoff.functions.names import closest_name

__all__ = [
    "closest_name",
    "is_missing",
    "nan_to_null",
    "pseudo_score",
    "ratio",
    "right_closed_bucket",
    "seeded_hash",
    "strip_text",
]
