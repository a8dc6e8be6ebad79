"""Column roles and fixed parameters, passed explicitly instead of hard-coded names."""

from __future__ import annotations

from dataclasses import dataclass, field
from types import MappingProxyType
from typing import Mapping


def _frozen(m: Mapping | None) -> Mapping:
    return MappingProxyType(dict(m or {}))


@dataclass(frozen=True)
class Config:
    """Everything a hand-over needs to know about a table's columns.

    primary_key      one column that identifies a row
    target           binary 0/1 outcome column
    protected        attributes measured for fairness, never model inputs
    entity_map       {column: {raw spelling: canonical spelling}}, exact match after strip
    units            {column: unit}
    int_columns      integer-by-meaning columns, cast to bigint only when they hold no null
    categorical_extra numeric columns that are categorical by meaning (grouped in outcome stats)
    seed             seed of every sampled or shuffled step
    """

    primary_key: str
    target: str
    protected: tuple[str, ...] = ()
    entity_map: Mapping[str, Mapping[str, str]] = field(default_factory=dict)
    units: Mapping[str, str] = field(default_factory=dict)
    int_columns: tuple[str, ...] = ()
    categorical_extra: tuple[str, ...] = ()
    seed: int = 42

    def __post_init__(self):
        object.__setattr__(self, "protected", tuple(self.protected))
        object.__setattr__(self, "int_columns", tuple(self.int_columns))
        object.__setattr__(self, "categorical_extra", tuple(self.categorical_extra))
        object.__setattr__(
            self, "entity_map", _frozen({k: _frozen(v) for k, v in (self.entity_map or {}).items()})
        )
        object.__setattr__(self, "units", _frozen(self.units))


# Fixed values that must equal the reference's for equal results.
CONTRACT_VERSION = "1.0"
CONTRACT_DTYPES = ("int", "float", "category", "bool")
CONTRACT_ROLES = ("id", "target", "feature", "protected")
FAULT_PRESETS = ("unit_change", "rename_column", "drop_contract_field", "bad_category", "dtype_change", "row_loss")
RUN_STATUSES = ("start", "ok", "fail", "skip")
METRIC_NAMES = ("roc_auc", "pr_auc", "f1", "precision", "recall", "accuracy")
RANGE_REL_TOL = 1e-9
UNIT_FACTORS = (100, 1000)
UNIT_BAND = 0.1
NAME_SIMILARITY_CUTOFF = 0.6
VALUE_SAMPLES = 5
PROFILE_SAMPLES = 10
HIST_BINS = 20
METRIC_TOLERANCE = 0.005
TOP_FRACTION = 0.10
PRICE_USD_PER_M = {"input": 0.25, "cached_input": 0.025, "output": 2.00}
