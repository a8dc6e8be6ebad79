"""Inject one known fault into a (table, contract) pair to prove the validator bites.

Inputs are never modified (DataFrames are immutable; the contract is copied). Seeded steps pick
an EXACT number of rows, ``round(fraction * n)`` (half-even, like Python), by ranking rows on a
seeded hash of the key with the distributed row numbering (no single-task global sort).
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from handoff.config import FAULT_PRESETS
from handoff.functions.columns import col_of, cols_of, seeded_hash
from handoff.operators.contract import Contract
from handoff.operators.ranking import row_numbers
from handoff.operators.validate import summarise, validate

# Which check each preset must trip.
EXPECTED_CHECK = {
    "unit_change": "range",
    "rename_column": "columns",
    "drop_contract_field": "columns",
    "bad_category": "values",
    "dtype_change": "dtype",
    "row_loss": "rows",
}
DEFAULT_FRACTION = {"bad_category": 0.05, "row_loss": 0.10}


def other_spelling(name: str) -> str:
    """A different spelling of a column name: snake case, or without underscores if it is snake case already."""
    words = re.findall(r"[A-Z]+(?![a-z])|[A-Z]?[a-z0-9]+", name)
    snake = "_".join(w.lower() for w in words)
    return snake if snake != name else "".join(words)


def exact_pick(df: DataFrame, key: str, fraction: float, seed: int, order: Column | None = None) -> DataFrame:
    """df plus boolean ``_picked``: exactly round(fraction * n) rows with the smallest (seeded hash, key).

    Only the two-column projection (hash, key) is ranked (distributed row numbers); the k-th pair
    comes back to the driver as one scalar pair and the table is filtered against it, so the wide
    rows are never shuffled. Exact for a unique key (a primary key of a clean table).
    """
    n = df.count()
    k = max(0, int(round(fraction * n)))
    h = order if order is not None else seeded_hash(col_of(key), seed)
    if k == 0:
        return df.withColumn("_picked", F.lit(False))
    proj = df.select(h.alias("_h"), col_of(key).alias("_k"))
    kth = row_numbers(proj, [F.col("_h"), F.col("_k")], name="_rank").where(F.col("_rank") == k).collect()[0]
    picked = (h < F.lit(kth["_h"])) | ((h == F.lit(kth["_h"])) & (col_of(key) <= F.lit(kth["_k"])))
    return df.withColumn("_picked", picked)


@dataclass(frozen=True)
class Fault:
    """What a preset works on; ``picked`` marks an exact share of the rows."""

    df: DataFrame
    contract: Contract
    column: str
    raw_value: str | None
    pick: Callable[[], DataFrame]


def _picked_value(f: Fault) -> DataFrame:
    if f.raw_value is None:
        raise ValueError("a spelling to put in is needed (raw_value)")
    cell = F.when(F.col("_picked"), F.lit(f.raw_value)).otherwise(col_of(f.column))
    return f.pick().withColumn(f.column, cell).select(*cols_of(f.df.columns))


#: Preset -> the broken table, from the sound one.
TABLE_FAULTS: dict[str, Callable[[Fault], DataFrame]] = {
    "unit_change": lambda f: f.df.withColumn(f.column, col_of(f.column) * 100),
    "rename_column": lambda f: f.df.withColumnRenamed(f.column, other_spelling(f.column)),
    "bad_category": _picked_value,
    "dtype_change": lambda f: f.df.withColumn(f.column, F.concat(F.lit("Tier "), col_of(f.column).cast("string"))),
    "row_loss": lambda f: f.pick().where(~F.col("_picked")).select(*cols_of(f.df.columns)),
}
#: Preset -> the broken contract.
CONTRACT_FAULTS: dict[str, Callable[[Fault], Contract]] = {
    "drop_contract_field": lambda f: replace(f.contract, columns=f.contract.columns.where(F.col("name") != f.column)),
}


def tamper(
    df: DataFrame,
    contract: Contract,
    preset: str,
    column: str,
    seed: int = 42,
    key: str | None = None,
    fraction: float | None = None,
    raw_value: str | None = None,
    order: Column | None = None,
) -> tuple[DataFrame, Contract]:
    """A broken copy of (table, contract) for one preset; ``order`` replaces the seeded hash."""
    known = TABLE_FAULTS | CONTRACT_FAULTS
    if preset not in known:
        raise ValueError(f"{preset} is no preset; there are {', '.join(known)}")
    if column not in (df.columns if preset in TABLE_FAULTS else contract.names()):
        raise KeyError(f"{preset}: there is no column {column} to break")
    share = DEFAULT_FRACTION.get(preset) if fraction is None else fraction
    pick = lambda: exact_pick(df, key or contract.dataset["primary_key"], share, seed, order)
    fault = Fault(df, contract, column, raw_value, pick)
    if preset in CONTRACT_FAULTS:
        return df, CONTRACT_FAULTS[preset](fault)
    return TABLE_FAULTS[preset](fault), contract


def fault_matrix(
    df: DataFrame,
    contract: Contract,
    columns: Mapping[str, str],
    raw_value: str,
    seed: int = 42,
    required_features=None,
) -> DataFrame:
    """Every preset x validate -> (preset, expected_check, failed, caught, only_expected)."""
    spark = df.sparkSession
    rows = []
    for preset in FAULT_PRESETS:
        bad_df, bad_c = tamper(df, contract, preset, columns[preset], seed=seed, raw_value=raw_value)
        s = summarise(validate(bad_df, bad_c, required_features)).collect()[0]
        failed = list(s["failed"] or [])
        exp = EXPECTED_CHECK[preset]
        rows.append((preset, exp, failed, exp in failed, failed == [exp]))
    return spark.createDataFrame(
        rows, "preset string, expected_check string, failed array<string>, caught boolean, only_expected boolean")
