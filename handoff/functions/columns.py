"""Column-level building blocks.

Spark and pandas disagree on a handful of primitives (NaN vs NULL, ANSI division, left- vs
right-closed bins, which characters count as white space); these helpers pin the semantics the
operators rely on.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, FloatType, StringType

# Unicode-aware leading/trailing white space (covers tab, newline and U+00A0, which Spark's
# `trim` does not remove).
_EDGE_WS = r"(?U)^\s+|\s+$"

# Fixed multiplicative hash used by the oracle-compared seeded steps (Knuth's constant, 2^32).
KNUTH = 2654435761
TWO_32 = 4294967296
SCORE_MOD = 1000003


def quoted(name: str) -> str:
    """A column name in back quotes, so that a dot in it is part of the name and no path."""
    return "`" + name.replace("`", "``") + "`"


def col_of(c: str | Column) -> Column:
    """The column of that name, whatever characters the name holds; a column expression stays as it is."""
    return F.col(quoted(c)) if isinstance(c, str) else c


def cols_of(names: Sequence[str | Column]) -> list[Column]:
    return [col_of(c) for c in names]


def is_floating(dt: DataType) -> bool:
    return isinstance(dt, (DoubleType, FloatType))


def nan_to_null(c: str | Column, dt: DataType | None = None) -> Column:
    """One missing value, as in pandas: NaN becomes NULL (only floating types can hold NaN)."""
    c = col_of(c)
    if dt is not None and not is_floating(dt):
        return c
    return F.when(F.isnan(c), F.lit(None)).otherwise(c)


def is_missing(c: str | Column, dt: DataType | None = None) -> Column:
    """NULL or NaN."""
    c = col_of(c)
    if dt is not None and not is_floating(dt):
        return c.isNull()
    return c.isNull() | F.isnan(c)


def row_hash(names: Sequence[str], seed: int) -> Column:
    """64-bit hash of the columns' values; a null differs from every value and from a null elsewhere."""
    return F.xxhash64(F.lit(int(seed)), *[F.struct(col_of(n).isNull().alias("null"), col_of(n).alias("v")) for n in names])


def strip_text(c: str | Column) -> Column:
    """Strip Unicode white space at both ends (NULL stays NULL)."""
    return F.regexp_replace(col_of(c), _EDGE_WS, "")


def ratio(num: str | Column, den: str | Column) -> Column:
    """num / den with a zero or missing (NULL or NaN) side giving NULL (never inf or NaN, never an ANSI error)."""
    num, den = nan_to_null(col_of(num)), nan_to_null(col_of(den))
    return F.try_divide(num, F.nullif(den, F.lit(0)))


def right_closed_bucket(c: str | Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the right-closed bin (edges[i], edges[i+1]] holding the value; NULL outside.

    ``Bucketizer``/``width_bucket`` are left-closed, so the chain is written out.
    """
    if len(edges) != len(labels) + 1:
        raise ValueError("need one more edge than labels")
    c = nan_to_null(c)  # NaN is larger than every number in Spark
    expr = None
    for lo, hi, label in zip(edges[:-1], edges[1:], labels):
        cond = c > F.lit(float(lo))
        if hi != float("inf"):
            cond = cond & (c <= F.lit(float(hi)))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(None).cast(StringType()))


def seeded_hash(key: str | Column, seed: int) -> Column:
    """Library default order key for seeded sampling: 64-bit xxhash of (seed, key); no overflow."""
    return F.xxhash64(F.lit(int(seed)), col_of(key))


def knuth_hash(key: str | Column, seed: int = 0) -> Column:
    """(key * 2654435761 + seed) mod 2^32, exact for any bigint key (decimal arithmetic).

    The same rule is one line of SQL in any engine, so seeded steps can be checked by an oracle.
    """
    k = col_of(key).cast("decimal(20,0)")
    return F.pmod(k * F.lit(KNUTH).cast("decimal(10,0)") + F.lit(int(seed)), F.lit(TWO_32)).cast("bigint")


def pseudo_score(key: str | Column) -> Column:
    """Deterministic score in [0, 1) from a key: ((key * 2654435761) mod 1000003) / 1000003."""
    k = col_of(key).cast("decimal(20,0)")
    return F.pmod(k * F.lit(KNUTH).cast("decimal(10,0)"), F.lit(SCORE_MOD)).cast("double") / F.lit(
        float(SCORE_MOD)
    )
