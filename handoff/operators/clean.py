"""Deterministic cleaning: strip -> entity map -> duplicates -> casts -> order. Never imputes.

Row order carries meaning in a file ("keep the first"); a distributed table has none, so every
keep-first step takes an explicit ``order_by`` (ended by the key to make it total).
Keep-first is an aggregation (``min`` of a struct led by the order columns), not a window: a key
holding a third of the rows is pre-reduced on every map task instead of landing in one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from handoff.config import Config
from handoff.functions.columns import col_of, cols_of, is_missing, strip_text
from handoff.operators.profile import _keys, is_numeric_field, null_counts
from handoff.session import reliable_checkpoint


def strip_text_columns(df: DataFrame) -> DataFrame:
    """Strip Unicode white space at both ends of every text column."""
    return df.select(
        *[strip_text(col_of(f.name)).alias(f.name) if isinstance(f.dataType, StringType) else col_of(f.name)
          for f in df.schema.fields]
    )


def apply_entity_map(df: DataFrame, entity_map: Mapping[str, Mapping[str, str]]) -> DataFrame:
    """Replace raw spellings by canonical ones (exact match); absent columns skipped."""
    out = []
    for f in df.schema.fields:
        mapping = entity_map.get(f.name)
        if mapping:
            pairs = []
            for old, new in mapping.items():
                pairs += [F.lit(old), F.lit(new)]
            m = F.create_map(*pairs)
            out.append(F.coalesce(F.try_element_at(m, col_of(f.name)), col_of(f.name)).alias(f.name))
        else:
            out.append(col_of(f.name))
    return df.select(*out)


def entity_fix_counts(df: DataFrame, entity_map: Mapping[str, Mapping[str, str]]) -> DataFrame:
    """(column, old_value, new_value, n) rows that the map would change; zero counts omitted."""
    spark = df.sparkSession
    specs = [(c, old, new) for c, m in entity_map.items() if c in df.columns for old, new in m.items()]
    if not specs:
        return spark.createDataFrame([], "column string, old_value string, new_value string, n long")
    wide = df.agg(*[F.count_if(col_of(c) == F.lit(old)).alias(f"f{i}") for i, (c, old, _) in enumerate(specs)])
    rows = [F.struct(F.lit(c).alias("column"), F.lit(old).alias("old_value"), F.lit(new).alias("new_value"),
                     F.col(f"f{i}").alias("n")) for i, (c, old, new) in enumerate(specs)]
    return wide.select(F.inline(F.array(*rows))).where(F.col("n") > 0)


def drop_exact(df: DataFrame) -> DataFrame:
    """C4: drop rows equal in every column (NULL = NULL and NaN = NaN collapse)."""
    return df.dropDuplicates()


def keep_first(df: DataFrame, key: str | Sequence[str], order_by: Sequence[str] | None = None) -> DataFrame:
    """One row per key, the first by ``order_by`` (default: all columns, i.e. a canonical order)."""
    keys = _keys(key)
    order = list(order_by) if order_by else [c for c in df.columns if c not in keys]
    rest = [c for c in df.columns if c not in keys]
    return _firsts(df, keys, order, rest).select(*cols_of(df.columns))


def _firsts(df: DataFrame, keys: list[str], order: list[str], rest: list[str], counted: str | None = None) -> DataFrame:
    """The first row per key; column ``counted``, if named, has the number of the key's rows."""
    packed = F.struct(*[col_of(c).alias(f"o{i}") for i, c in enumerate(order)],
                      *[col_of(c).alias(f"v{i}") for i, c in enumerate(rest)])
    many = [F.count(F.lit(1)).alias("n")] if counted else []
    firsts = df.groupBy(*[col_of(k).alias(f"k{i}") for i, k in enumerate(keys)]).agg(F.min(packed).alias("first"), *many)
    return firsts.select(*[F.col(f"k{i}").alias(k) for i, k in enumerate(keys)], *[F.col(f"first.v{i}").alias(c) for i, c in enumerate(rest)],
                         *([F.col("n").alias(counted)] if counted else []))


def drop_same_records(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Rows equal in every column but the key collapse to the lowest key."""
    keys = _keys(key)
    return _lowest_keys(df, keys, [c for c in df.columns if c not in keys]).select(*cols_of(df.columns))


def _lowest_keys(df: DataFrame, keys: list[str], rest: list[str], summed: Mapping[str, F.Column] | None = None) -> DataFrame:
    """The lowest key per record (``rest``), and the sums asked for."""
    low = col_of(keys[0]) if len(keys) == 1 else F.struct(*[col_of(k).alias(f"k{i}") for i, k in enumerate(keys)])
    found = df.groupBy(*[col_of(c).alias(f"r{i}") for i, c in enumerate(rest)]).agg(
        F.min(low).alias("low"), *[e.alias(f"s{i}") for i, e in enumerate((summed or {}).values())])
    named = [F.col("low" if len(keys) == 1 else f"low.k{i}").alias(k) for i, k in enumerate(keys)]
    return found.select(*named, *[F.col(f"r{i}").alias(c) for i, c in enumerate(rest)], *[F.col(f"s{i}").alias(n) for i, n in enumerate(summed or {})])


def cast_ints(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Cast integer-by-meaning columns to bigint when every value is a whole number (one aggregate job)."""
    types = {f.name: f.dataType for f in df.schema.fields}
    present = [c for c in columns if c in types]
    if not present:
        return df, []

    def unfit(c: str) -> F.Column:  # missing, or a number with a fraction (1.7 must not become 1)
        gap = is_missing(c, types[c])
        return gap | (col_of(c) != F.floor(col_of(c))) if is_numeric_field(types[c]) else gap

    found = df.agg(*[F.count_if(unfit(c)).alias(f"n{i}") for i, c in enumerate(present)]).collect()[0]
    cast = [c for i, c in enumerate(present) if found[f"n{i}"] == 0]
    return df.select(*[col_of(c).cast("bigint").alias(c) if c in cast else col_of(c) for c in df.columns]), cast


def order_by_key(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Globally ordered by key without a single-task sort (range partitions, sorted within)."""
    keys = cols_of(_keys(key))
    return df.repartitionByRange(*keys).sortWithinPartitions(*keys)


def clean(
    df: DataFrame,
    cfg: Config,
    order_by: Sequence[str] | None = None,
    drop_duplicate_records: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """The cleaned table and a tidy report ``(section, column, value, n)``.

    Actions: the stripped rows and the de-duplicated rows are each written once to the shared
    checkpoint folder (every later consumer reads them instead of re-running the shuffles). The rows
    left after each step travel with the groupings as counts, so nothing is shuffled to be counted.
    """
    keys = _keys(cfg.primary_key)
    rest = [c for c in df.columns if c not in keys]
    # the fix counts (old spellings) and the mapped rows (a projection) both read one written copy
    stripped = reliable_checkpoint(strip_text_columns(df))
    fixes = entity_fix_counts(stripped, cfg.entity_map)
    mapped = apply_entity_map(stripped, cfg.entity_map)
    exact = drop_exact(mapped)
    in_key, in_record = (next(n for n in (name, "_" + name, "__" + name) if n not in df.columns) for name in ("exact_rows", "ids"))
    ids = _firsts(exact, keys, list(order_by) if order_by else rest, rest, counted=in_key).withColumn(in_record, F.lit(1).cast("long"))
    if drop_duplicate_records:
        ids = _lowest_keys(ids, keys, rest, {in_key: F.sum(in_key), in_record: F.sum(in_record)})
    counted = reliable_checkpoint(ids)
    records = counted.select(*cols_of(df.columns))
    nulls = {r["column"]: r["null_count"] for r in null_counts(records).collect()}  # one row per column
    casted, cast_cols = cast_ints(records, cfg.int_columns)
    out = order_by_key(casted, keys)

    spark = df.sparkSession
    c = counted.agg(F.count(F.lit(1)).alias("rows_out"), F.coalesce(F.sum(in_key), F.lit(0)).alias("after_exact"),
                    F.coalesce(F.sum(in_record), F.lit(0)).alias("after_ids")).first().asDict() | {"rows_in": stripped.count()}
    scalars = [
        ("rows_in", c["rows_in"]),
        ("rows_out", c["rows_out"]),
        ("duplicate_rows_dropped", c["rows_in"] - c["after_exact"]),
        ("duplicate_ids_dropped", c["after_exact"] - c["after_ids"]),
        ("duplicate_records_dropped", c["after_ids"] - c["rows_out"]),
    ]
    head = spark.createDataFrame([(s, None, None, int(n)) for s, n in scalars],
                                 "section string, column string, value string, n long")
    fix_rows = fixes.select(F.lit("entity_fix").alias("section"), "column", F.col("old_value").alias("value"), "n")
    cast_rows = spark.createDataFrame([("dtype_cast", c_, "int", None) for c_ in cast_cols],
                                      "section string, column string, value string, n long")
    nulls = spark.createDataFrame([("nulls_kept", col, None, int(n)) for col, n in nulls.items() if n > 0],
                                  "section string, column string, value string, n long")
    report = head.unionByName(fix_rows).unionByName(cast_rows).unionByName(nulls)
    return out, report


def reconcile(report: DataFrame, cleaned: DataFrame) -> DataFrame:
    """C11: rows_out equals the table's rows, and rows_in - drops = rows_out (one row)."""
    names = ["rows_in", "rows_out", "duplicate_rows_dropped", "duplicate_ids_dropped", "duplicate_records_dropped"]
    long = report.where(F.col("column").isNull() & F.col("section").isin(names)).select("section", "n").unionByName(
        cleaned.agg(F.count(F.lit(1)).alias("n")).select(F.lit("table_rows").alias("section"), "n"))
    r = long.agg(*[F.max(F.when(F.col("section") == n, F.col("n"))).alias(n) for n in [*names, "table_rows"]])
    return r.select(
        "rows_in", "rows_out", "table_rows",
        (F.col("rows_out") == F.col("table_rows")).alias("rows_match"),
        ((F.col("rows_in") - F.col("duplicate_rows_dropped") - F.col("duplicate_ids_dropped")
          - F.col("duplicate_records_dropped")) == F.col("rows_out")).alias("drops_add_up"),
    )


def unmapped_spellings(df: DataFrame, entity_map: Mapping[str, Mapping[str, str]]) -> DataFrame:
    """(column, old_value, n) raw spellings still present (empty when clean)."""
    return entity_fix_counts(df, entity_map).select("column", "old_value", "n")


def null_reconciliation(df: DataFrame, report: DataFrame) -> DataFrame:
    """Columns whose null count differs from the reported one (empty when nothing imputed)."""
    observed = null_counts(df).where(F.col("null_count") > 0).select("column", F.col("null_count").alias("observed"))
    reported = report.where(F.col("section") == "nulls_kept").select("column", F.col("n").alias("reported"))
    return observed.join(reported, "column", "full_outer").where(~F.col("observed").eqNullSafe(F.col("reported")))
