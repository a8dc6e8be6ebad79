"""Tables in and out: typed reads with null tokens, dictionary sheets, deterministic writes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from handoff.functions.columns import col_of, cols_of, strip_text
from handoff.sources.fingerprint import fingerprint_value

# Text tokens pandas reads as missing.
NULL_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
               "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", schema=None,
               null_tokens: Sequence[str] | None = None, header: bool = True) -> DataFrame:
    """A1/A3: read a table untouched except for the declared schema; CSV null tokens become NULL.

    CSV is parsed by the JVM reader (correctly rounded floats); with a schema there is no
    inference pass over the data.
    """
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", header).option("nullValue", "").option("mode", "PERMISSIVE")
    df = reader.load(path)
    if null_tokens:
        toks = list(null_tokens)
        df = df.select(*[F.when(col_of(f.name).isin(toks), F.lit(None)).otherwise(col_of(f.name)).alias(f.name)
                         if isinstance(f.dataType, StringType) else col_of(f.name) for f in df.schema.fields])
    return df


def locate_header(df: DataFrame, marker: str = "Variable", order_col: str = "line") -> DataFrame:
    """A2: {name: description} pairs from a headerless sheet whose header row is found by content.

    ``df`` holds the sheet's cells as text columns plus a line ordinal ``order_col``. The first line
    with a cell equal to ``marker`` is the header; the name is that cell's column, the description
    the next one. Blanks of any kind (tabs, no-break spaces) around a cell do not count, blank names
    are skipped, and a repeated name keeps its last description. Empty when no header exists.
    """
    cells = [c for c in df.columns if c != order_col]
    pos = F.posexplode(F.array(*[strip_text(col_of(c).cast("string")) for c in cells]))
    hits = df.select(col_of(order_col), pos).where(F.col("col") == marker)
    # the header is at most one (line, position) pair: read back and used as literals, so the body is
    # a plain filter and projection of the sheet (no join against the header row)
    h = hits.agg(F.min(F.struct(col_of(order_col), F.col("pos"))).alias("h")).collect()[0]["h"]
    if h is None:
        return df.sparkSession.createDataFrame([], "name string, description string")
    hline, hpos = h[order_col], h["pos"]
    name_expr = col_of(cells[hpos]).cast("string")
    desc_expr = col_of(cells[hpos + 1]).cast("string") if hpos + 1 < len(cells) else F.lit(None).cast("string")
    body = df.where(col_of(order_col) > F.lit(hline))
    named = body.select(col_of(order_col).alias("at"), strip_text(name_expr).alias("name"), F.coalesce(strip_text(desc_expr), F.lit("")).alias("description"))
    return named.where(F.col("name") != "").groupBy("name").agg(F.max_by("description", "at").alias("description"))


def write_table(df: DataFrame, path: str, key: Sequence[str] | str, fmt: str = "parquet", mode: str = "overwrite") -> str:
    """A4: range-partitioned and sorted by key; returns the fingerprint of the content as it reads back."""
    keys = [key] if isinstance(key, str) else list(key)
    out = df.repartitionByRange(*cols_of(keys)).sortWithinPartitions(*cols_of(keys))
    w = out.write.mode(mode).format(fmt)
    if fmt == "csv":
        w = w.option("header", True).option("lineSep", "\n")
    w.save(path)
    return fingerprint_value(read_table(df.sparkSession, path, fmt, schema=df.schema))
