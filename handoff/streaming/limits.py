"""The checks that belong to the whole table, judged over a stream as it arrives.

A micro-batch by itself cannot answer whether keys repeat, how many nulls there are, whether rows are
missing or whether the content is what was measured. ``RunningLimits`` keeps, per micro-batch, the running
sums of all batches up to it (rows, nulls per column, the additive fingerprint, repeated keys) and the
keys that the batch brought, in buckets. A step reads the sums of the batch before it and the keys of
earlier batches, so a batch id that runs again gives the same numbers and replaces its own files.

A limit on nulls and the uniqueness of keys fail as soon as they are passed. Too few rows, and a content
that differs, can only be told at the end: until as many rows as were measured have arrived these two
are not answered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from handoff.functions.columns import is_missing, quoted
from handoff.operators.contract import Contract
from handoff.operators.validate import REPORT_SCHEMA
from handoff.sources.fingerprint import fingerprint_exprs, fingerprint_text
from handoff.streaming.folders import numbered

#: Buckets of seen keys; a batch reads the buckets that its own keys fall into.
BUCKETS = 64
RUNNING = ("rows", "nulls", "key", "integrity")


class RunningLimits:
    def __init__(self, spark: SparkSession, contract: Contract, path: str, buckets: int = BUCKETS):
        self.spark, self.contract, self.path, self.buckets = spark, contract, path, buckets
        self.key = contract.dataset["primary_key"]
        self.specs = contract.specs()

    def _before(self, number: int) -> dict:
        """Running sums of the last finished batch before this one."""
        done = [n for n in numbered(self.spark, f"{self.path}/sums", "batch") if n < number]
        if not done:
            return {}
        return {r["what"]: int(r["n"]) for r in self.spark.read.parquet(f"{self.path}/sums/batch={done[-1]}").collect()}  # a few per column

    def _repeated(self, batch: DataFrame, number: int) -> int:
        """Rows of the batch beyond the first of their key, counting the keys of earlier batches; writes the batch's keys."""
        bucket = F.pmod(F.xxhash64("key"), F.lit(self.buckets)).cast("int")
        keys = (batch.select(F.col(quoted(self.key)).alias("key")).where(F.col("key").isNotNull())
                .groupBy("key").agg(F.count(F.lit(1)).alias("n")).withColumn("bucket", bucket))
        mine = f"{self.path}/keys/batch={number}"
        keys.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(mine)
        keys = self.spark.read.schema(keys.schema).parquet(mine)
        again = int(keys.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0))).first()[0])
        earlier = [n for n in numbered(self.spark, f"{self.path}/keys", "batch") if n < number]
        if earlier:
            seen = self.spark.read.schema(keys.schema).option("basePath", f"{self.path}/keys").parquet(
                *[f"{self.path}/keys/batch={n}" for n in earlier])
            again += keys.join(seen.select("bucket", "key").distinct(), ["bucket", "key"], "left_semi").count()
        return again

    def step(self, batch: DataFrame, number: int) -> DataFrame:
        """The running checks after this batch, as rows of a validation report."""
        held = [s["name"] for s in self.specs if s["name"] in batch.columns]
        asked = [F.count(F.lit(1)).alias("rows"), *fingerprint_exprs(batch)]
        asked += [F.count_if(is_missing(F.col(quoted(c)), batch.schema[c].dataType)).alias(f"nulls:{c}") for c in held]
        sums = {k: int(v or 0) for k, v in batch.agg(*asked).first().asDict().items()}
        if self.key in batch.columns:
            sums["repeated"] = self._repeated(batch, number)
        before = self._before(number)
        total = {k: before.get(k, 0) + sums.get(k, 0) for k in {**before, **sums}}
        rows = [(k, str(v)) for k, v in sorted(total.items())]
        self.spark.createDataFrame(rows, "what string, n string").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/sums/batch={number}")
        return self.spark.createDataFrame(list(self._judged(total)), REPORT_SCHEMA)

    def _judged(self, total: dict):
        want = int(self.contract.dataset["row_count"])
        n = total["rows"]
        for s in self.specs:
            name, nulls = s["name"], total.get(f"nulls:{s['name']}")
            if nulls is None:
                continue
            limit = int(s["null_count"] or 0) if s["nullable"] else 0
            yield ("nulls", name, nulls <= limit, float(nulls), float(limit), f"{nulls} nulls so far where {limit} are allowed",
                   None if nulls <= limit else "more cells are empty than were measured")
        whole = True if n == want else False if n > want else None
        yield ("rows", None, whole, float(n), float(want), f"{n} rows so far, measured {want}", "rows came after measuring" if whole is False else None)
        if "repeated" in total:
            bad = total["repeated"] + total.get(f"nulls:{self.key}", 0)
            yield ("key", self.key, bad == 0, float(bad), 0.0, f"{total['repeated']} repeated keys so far, across batches",
                   None if bad == 0 else "a key must name one row")
        now, then = fingerprint_text(total), self.contract.dataset.get("fingerprint")
        same = None if n < want else now == then
        yield ("integrity", None, same, None, None, f"content {now[:24]} so far, contract {str(then)[:24]}",
               "rows, names or types are not those that were measured" if same is False else None)
