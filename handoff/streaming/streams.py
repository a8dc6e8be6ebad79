"""Streaming operators (``readStream`` -> transformations -> ``writeStream``).

Every query takes the checkpoint folder from its caller: a query that is started again with the same
folder goes on after the last finished micro-batch. Batch writers write the folder of their batch id
and overwrite it, so a batch that runs twice leaves one copy. ``drain`` runs a query with
``availableNow`` (process everything present, then stop) -- for tests and scheduled hand-over jobs;
production runs use a processing-time trigger instead.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from handoff.operators.contract import Contract
from handoff.operators.validate import validate
from handoff.streaming.folders import delete  # noqa: F401
from handoff.streaming.limits import RUNNING, RunningLimits
from handoff.streaming.status import live_run_status  # noqa: F401
from handoff.streaming.tail import appended_events, appended_lines  # noqa: F401


def read_stream(spark: SparkSession, path: str, schema, fmt: str = "parquet", glob: str | None = None,
                max_files_per_trigger: int | None = None) -> DataFrame:
    """M1: new files landing in ``path`` become micro-batches (a file source picks up new FILES,
    not bytes appended to an existing file, so each event batch must land as a file)."""
    r = spark.readStream.format(fmt).schema(schema)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def drain(stream: DataFrame, batch_fn: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> None:
    """Run ``batch_fn`` on every micro-batch until the source is drained."""
    writer = stream.writeStream.outputMode(mode).foreachBatch(batch_fn).option("checkpointLocation", checkpoint)
    writer.trigger(availableNow=True).start().awaitTermination()


def write_batch(batch: DataFrame, batch_id: int, path: str) -> None:
    """The rows of one micro-batch in a folder of their own; a repeated batch replaces it."""
    batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """All micro-batches written so far, with their batch_id."""
    return spark.read.parquet(path).withColumn("batch_id", F.col("batch_id").cast("long"))


def tail_to_table(stream: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """M1: append every arriving row to a parquet table, once; returns the table as a batch DataFrame."""
    writer = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    writer.trigger(availableNow=True).start().awaitTermination()
    return stream.sparkSession.read.parquet(path)


def validate_stream(stream: DataFrame, contract: Contract, path: str, checkpoint: str,
                    required_features: Sequence[str] | None = None) -> DataFrame:
    """Contract checks of every micro-batch, with the batch id.

    Row-local checks judge the batch. Rows, keys, null limits and the fingerprint belong to the whole
    table; they are judged over the stream so far (``RunningLimits``).
    """
    limits = RunningLimits(stream.sparkSession, contract, f"{path}-running")

    def step(batch: DataFrame, number: int) -> None:
        local = validate(batch, contract, required_features, scope="batch")
        key = F.col("check") == "key"
        own = local.where(~F.col("check").isin(*RUNNING) | (key & (F.col("column") != F.lit(contract.dataset["primary_key"]))))
        write_batch(own.unionByName(limits.step(batch, number)), number, path)

    drain(stream, step, checkpoint)
    return read_batches(stream.sparkSession, path)


def score_stream(stream: DataFrame, scorer: Callable[[DataFrame], DataFrame], path: str, checkpoint: str) -> DataFrame:
    """M4: stateless scoring of arriving rows (``scorer`` maps a DataFrame to scores), each row once."""
    return tail_to_table(scorer(stream), path, checkpoint)
