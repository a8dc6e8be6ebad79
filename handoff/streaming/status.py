"""M2: the live status of every run, with state that ends.

A stateful step keeps one row of aggregates per open run. It is removed when the run's last event is a
closing ``flow`` event, and when the run has been silent for ``silence`` while other events arrived. What
arrives for a run after that opens a new segment. Every micro-batch writes the segments that it changed;
a run's status is the merge of its segments, which is exact because first event, last event and count
merge, in whatever order the events came.

The silence is measured on the time of arrival, so no event is ever too late and none is dropped.
The segments of earlier calls are folded into one table at the start of a call, so a reader's work does
not grow with the number of micro-batches.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from handoff.operators import runs as L
from handoff.streaming.folders import delete, numbered

#: First and last event (ts and line) of a segment, what the last one says, and how many there were.
SEGMENT = ("first_ts timestamp_ntz, first_seq long, last_ts timestamp_ntz, last_seq long, step string, status string, result string, "
           "llm_calls long, cost_usd double, events long")
CELLS = ["step", "status", "result", "llm_calls", "cost_usd"]


def _segments(events: DataFrame, silence: str) -> DataFrame:
    """Streaming rows (run_id, segment, SEGMENT) of the segments that a micro-batch changed."""
    millis = int(pd.Timedelta(silence).total_seconds() * 1000)
    key_type = events.schema["run_id"].dataType.simpleString()

    def step(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        held = list(state.get) if state.exists else None
        arrived = None
        for part in parts:
            if not len(part):
                continue
            arrived = part["arrived"].max()
            rows = part.sort_values(["ts", "seq"], kind="stable")
            first, last = rows.iloc[0], rows.iloc[-1]
            if held is None:
                held = [f"{first['ts'].isoformat()}/{first['seq']}/{arrived.isoformat()}", first["ts"], int(first["seq"]), None, None, *[None] * 5, 0]
            if (first["ts"], first["seq"]) < (held[1], held[2]):
                held[1:3] = first["ts"], int(first["seq"])
            if held[3] is None or (last["ts"], last["seq"]) > (held[3], held[4]):
                held[3:5] = last["ts"], int(last["seq"])
                held[5:10] = [None if pd.isna(last[c]) else last[c] for c in CELLS]
                held[8] = None if held[8] is None else int(held[8])
                held[9] = None if held[9] is None else float(held[9])
            held[10] += len(part)
        if held is None:
            return
        if held[5] == "flow" and held[6] in ("ok", "fail"):
            if state.exists:
                state.remove()
        else:
            state.update(tuple(held))
            state.setTimeoutTimestamp(max(int(arrived.timestamp() * 1000), state.getCurrentWatermarkMs()) + millis)
        yield pd.DataFrame([[key[0], *held]], columns=["run_id", "segment", "first_ts", "first_seq", "last_ts", "last_seq", *CELLS, "events"])

    arriving = events.select("run_id", "ts", "seq", *CELLS, F.current_timestamp().alias("arrived")).withWatermark("arrived", "0 seconds")
    return arriving.groupBy("run_id").applyInPandasWithState(
        step, f"run_id {key_type}, segment string, {SEGMENT}", f"segment string, {SEGMENT}", "update", GroupStateTimeout.EventTimeTimeout)


def _latest(spark: SparkSession, path: str) -> DataFrame | None:
    """The last row of every segment: the folded table and the micro-batches after it."""
    folded, batches = numbered(spark, path, "folded"), numbered(spark, path, "batch")
    since = folded[-1] if folded else -1
    parts = [(f"{path}/folded={since}", since)] if folded else []
    parts += [(f"{path}/batch={b}", b) for b in batches if b > since]
    rows = None
    for folder, number in parts:
        one = spark.read.parquet(folder).withColumn("batch", F.lit(number))
        rows = one if rows is None else rows.unionByName(one)
    if rows is None:
        return None
    last = rows.groupBy("run_id", "segment").agg(F.max("batch").alias("batch"))
    same = (rows["segment"] == last["segment"]) & rows["run_id"].eqNullSafe(last["run_id"]) & (rows["batch"] == last["batch"])
    return rows.join(last, same, "left_semi").drop("batch")


def fold(spark: SparkSession, path: str) -> None:
    """Write the last row of every segment as one table and delete the micro-batches that it holds.

    The table is complete before anything is deleted; a fold that stops in between is done again.
    """
    batches, folded = numbered(spark, path, "batch"), numbered(spark, path, "folded")
    new = [b for b in batches if not folded or b > folded[-1]]
    if new:
        _latest(spark, path).write.mode("overwrite").parquet(f"{path}/folded={new[-1]}")
    upto = new[-1] if new else folded[-1] if folded else -1
    for b in batches:
        if b <= upto:
            delete(spark, f"{path}/batch={b}")
    for f in folded:
        if f < upto:
            delete(spark, f"{path}/folded={f}")


def live_run_status(events: DataFrame, path: str, checkpoint: str, silence: str = "1 hour") -> tuple[DataFrame, int | None]:
    """M2: take what arrived; (status of every run as ``run_summary`` gives it, rows left in the state).

    The number of rows is None where nothing had arrived. The next call folds the files that the status
    reads: use it before, or ask ``run_status`` again.
    """
    spark = events.sparkSession
    fold(spark, path)

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    query = _segments(events, silence).writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
    done = query.trigger(availableNow=True).start()
    done.awaitTermination()
    held = [op["numRowsTotal"] for p in done.recentProgress if p["numInputRows"] or p["durationMs"].get("addBatch") for op in p["stateOperators"]]
    return run_status(spark, path), held[-1] if held else None


def run_status(spark: SparkSession, path: str) -> DataFrame | None:
    """The status of every run from the segments written so far."""
    rows = _latest(spark, path)
    if rows is None:
        return None
    first = F.struct("first_ts", "first_seq")
    last = F.struct("last_ts", "last_seq", "step", "status", "result", "llm_calls", "cost_usd")
    runs = rows.groupBy("run_id").agg(F.min(first).alias("f"), F.max(last).alias("l"), F.sum("events").alias("events"))
    return L.told(runs.select("run_id", F.col("f.first_ts").alias("started_at"), F.col("l.last_ts").alias("ended_at"), F.col("l.step").alias("last_step"),
                              F.col("l.status").alias("last_status"), F.col("l.result").alias("last_result"), F.col("l.llm_calls").alias("llm_calls"),
                              F.col("l.cost_usd").alias("cost_usd"), "events"))
