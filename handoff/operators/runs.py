"""Run history from an event log: run summaries, step durations, usage totals, token cost.

Event log shape: (run_id, seq, ts, step, status, result, duration_s, llm_calls, cost_usd); ``seq``
is the line number within the run, so (ts, seq) is a total order. Every summary is one
``groupBy(run_id)`` with ``max_by``/``min_by``: partial aggregation without a window (Spark sorts each
map task's rows, because the buffers are structs).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from handoff.config import PRICE_USD_PER_M


def run_summary(events: DataFrame) -> DataFrame:
    """L4: per run: started_at, ended_at, result, duration_s (1 dp), llm_calls, cost_usd of the last event; newest first.

    result: a last ``flow`` event with ok/fail carries the run's result; otherwise a last ``fail``
    means error, anything else means the run is still going.
    """
    order = F.struct("ts", "seq")
    g = events.groupBy("run_id").agg(
        F.min_by("ts", order).alias("started_at"), F.max_by("ts", order).alias("ended_at"),
        F.max_by("step", order).alias("last_step"), F.max_by("status", order).alias("last_status"),
        F.max_by("result", order).alias("last_result"), F.max_by("llm_calls", order).alias("llm_calls"),
        F.max_by("cost_usd", order).alias("cost_usd"), F.count(F.lit(1)).alias("events"))
    return told(g).orderBy(F.desc("started_at"), F.desc("run_id"))


def told(g: DataFrame) -> DataFrame:
    """The summary's columns from each run's first and last event."""
    ended = (F.col("last_step") == "flow") & F.col("last_status").isin("ok", "fail")
    result = F.when(ended, F.col("last_result")).when(F.col("last_status") == "fail", "error").otherwise("running")
    micros = F.expr("timestampdiff(MICROSECOND, started_at, ended_at)")
    return g.select("run_id", "started_at", "ended_at", result.alias("result"),
                    F.round(micros / 1e6, 1).alias("duration_s"), "llm_calls", "cost_usd", "events")


def step_durations(events: DataFrame) -> DataFrame:
    """Per (run, step): last status, total recorded duration, number of events."""
    order = F.struct("ts", "seq")
    return events.groupBy("run_id", "step").agg(
        F.max_by("status", order).alias("status"), F.sum("duration_s").alias("duration_s"),
        F.count(F.lit(1)).alias("events"))


def usage_totals(events: DataFrame) -> DataFrame:
    """Per run: total calls, cost and duration."""
    return events.groupBy("run_id").agg(
        F.sum("llm_calls").alias("llm_calls"), F.sum("cost_usd").alias("cost_usd"),
        F.sum("duration_s").alias("duration_s"))


def token_cost(usage: DataFrame, prices=PRICE_USD_PER_M) -> DataFrame:
    """Cost in USD of (prompt_tokens, cached_prompt_tokens, completion_tokens) at list prices;
    cached prompt tokens are billed at the cached rate, the rest of the prompt at the input rate."""
    uncached = F.greatest(F.col("prompt_tokens") - F.col("cached_prompt_tokens"), F.lit(0))
    usd = (uncached * F.lit(prices["input"]) + F.col("cached_prompt_tokens") * F.lit(prices["cached_input"])
           + F.col("completion_tokens") * F.lit(prices["output"])) / F.lit(1_000_000.0)
    return usage.withColumn("cost_usd", usd)
