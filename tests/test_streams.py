"""Streams that stop and start again: growing files, ending run status, limits over the whole stream."""

import json
import os
import uuid
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from handoff.operators import contract as E
from handoff.operators import runs as L
from handoff.session import ensure_checkpoint_dir
from handoff.streaming import limits, status, tail
from handoff.streaming import streams as M
from handoff.streaming.folders import numbered
from tests.conftest import CHURN


def scratch(spark, name):
    base = ensure_checkpoint_dir(spark)
    base = base[len("file:"):] if base.startswith("file:") else base
    return f"{base}/{name}-{uuid.uuid4().hex[:8]}"


def event(run, n, step="work", state="ok", **more):
    at = datetime(2026, 1, 1) + timedelta(seconds=n)
    return {"ts": at.isoformat(), "step": step, "status": state, "run_id": run, **more}


# ---------------------------------------------------------------- M1
def append(path, data):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "ab") as f:
        f.write(data)


def test_half_a_line_is_held_back_and_each_event_comes_once(spark):
    folder, table, ckpt = (scratch(spark, n) for n in ("log", "table", "ckpt"))
    lines = [(json.dumps(event(f"r{i % 3}", i, error="é" * (i % 5))) + "\n").encode() for i in range(60)]
    data, other = b"".join(lines[:40]), b"".join(lines[40:])

    def drain():
        rows = M.tail_to_table(M.appended_lines(spark, folder, "*.jsonl", range_bytes=700), table, ckpt)
        return sorted((r["path"], r["position"], r["line"]) for r in rows.collect())

    cut = len(b"".join(lines[:25])) + 17  # within a line
    append(f"{folder}/a/events.jsonl", data[:cut])
    append(f"{folder}/ignored.txt", b"no\n")
    first = drain()
    assert len(first) == 25 and drain() == first
    append(f"{folder}/a/events.jsonl", data[cut: cut + 5])  # still no line end
    assert drain() == first
    append(f"{folder}/a/events.jsonl", data[cut + 5:])
    append(f"{folder}/b/events.jsonl", other + b"{broken\n\n" + b'{"ts": "2026')
    got = drain()
    assert [line.encode() + b"\n" for path, _, line in got if path == "a/events.jsonl"] == lines[:40]
    assert [line for path, _, line in got if path == "b/events.jsonl"][-2:] == ["{broken", ""]
    starts = [len(b"".join(lines[:i])) for i in range(40)]
    assert [at for path, at, _ in got if path == "a/events.jsonl"] == starts
    events = M.appended_events(spark.createDataFrame(got, tail.LINE_SCHEMA))
    assert events.count() == 60 and sorted(r["run_id"] for r in events.collect()) == sorted(f"r{i % 3}" for i in range(60))


def test_a_line_longer_than_a_range_and_other_line_ends(spark):
    folder = scratch(spark, "log")
    lines = ["x" * 5000, "", "y" * 150_000, "z", "é" * 999]
    append(f"{folder}/f", "\r\n".join(lines).encode() + b"\r\n")
    rows = M.tail_to_table(M.appended_lines(spark, folder, range_bytes=1000), scratch(spark, "t"), scratch(spark, "c"))
    assert [r["line"] for r in rows.orderBy("position").collect()] == lines


def test_a_replaced_file_is_an_error(spark):
    folder, table, ckpt = (scratch(spark, n) for n in ("log", "table", "ckpt"))
    append(f"{folder}/f", b"one\ntwo\n")
    M.tail_to_table(M.appended_lines(spark, folder), table, ckpt)
    with open(f"{folder}/f", "w") as f:
        f.write("1\n")
    with pytest.raises(Exception, match="replaced"):
        M.tail_to_table(M.appended_lines(spark, folder), table, ckpt)


# ---------------------------------------------------------------- M2
RUNLOG = "run_id string, seq long, ts timestamp_ntz, step string, status string, result string, duration_s double, llm_calls long, cost_usd double"


def land(spark, folder, rows):
    made = [(r["run_id"], n, datetime.fromisoformat(r["ts"]), r["step"], r["status"], r.get("result"), None, r.get("llm_calls"), r.get("cost_usd"))
            for n, r in rows]
    spark.createDataFrame(made, RUNLOG).coalesce(1).write.mode("append").parquet(folder)


def test_status_is_the_summary_and_the_state_ends(spark):
    folder, path, ckpt = (scratch(spark, n) for n in ("events", "status", "ckpt"))
    schema = spark.createDataFrame([], RUNLOG).schema
    rows = [event("a", 0), event("b", 1), event("a", 5, "flow", "ok", result="verified", llm_calls=3), event("c", 6, state="fail", cost_usd=0.5)]
    later = [event("b", 2), event("c", 3), event("c", 9), event("b", 8, "flow", "fail", result="stopped")]
    last = [event("c", 20, "flow", "ok", result="done"), event("a", 30, "more"), event("a", 31, "flow", "ok", result="again"), event("a", -5)]
    held = []
    everything = []
    for part in (rows, later, last[:3], last[3:], []):
        everything += part
        if part:
            land(spark, folder, list(enumerate(part, len(everything))))
        status_now, left = M.live_run_status(M.read_stream(spark, folder, schema), path, ckpt)
        got = sorted(map(tuple, status_now.collect()), key=str)
        again, none = M.live_run_status(M.read_stream(spark, folder, schema), path, ckpt)
        assert none is None and sorted(map(tuple, again.collect()), key=str) == got
        want = L.run_summary(spark.read.schema(schema).parquet(folder))
        assert got == sorted(map(tuple, want.collect()), key=str)
        held.append(left)
        assert len(numbered(spark, path, "batch")) <= 1 and len(numbered(spark, path, "folded")) <= 1
    # b and c are open after the first part, c after the second, none after the third; the late event of a opens a segment
    assert held[0] == 2 and held[1] == 1 and held[2] == 0 and held[3] == 1


def test_a_silent_run_times_out_and_its_status_stays_right(spark):
    folder, path, ckpt = (scratch(spark, n) for n in ("events", "status", "ckpt"))
    schema = spark.createDataFrame([], RUNLOG).schema
    counts = []
    for i, run in enumerate(["silent", "x1", "x2", "x3"]):
        land(spark, folder, [(i, event(run, i)), (i + 10, event(run, i + 1, "flow" if run != "silent" else "work", "ok", result="r"))])
        got, left = M.live_run_status(M.read_stream(spark, folder, schema), path, ckpt, silence="1 millisecond")
        counts.append(left)
    assert counts[0] == 1 and counts[-1] == 0
    land(spark, folder, [(99, event("silent", 50, "flow", "fail", result="late"))])
    got, left = M.live_run_status(M.read_stream(spark, folder, schema), path, ckpt, silence="1 millisecond")
    want = L.run_summary(spark.read.schema(schema).parquet(folder))
    assert left == 0 and sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


# ---------------------------------------------------------------- M3
def test_limits_are_judged_over_the_whole_stream(spark, clean_frame):
    c = E.build_contract(clean_frame, CHURN)
    key = CHURN.primary_key
    ids = sorted(r[key] for r in clean_frame.select(key).collect())
    nullable = next(s["name"] for s in c.specs() if s["nullable"] and s["role"] == "feature")
    limit = next(s["null_count"] for s in c.specs() if s["name"] == nullable)
    parts = [clean_frame.where(F.col(key) < ids[7]), clean_frame.where((F.col(key) >= ids[7]) & (F.col(key) < ids[14])), clean_frame.where(F.col(key) >= ids[14])]
    again = clean_frame.where(F.col(key) == ids[2])
    emptied = clean_frame.where(F.col(key) >= ids[14]).withColumn(nullable, F.lit(None).cast(clean_frame.schema[nullable].dataType))

    def told(report, check, column):
        r = report.where((F.col("check") == check) & F.col("column").eqNullSafe(F.lit(column))).first()
        return r["passed"], r["observed"]

    running = limits.RunningLimits(spark, c, scratch(spark, "running"))
    reports = [running.step(p, i) for i, p in enumerate(parts)]
    assert [told(r, "rows", None) for r in reports] == [(None, 7.0), (None, 14.0), (True, 20.0)]
    assert [told(r, "key", key)[0] for r in reports] == [True, True, True]
    assert [told(r, "integrity", None)[0] for r in reports] == [None, None, True]

    running = limits.RunningLimits(spark, c, scratch(spark, "running"))
    reports = [running.step(p, i) for i, p in enumerate([parts[0], parts[1].unionByName(again), emptied])]
    assert [told(r, "key", key) for r in reports] == [(True, 0.0), (False, 1.0), (False, 1.0)]
    assert told(reports[1], "nulls", nullable)[0] is True
    passed, nulls = told(reports[2], "nulls", nullable)
    assert passed is False and nulls > limit
    assert told(reports[2], "rows", None) == (False, 21.0) and told(reports[2], "integrity", None)[0] is False
    for number, part in ((2, emptied), (1, parts[1].unionByName(again)), (2, emptied)):  # a repeated batch changes nothing
        same = running.step(part, number)
        assert sorted(map(tuple, same.collect()), key=str) == sorted(map(tuple, reports[number].collect()), key=str)


def test_a_batch_without_rows_or_key(spark, clean_frame):
    c = E.build_contract(clean_frame, CHURN)
    running = limits.RunningLimits(spark, c, scratch(spark, "running"))
    empty = running.step(clean_frame.limit(0), 0)
    assert empty.where("passed = false").count() == 0
    running = limits.RunningLimits(spark, c, scratch(spark, "running"))
    assert running.step(clean_frame.drop(CHURN.primary_key), 0).where(F.col("check") == "key").count() == 0
    assert status.run_status(spark, scratch(spark, "nothing")) is None
