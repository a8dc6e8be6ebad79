import json
import os
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from handoff.operators import contract as E
from handoff.plans import train as J
from handoff.session import ensure_checkpoint_dir
from handoff.sources import artifacts as A
from handoff.sources import tables as T
from handoff.streaming import streams as M
from tests.conftest import CHURN


def scratch(spark, name):
    """A fresh local folder under the session's checkpoint folder (tests run locally)."""
    base = ensure_checkpoint_dir(spark)
    base = base[len("file:"):] if base.startswith("file:") else base
    return f"{base}/{name}-{uuid.uuid4().hex[:8]}"


def test_locate_header_by_content(spark):
    rows = [(0, None, "Data dictionary", None), (1, None, None, None), (2, None, "Variable", "Discerption"),
            (3, None, "Tenure", "months with us"), (4, None, "  ", "blank name is skipped"), (5, None, "Churn", None)]
    df = spark.createDataFrame(rows, "line long, c0 string, c1 string, c2 string")
    got = {r["name"]: r["description"] for r in T.locate_header(df, "Variable", "line").collect()}
    assert got == {"Tenure": "months with us", "Churn": ""}
    assert T.locate_header(df.where(F.col("line") != 2), "Variable", "line").count() == 0


def test_header_with_tabs_and_repeated_names(spark):
    rows = [(0, "Variable\t", "\u00a0text"), (1, "Tenure", "first"), (2, " Tenure\u00a0", "last\t")]
    got = T.locate_header(spark.createDataFrame(rows, "line long, c0 string, c1 string"), "Variable", "line").collect()
    assert [tuple(r) for r in got] == [("Tenure", "last")]


def test_write_table_returns_the_content_s_fingerprint(spark, clean_frame):
    a = T.write_table(clean_frame, scratch(spark, "t"), "CustomerID")
    b = T.write_table(clean_frame.repartition(3), scratch(spark, "t"), "CustomerID")
    assert a == b != T.write_table(clean_frame.limit(19), scratch(spark, "t"), "CustomerID")


def test_csv_null_tokens(spark, tmp_path):
    p = tmp_path / "t.csv"
    p.write_text("a,b\n1,NA\n2,\n3,x\n")
    df = T.read_table(spark, str(p), fmt="csv", schema="a long, b string", null_tokens=T.NULL_TOKENS)
    assert [r["b"] for r in df.orderBy("a").collect()] == [None, None, "x"]


def test_contract_roundtrip_and_malformed(spark, clean_frame):
    c = E.build_contract(clean_frame, CHURN)
    path = scratch(spark, "contract")
    A.write_contract(c, path)
    back = A.read_contract(spark, path)
    assert E.contract_drift(E.measured_fields(c), E.measured_fields(back)).count() == 0
    assert back.dataset["row_count"] == 20
    bad = scratch(spark, "bad")
    os.makedirs(f"{bad}/contract")
    with open(f"{bad}/contract/part-0.json", "w") as fh:
        fh.write("{not json")
    with pytest.raises(Exception):
        A.read_contract(spark, bad)


def test_events_skip_malformed_lines(spark):
    d = scratch(spark, "events") + "/run-7"
    os.makedirs(d)
    with open(f"{d}/events.jsonl", "w") as fh:
        fh.write(json.dumps({"ts": "2026-01-01T00:00:00", "step": "ingest", "status": "start"}) + "\n")
        fh.write("{broken\n")
        fh.write(json.dumps({"ts": "2026-01-01T00:00:05", "step": "flow", "status": "ok", "result": "verified"}) + "\n")
    ev = A.read_events(spark, f"{d}/*.jsonl")
    assert ev.count() == 2 and {r["run_id"] for r in ev.collect()} == {"run-7"}
    from handoff.operators.runs import run_summary
    s = run_summary(ev).collect()[0]
    assert s["result"] == "verified" and s["duration_s"] == 5.0


def test_manifest_missing_artifact_raises(spark):
    with pytest.raises(FileNotFoundError):
        A.manifest(spark, {"x": "no-such-file.parquet"}, "/root/testdata/sf0.001/*.parquet")


def test_validate_stream_reports_each_batch(spark, clean_frame):
    c = E.build_contract(clean_frame, CHURN)
    land = scratch(spark, "landing")
    clean_frame.repartitionByRange(3, "CustomerID").write.parquet(land)
    stream = M.read_stream(spark, land, clean_frame.schema, max_files_per_trigger=1)
    reports, ckpt = scratch(spark, "reports"), scratch(spark, "ckpt")
    rep = M.validate_stream(stream, c, reports, ckpt)
    assert rep.select("batch_id").distinct().count() == 3
    assert rep.where(F.col("passed") == F.lit(False)).count() == 0
    rows = rep.where(F.col("check") == "rows").orderBy("batch_id").collect()
    assert [r["passed"] for r in rows] == [None, None, True] and rows[-1]["observed"] == 20
    assert [r["passed"] for r in rep.where(F.col("check") == "integrity").orderBy("batch_id").collect()] == [None, None, True]


def test_streams_go_on_where_they_stopped(spark, clean_frame):
    c = E.build_contract(clean_frame, CHURN)
    land, out, ckpt, table, tail_ckpt = (scratch(spark, n) for n in ("landing", "reports", "ckpt", "table", "tail-ckpt"))
    for part in (clean_frame.where("CustomerID < 110"), clean_frame.where("CustomerID >= 110")):
        part.coalesce(1).write.mode("append").parquet(land)
        for _ in range(2):  # the second start finds nothing new
            rep = M.validate_stream(M.read_stream(spark, land, clean_frame.schema), c, out, ckpt)
            rows = M.tail_to_table(M.read_stream(spark, land, clean_frame.schema), table, tail_ckpt)
    assert rep.select("batch_id").distinct().count() == 2
    assert rep.groupBy("batch_id", "check", "column").count().where("count > 1").count() == 0
    assert rows.count() == 20 and rows.select("CustomerID").distinct().count() == 20
    M.write_batch(rep.where("batch_id = 1").drop("batch_id"), 1, scratch(spark, "again"))


def test_run_log_refuses_unknown_statuses_and_logs_failures(spark):
    path = scratch(spark, "events")
    log = A.RunLog(spark, path, "r1")
    with pytest.raises(ValueError):
        log.event("clean", "done")
    with pytest.raises(ValueError):
        log.event("clean", "ok", colour="red")
    assert log.run("clean", lambda: 7) == 7
    with pytest.raises(ZeroDivisionError):
        log.run("validate", lambda: 1 / 0)
    got = [(r["step"], r["status"]) for r in A.read_events(spark, f"{path}/*/*.json").orderBy("seq").collect()]
    assert got == [("clean", "start"), ("clean", "ok"), ("validate", "start"), ("validate", "fail")]


def test_publish_keeps_the_last_good_version(spark, clean_frame):
    from handoff.plans import handover as P
    run, pub = scratch(spark, "run"), scratch(spark, "pub")
    assert P.publish({"a": clean_frame}, run, pub, True) == "published"
    first = P.published(spark, pub).collect()
    assert P.publish({"a": clean_frame.limit(3)}, run, pub, False) == "refused"
    assert P.publish({"a": clean_frame.limit(3)}, run, pub, True, enabled=False) == "verified"
    assert P.published(spark, pub).collect() == first and first[0]["n_rows"] == 20
    assert P.publish({"a": clean_frame.limit(3)}, run, pub, True) == "published"
    now = P.published(spark, pub).first()
    assert now["n_rows"] == 3 and spark.read.parquet(now["path"]).count() == 3
    assert P.written_outputs(spark, run) == ["a"]


def test_of_two_publishers_one_retries(spark, clean_frame, monkeypatch):
    from handoff.plans import handover as P
    run, pub = scratch(spark, "run"), scratch(spark, "pub")
    assert P.published(spark, pub).count() == 0
    assert P.publish({"a": clean_frame}, run, pub, True) == "published"
    seen, real = P.commits(spark, pub), P.commits
    assert P.publish({"a": clean_frame.limit(2)}, run, pub, True) == "published"
    with monkeypatch.context() as other:  # this one listed the commits before the other made its own
        other.setattr(P, "commits", lambda *a: seen)
        assert P.publish({"a": clean_frame.limit(3)}, run, pub, True) == "published"
    assert [n for n, _ in real(spark, pub)] == [1, 2, 3] and P.published(spark, pub).first()["n_rows"] == 3
    with open(f"{pub}/commits/000000000004.json", "w"):
        pass  # a publisher that died after taking its number
    assert P.published(spark, pub).first()["n_rows"] == 3
    assert P.publish({"a": clean_frame.limit(4)}, run, pub, True) == "published"
    assert P.published(spark, pub).first()["n_rows"] == 4


def test_no_scratch_folder_off_a_local_master():
    from handoff import session

    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)
        getConf = staticmethod(lambda: {})

    class Session:
        sparkContext, conf = Context, {}

    with pytest.raises(RuntimeError):
        session.ensure_checkpoint_dir(Session)


def test_stratified_folds_are_exact(spark):
    df = spark.range(0, 103).select(F.col("id").alias("k"), (F.col("id") % 4 == 0).cast("int").alias("y"))
    f = J.assign_folds(df, "y", "k", 5, 42)
    per = {(r["y"], r["fold"]): r["count"] for r in f.groupBy("y", "fold").count().collect()}
    for y in (0, 1):
        sizes = [per.get((y, i), 0) for i in range(5)]
        assert max(sizes) - min(sizes) <= 1
    assert f.count() == 103 and f.select("k").distinct().count() == 103


def test_fold_medians_match_numpy(spark):
    rng = np.random.default_rng(0)
    vals = rng.normal(size=60).round(3)
    df = spark.createDataFrame([(i, float(v), i % 5) for i, v in enumerate(vals)], "k long, x double, fold int")
    got = {r["train_fold"]: r["median"] for r in J.fold_medians(df, ["x"]).collect()}
    for f in range(5):
        want = float(np.median([v for i, v in enumerate(vals) if i % 5 != f]))
        assert abs(got[f] - want) < 1e-12
