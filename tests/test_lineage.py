"""File digests by byte ranges, manifests, run logs that go on, metric comparisons."""

import hashlib
import json
import os
import uuid

import pytest

from handoff.operators import evaluate as K
from handoff.session import ensure_checkpoint_dir
from handoff.sources import artifacts as A


def scratch(spark, name):
    base = ensure_checkpoint_dir(spark)
    base = base[len("file:"):] if base.startswith("file:") else base
    path = f"{base}/{name}-{uuid.uuid4().hex[:8]}"
    os.makedirs(path)
    return path


def tree(data, leaf):
    parts = [hashlib.sha256(data[i: i + leaf]).hexdigest() for i in range(0, max(1, len(data)), leaf)]
    return parts[0] if len(parts) == 1 else hashlib.sha256("".join(parts).encode()).hexdigest()


def test_digests_are_the_hash_tree_of_the_ranges(spark):
    folder = scratch(spark, "files")
    files = {"empty": b"", "one": b"x" * 10, "full": b"y" * 100, "more": os.urandom(1234)}
    for name, data in files.items():
        with open(f"{folder}/{name}", "wb") as f:
            f.write(data)
    got = {r["name"]: r for r in A.file_digests(spark, f"{folder}/*", leaf_bytes=100).collect()}
    for name, data in files.items():
        assert (got[name]["sha256"], got[name]["bytes"], got[name]["leaves"]) == (tree(data, 100), len(data), max(1, -(-len(data) // 100)))
    plain = {r["name"]: r["sha256"] for r in A.file_digests(spark, f"{folder}/*").collect()}
    assert plain == {n: hashlib.sha256(d).hexdigest() for n, d in files.items()}
    assert [r["name"] for r in A.file_digests(spark, f"{folder}/*", ["o*"]).collect()] == ["one"]
    assert A.file_digests(spark, f"{folder}/nothing*").count() == 0


def test_a_file_of_three_gigabytes(spark):
    path = f"{scratch(spark, 'large')}/sparse"
    size = 3 << 30
    with open(path, "wb") as f:
        f.truncate(size)
        f.seek(size - 1)
        f.write(b"z")
    r = A.file_digests(spark, path).first()
    zero = hashlib.sha256(bytes(A.LEAF_BYTES)).hexdigest()
    last = hashlib.sha256(bytes(A.LEAF_BYTES - 1) + b"z").hexdigest()
    assert (r["bytes"], r["leaves"]) == (size, 48)
    assert r["sha256"] == hashlib.sha256("".join([zero] * 47 + [last]).encode()).hexdigest()
    os.truncate(path, 0)


def test_manifest_names_what_is_missing_changed_or_not_listed(spark):
    folder = scratch(spark, "artifacts")
    for name in "abc":
        with open(f"{folder}/{name}.bin", "w") as f:
            f.write(name * 50)
    listed = spark.createDataFrame(
        A.manifest(spark, {n: f"{n}.bin" for n in "abc"}, f"{folder}/*.bin").collect())
    assert A.verify_manifest(listed, A.file_digests(spark, f"{folder}/*.bin"), list("abc")).count() == 0
    with open(f"{folder}/a.bin", "a") as f:
        f.write("!")
    os.remove(f"{folder}/b.bin")
    bad = A.verify_manifest(listed, A.file_digests(spark, f"{folder}/*.bin"), ["a", "d"])
    assert sorted(map(tuple, bad.collect())) == [("a", "hash differs"), ("b", "missing"), ("d", "not listed")]


def test_a_run_taken_up_again_goes_on_counting(spark):
    path = scratch(spark, "runs")
    first = A.RunLog(spark, path, "r")
    first.event("a", "start")
    first.event("a", "ok")
    again = A.RunLog(spark, path, "r")
    again.event("b", "start")
    assert sorted(r["seq"] for r in A.read_events(spark, f"{path}/*/*.json").collect()) == [0, 1, 2]


def test_line_order_does_not_depend_on_splits(spark):
    folder = scratch(spark, "log") + "/run"
    os.makedirs(folder)
    with open(f"{folder}/events.jsonl", "w") as f:
        for i in range(4000):
            f.write(json.dumps({"ts": "2026-01-01T00:00:00", "step": f"s{i:05d}", "status": "ok"}) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        rows = A.read_events(spark, f"{folder}/*.jsonl")
        assert rows.rdd.getNumPartitions() > 4
        got = rows.collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len({r["seq"] for r in got}) == 4000
    assert [r["step"] for r in sorted(got, key=lambda r: r["seq"])] == [f"s{i:05d}" for i in range(4000)]


def test_a_metric_on_one_side_only_is_the_worst(spark):
    a = spark.createDataFrame([("x", 1.0), ("y", 2.0), ("only a", 1.0)], "path string, value double")
    b = spark.createDataFrame([("x", 1.4), ("y", 2.0)], "path string, value double")
    r = K.worst_delta(K.metric_delta(a, b)).first()
    assert (r["path"], r["delta"], r["all_within"]) == ("only a", None, False)
    r = K.worst_delta(K.metric_delta(a.where("path <> 'only a'"), b)).first()
    assert (r["path"], r["delta"]) == ("x", pytest.approx(0.4))


def test_rows_without_a_score_are_left_out_and_counted(spark):
    rows = [(1, 0.9), (0, 0.1), (1, None), (0, float("nan")), (1, 0.8), (0, 0.85)]
    s = spark.createDataFrame(rows, "y int, proba double")
    assert K.roc_auc(s).first()["roc_auc"] == K.roc_auc(s.where("proba is not null and not isnan(proba)")).first()["roc_auc"] == 0.75
    assert K.unscored(s).first().asDict() == {"n": 6, "unscored": 2}


def test_comparison_has_stds_and_precision_at_the_top(spark):
    scores = spark.createDataFrame([(i, i % 2, i % 5, float(i % 7) / 7) for i in range(60)], "id long, y int, fold int, proba double")
    summary = K.fold_summary(K.fold_metrics(scores.selectExpr("*", "'m' AS variant"), group_by=["variant", "fold"]))
    table = K.comparison_table(K.majority_baseline(scores), summary, "m", {"m": 0.5})
    base, row = table.orderBy("order").collect()
    want = {r["metric"]: r for r in summary.collect()}
    assert base["variant"] == "baseline" and base["f1_std"] is None and base["precision_at_top10"] == 0.5
    assert all(row[m] == pytest.approx(want[m]["mean"]) and row[f"{m}_std"] == pytest.approx(want[m]["std"]) for m in want)
    assert row["precision_at_top10"] == 0.5 and row["served"]
