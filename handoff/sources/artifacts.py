"""Contract documents, JSON-lines run events, file digests and manifests.

File digests work on files of any size: byte ranges of ``LEAF_BYTES`` are read and hashed by separate
tasks, a piece at a time, and a file's digest is the SHA-256 of its ranges' digests in order. A file of one
range has its plain SHA-256. The number and size of the ranges stand beside the digest, so a manifest
says how it was made. (Tables get the content fingerprint of ``handoff.sources.fingerprint``.)
"""

from __future__ import annotations

import fnmatch
import hashlib
import time
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from datetime import UTC, datetime

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from handoff.config import RUN_STATUSES
from handoff.operators.contract import SPEC_SCHEMA, Contract, check_enums
from handoff.session import ensure_checkpoint_dir

DATASET_SCHEMA = ("row_count long, primary_key string, target string, target_positive_rate double, "
                  "fingerprint string")
CONTRACT_DOC_SCHEMA = (
    "contract_version string, produced_by string, created_at string, source string, "
    f"dataset struct<{DATASET_SCHEMA.replace(' long', ':long').replace(' string', ':string').replace(' double', ':double')}>, "
    "columns array<struct<" + ", ".join(f"{f.name}:{f.dataType.simpleString()}" for f in SPEC_SCHEMA.fields) + ">>, "
    "assumptions array<string>"
)
TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"
EVENT_SCHEMA = ("ts timestamp_ntz, step string, status string, duration_s double, error string, run_id string, "
                "result string, llm_calls long, cost_usd double, checks long, failed array<string>, seq long")


#: Bytes of one range of a file's digest, and bytes read at a time.
LEAF_BYTES, READ_BYTES = 64 << 20, 1 << 20


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder (never a machine-local temp dir)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def contract_document(c: Contract) -> DataFrame:
    """A5: the contract as ONE nested row (columns ordered by position; specs are metadata)."""
    spark = c.columns.sparkSession
    d, m = c.dataset, c.meta
    specs = [tuple(s[f] for f in SPEC_SCHEMA.fieldNames()) for s in c.specs()]
    row = (m.get("contract_version"), m.get("produced_by"), m.get("created_at"), m.get("source"),
           (d["row_count"], d["primary_key"], d["target"], d["target_positive_rate"], d.get("fingerprint")),
           specs, list(m.get("assumptions") or []))
    return spark.createDataFrame([row], CONTRACT_DOC_SCHEMA)


def write_contract(c: Contract, path: str) -> None:
    """A5: contract JSON document plus its (column, value) allowed-value table."""
    contract_document(c).coalesce(1).write.mode("overwrite").json(f"{path}/contract")
    c.allowed.write.mode("overwrite").parquet(f"{path}/allowed")


def read_contract(spark: SparkSession, path: str) -> Contract:
    """Read a contract back; a malformed document or an unknown dtype/role fails loudly."""
    doc = spark.read.schema(CONTRACT_DOC_SCHEMA).option("mode", "FAILFAST").option("multiLine", True).json(f"{path}/contract")
    rows = doc.collect()
    if len(rows) != 1:
        raise ValueError(f"expected one contract document at {path}, found {len(rows)}")
    r = rows[0]
    if r["dataset"] is None or r["columns"] is None:
        raise ValueError(f"malformed contract at {path}: dataset and columns are required")
    columns = spark.createDataFrame([x.asDict() for x in r["columns"]], SPEC_SCHEMA)
    bad = check_enums(columns).collect()
    if bad:
        raise ValueError(f"malformed contract at {path}: unknown dtype/role in {[b['name'] for b in bad]}")
    allowed = spark.read.parquet(f"{path}/allowed")
    meta = dict(contract_version=r["contract_version"], produced_by=r["produced_by"], created_at=r["created_at"],
                source=r["source"], assumptions=list(r["assumptions"] or []))
    return Contract(columns, allowed, r["dataset"].asDict(), meta)


class RunLog:
    """Events of one run, each appended as one JSON line in a file of its own below ``path``/run_id."""

    def __init__(self, spark: SparkSession, path: str, run_id: str):
        self.spark, self.run_id, self.folder = spark, run_id, f"{path}/{run_id}"
        self.seq = self._written()

    def _written(self) -> int:
        """The number after the last event of this run that is already there (a run that is taken up again)."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        if not path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path):
            return 0
        last = self.spark.read.schema(EVENT_SCHEMA).json(self.folder).agg(F.max("seq")).first()[0]
        return 0 if last is None else last + 1

    def event(self, step: str, status: str, **cells) -> None:
        """Append one event; an unknown status or field is refused."""
        fields = StructType.fromDDL(EVENT_SCHEMA)
        if status not in RUN_STATUSES:
            raise ValueError(f"{status} is no status of a run; there are {', '.join(RUN_STATUSES)}")
        if unknown := set(cells) - set(fields.fieldNames()):
            raise ValueError(f"an event has no {', '.join(sorted(unknown))}")
        now = datetime.now(UTC).replace(tzinfo=None)
        row = dict.fromkeys(fields.fieldNames()) | cells | dict(ts=now, step=step, status=status, seq=self.seq, run_id=self.run_id)
        self.spark.createDataFrame([tuple(row.values())], fields).coalesce(1).write.mode("append").option("timestampNTZFormat", TS_FORMAT).json(self.folder)
        self.seq += 1

    def run(self, step: str, work: Callable, **cells):
        """Do the work between a start and an ok event; a failure leaves a fail event and is raised again."""
        self.event(step, "start")
        began = time.monotonic()
        try:
            result = work()
        except Exception as error:
            self.event(step, "fail", duration_s=round(time.monotonic() - began, 3), error=str(error)[:500])
            raise
        self.event(step, "ok", duration_s=round(time.monotonic() - began, 3), **cells)
        return result


def write_document(rows: DataFrame, path: str) -> None:
    """A5: a small document of statistics or metrics as JSON lines, fields and rows in sorted order."""
    names = sorted(rows.columns)
    rows.select(*names).coalesce(1).sortWithinPartitions(*names).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def read_events(spark: SparkSession, glob: str) -> DataFrame:
    """JSON-lines run events; lines that do not parse are skipped; run id from the file's folder.

    ``seq`` (line order) is taken from the record when present, else from the place in the file: the start of
    the split that was read and the row's number in it, which order a file's lines whatever its splits are.
    """
    place = F.struct(F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("row"))
    df = (spark.read.schema(EVENT_SCHEMA).option("mode", "DROPMALFORMED").option("timestampNTZFormat", TS_FORMAT).json(glob)
          .select("*", F.col("_metadata.file_path").alias("_path"), place.alias("_place")))
    folder = F.element_at(F.split(F.col("_path"), "/"), -2)
    # a line is longer than a byte, so start + row grows along the file and no two lines share it
    line = F.col("_place.start") + F.col("_place.row")
    return df.select(
        F.coalesce(F.col("run_id"), folder).alias("run_id"),
        F.coalesce(F.col("seq"), line).alias("seq"),
        "ts", "step", "status", "result", "duration_s", "llm_calls", "cost_usd", "error", "checks", "failed",
    ).where(F.col("ts").isNotNull() & F.col("step").isNotNull())


def listed_files(spark: SparkSession, glob: str, names: Sequence[str] | None = None) -> list[tuple[str, str, int]]:
    """(path, name, bytes) of the files that match the glob and one of the name patterns; nothing is read."""
    path = spark._jvm.org.apache.hadoop.fs.Path(glob)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []
    files = [(f.getPath().toString(), f.getPath().getName(), f.getLen()) for f in found if f.isFile()]
    return [f for f in files if names is None or any(fnmatch.fnmatch(f[1], n) for n in names)]


def file_digests(spark: SparkSession, glob: str, names: Sequence[str] | None = None, leaf_bytes: int = LEAF_BYTES) -> DataFrame:
    """(path, name, bytes, sha256, leaves, leaf_bytes) of every file matching the glob (and one of the names)."""
    files = spark.createDataFrame(listed_files(spark, glob, names), "path string, name string, bytes long")
    last = F.greatest(F.expr(f"(bytes + {leaf_bytes - 1}) div {leaf_bytes}"), F.lit(1)) - 1
    ranges = files.select("*", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("leaf"))
    tasks = max(1, min(4 * spark.sparkContext.defaultParallelism, ranges.count()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests = [_range_digest(r["path"], r["leaf"] * leaf_bytes, min(leaf_bytes, r["bytes"] - r["leaf"] * leaf_bytes)) for r in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(digests, pa.string())], names=[*batch.schema.names, "digest"])

    hashed = ranges.repartition(tasks, "path", "leaf").mapInArrow(run, "path string, name string, bytes long, leaf long, digest string")
    leaves = F.transform(F.array_sort(F.collect_list(F.struct("leaf", "digest"))), lambda x: x["digest"])
    whole = hashed.groupBy("path", "name", "bytes").agg(leaves.alias("d"))  # one digest per range of a file
    one = F.size("d") == 1
    return whole.select("path", "name", "bytes", F.when(one, F.col("d")[0]).otherwise(F.sha2(F.array_join("d", ""), 256)).alias("sha256"),
                        F.size("d").cast("long").alias("leaves"), F.lit(leaf_bytes).cast("long").alias("leaf_bytes"))


def _range_digest(path: str, start: int, length: int) -> str:
    """SHA-256 of a byte range, read piece by piece."""
    fs, name = pafs.FileSystem.from_uri("file://" + path[5:] if path.startswith("file:/") and not path.startswith("file://") else path)
    digest = hashlib.sha256()
    with fs.open_input_file(name) as f:
        f.seek(start)
        while length > 0:
            piece = f.read(min(READ_BYTES, length))
            if not piece:
                raise OSError(f"{path} became shorter while it was read")
            digest.update(piece)
            length -= len(piece)
    return digest.hexdigest()


def manifest(spark: SparkSession, artifacts: Mapping[str, str], glob: str) -> DataFrame:
    """A10: (name, path, sha256, bytes, leaves, leaf_bytes) for the named artifacts; a missing artifact raises.

    Only the named files are read: the names are known before any file is opened.
    """
    wanted = spark.createDataFrame(list(artifacts.items()), "name string, file string")
    found = file_digests(spark, glob, list(artifacts.values()))
    dig = found.select(F.col("name").alias("file"), "path", "sha256", "bytes", "leaves", "leaf_bytes")
    j = wanted.join(dig, "file", "left")
    missing = [r["name"] for r in j.where(F.col("path").isNull()).select("name").collect()]
    if missing:
        raise FileNotFoundError(f"artifact(s) missing: {missing}")
    return j.select("name", "path", "sha256", "bytes", "leaves", "leaf_bytes")


def verify_manifest(listed: DataFrame, fresh: DataFrame, required: Sequence[str] = ()) -> DataFrame:
    """Problems (name, problem): listed file absent or changed; required name not listed."""
    spark = listed.sparkSession
    j = listed.alias("m").join(fresh.alias("f"), F.col("m.path") == F.col("f.path"), "left")
    bad = j.select(F.col("m.name").alias("name"),
                   F.when(F.col("f.path").isNull(), F.lit("missing"))
                   .when(F.col("f.sha256") != F.col("m.sha256"), F.lit("hash differs")).alias("problem")
                   ).where(F.col("problem").isNotNull())
    req = spark.createDataFrame([(n,) for n in required], "name string")
    unlisted = req.join(listed.select("name"), "name", "left_anti").select("name", F.lit("not listed").alias("problem"))
    return bad.unionByName(unlisted)
