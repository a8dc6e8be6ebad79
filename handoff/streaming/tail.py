"""M1: the tail of files that grow, as a streaming source of whole lines.

The offset of the stream is one byte position per file. A micro-batch reads what was appended since the
last one, up to the last line end; an unfinished last line is held back until its line end is there,
so a line is delivered once, whole. New files start at byte 0. Large appends are cut into byte ranges
that are read by separate tasks; a line belongs to the range in which it starts. Offsets are kept in the
query's checkpoint, so a restarted query goes on at the byte where it stopped.

A file that became shorter than its offset was replaced, not appended to: that is an error, because
lines that were delivered cannot be taken back. The driver lists files and finds line ends; it reads no
more than the unfinished end of each file.
"""

from __future__ import annotations

import fnmatch
import json
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from handoff.sources.artifacts import EVENT_SCHEMA, TS_FORMAT

#: Bytes of one task's range, of one read when looking for a line end, and rows of one Arrow batch.
RANGE_BYTES, STEP_BYTES, BATCH_LINES = 32 << 20, 1 << 16, 10_000
LINE_SCHEMA = "path string, position long, line string"


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[5:]
    return pafs.FileSystem.from_uri(path)


def last_line_end(fs: pafs.FileSystem, path: str, start: int, size: int) -> int:
    """Byte after the last line end in [start, size); ``start`` if there is none."""
    with fs.open_input_file(path) as f:
        end = size
        while end > start:
            begin = max(start, end - STEP_BYTES)
            at = f.read_at(end - begin, begin).rfind(b"\n")
            if at >= 0:
                return begin + at + 1
            end = begin
    return start


class Range(InputPartition):
    """Bytes [start, end) of a file; ``first`` says that a line starts at ``start``."""

    def __init__(self, path: str, start: int, end: int, limit: int, first: bool):
        self.path, self.start, self.end, self.limit, self.first = path, start, end, limit, first


def lines_of(fs: pafs.FileSystem, r: Range) -> Iterator[tuple[int, bytes]]:
    """(position, line) of the lines that start in the range; the last one may end behind it."""
    with fs.open_input_file(r.path) as f:
        at = r.start
        if not r.first:  # the line that reaches into the range belongs to the one before
            f.seek(r.start - 1)
            at = r.start - 1 + len(_read_line(f))
        f.seek(at)
        while at < r.end:
            line = _read_line(f)
            yield at, line.rstrip(b"\n").removesuffix(b"\r")
            at += len(line)


def _read_line(f) -> bytes:
    """Bytes up to and with the next line end."""
    parts = []
    while True:
        here = f.tell()
        part = f.read(STEP_BYTES)
        at = part.find(b"\n")
        if at >= 0 or not part:
            f.seek(here + at + 1 if part else here)
            parts.append(part[: at + 1])
            return b"".join(parts)
        parts.append(part)


class TailReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.folder, self.glob = options["path"], options.get("glob", "*")
        self.range_bytes = int(options.get("rangeBytes", RANGE_BYTES))
        self._seen: dict[str, int] = {}

    def initialOffset(self) -> dict:
        return {"files": "{}"}

    def latestOffset(self) -> dict:
        fs, root = file_system(self.folder)
        known, found = self._seen, dict(self._seen)
        for info in fs.get_file_info(pafs.FileSelector(root, recursive=True, allow_not_found=True)):
            name = info.path[len(root):].lstrip("/")
            if info.type == pafs.FileType.File and fnmatch.fnmatch(info.base_name, self.glob) and not info.base_name.startswith(("_", ".")):
                found[name] = last_line_end(fs, info.path, min(known.get(name, 0), info.size), info.size)
        return {"files": json.dumps(found, sort_keys=True)}

    def partitions(self, start: dict, end: dict) -> list[Range]:
        fs, root = file_system(self.folder)
        old, new = json.loads(start["files"]), json.loads(end["files"])
        self._seen = new
        out = []
        for name, upto in new.items():
            begin = old.get(name, 0)
            if upto < begin:
                raise RuntimeError(f"{name} has {upto} bytes of whole lines, {begin} were delivered: it was replaced")
            path = f"{root}/{name}"
            out += [Range(path, at, min(upto, at + self.range_bytes), upto, at == begin) for at in range(begin, upto, self.range_bytes)]
        return out

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        fs, root = file_system(self.folder)
        name = partition.path[len(root):].lstrip("/")
        held: list[tuple[int, bytes]] = []

        def batch() -> pa.RecordBatch:
            texts = [line.decode("utf-8", "replace") for _, line in held]
            return pa.RecordBatch.from_arrays([pa.array([name] * len(held)), pa.array([at for at, _ in held], pa.int64()), pa.array(texts, pa.string())],
                                              names=["path", "position", "line"])

        for item in lines_of(fs, partition):
            held.append(item)
            if len(held) >= BATCH_LINES:
                yield batch()
                held = []
        if held:
            yield batch()


class AppendedLines(DataSource):
    """``spark.readStream.format("appended_lines").option("glob", ...).load(folder)``."""

    @classmethod
    def name(cls) -> str:
        return "appended_lines"

    def schema(self) -> str:
        return LINE_SCHEMA

    def streamReader(self, schema) -> TailReader:
        return TailReader(self.options)


def appended_lines(spark: SparkSession, folder: str, glob: str = "*", range_bytes: int = RANGE_BYTES) -> DataFrame:
    """M1: stream of (path, position, line): every whole line of the files below the folder, once."""
    spark.dataSource.register(AppendedLines)
    return spark.readStream.format("appended_lines").option("glob", glob).option("rangeBytes", range_bytes).load(folder)


def appended_events(lines: DataFrame) -> DataFrame:
    """M1: the run events among the lines; lines that do not parse are skipped, the position orders a run's lines."""
    parsed = F.from_json("line", EVENT_SCHEMA, {"timestampNTZFormat": TS_FORMAT, "mode": "PERMISSIVE"})
    folder = F.element_at(F.split("path", "/"), -2)
    rows = lines.select("path", "position", parsed.alias("e"))
    return rows.select(
        F.coalesce("e.run_id", F.when(F.size(F.split("path", "/")) > 1, folder)).alias("run_id"), F.coalesce("e.seq", "position").alias("seq"),
        *[F.col(f"e.{c}").alias(c) for c in ("ts", "step", "status", "result", "duration_s", "llm_calls", "cost_usd", "error", "checks", "failed")],
    ).where(F.col("ts").isNotNull() & F.col("step").isNotNull())
