"""Consolidation of masses of tiny files by merging sorted runs.

1. Lines of the small files are sorted into runs of bounded size, as they come.
2. The key space (key, newest first, file, line) is cut into ranges of about equal
   bytes. Each run is cut at the range bounds; a segment, one run's sorted share of
   a range, is one row of the shuffle.
3. Each range merges its segments k ways, as a stream of rows in order, and rolls
   them into output files by bytes. All duplicates are kept. A range is bounded by
   bytes, not by keys: a key that holds a third of all rows spans many ranges. A
   task holds a range's segments compressed and a page of each unpacked.
4. The range metadata (key range, rows, bytes of each file) is taken from the files
   as written.

Defined cases: null and empty contents, blank lines and lines that are no valid
JSON hold no records; a null ``written_at`` is older than any other; a file
listed twice counts once; a record without ``record_id`` is no record; of keys
repeated within one line the last counts; a row above the target fills a file alone.
"""

from __future__ import annotations

import bisect
import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from docloom.operators.delta import is_success
from docloom.session import materialise, scratch_path

TARGET_BYTES = 128 << 20  # of an output file
RANGE_BYTES = 64 << 20  # of a key range, which one task merges
RUN_BYTES = 16 << 20  # of a sorted run
MOST_RANGES = 100_000  # whose bounds the driver holds and tasks get; beyond that ranges grow with the data
BOUND_SAMPLES, MOST_SAMPLES = 20, 1_000_000  # sampled keys for each range bound, and at most
PAGE_ROWS = 1024  # of a segment that are unpacked at once

LINES = "record_id string, written_at timestamp, file_id bigint, line_no int, line string"


def vouched_files(files: DataFrame, jobs: DataFrame) -> DataFrame:
    """Files whose path is listed with success by their own job."""
    listed = (
        jobs.select(F.col("job_id").alias("l_job"), F.explode("files_output").alias("f"))
        .where(is_success(F.col("f.status")))
        .select("l_job", F.col("f.path").alias("l_path"))
    )
    return files.join(
        listed, (F.col("job_id") == F.col("l_job")) & (F.col("path") == F.col("l_path")), "left_semi"
    )


def record_key(line: Column) -> Column:
    """record_id of a line that is exactly one JSON object, else null.

    Inside brackets anything that follows the object makes the whole text invalid
    or a second element.
    """
    strict = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}
    rows = F.from_json(F.concat(F.lit("["), line, F.lit("]")), "array<struct<record_id: string>>", strict)
    return F.when(line.rlike(r"^\s*\{") & (F.size(rows) == 1), F.get(rows, F.lit(0))["record_id"])


def lines_of(files: DataFrame) -> DataFrame:
    """One row per record line: record_id, written_at, file_id, line_no, line."""
    lines = files.select(
        "file_id", "written_at", F.posexplode(F.split("content", "\n")).alias("line_no", "line")
    ).where(F.col("line").contains("{"))
    return lines.select(record_key(F.col("line")).alias("record_id"), "written_at", "file_id", "line_no", "line").where(
        F.col("record_id").isNotNull()
    )


# --- runs, segments, merge ----------------------------------------------------------------

Key = tuple[str, int, int, int]  # record_id, age (newest first), file_id and line_no (last first)
_OLDEST = 1 << 62
SEGMENTS = "range int, run string, n_rows bigint, n_bytes bigint, rows binary"
_SEGMENTS = pa.schema([("range", pa.int32()), ("run", pa.string()), ("n_rows", pa.int64()), ("n_bytes", pa.int64()), ("rows", pa.binary())])
MERGED = "record_id string, written_at timestamp, file_id bigint, line_no int, line string, out_file string"
_ROWS = pa.schema([
    ("record_id", pa.string()), ("written_at", pa.int64()), ("file_id", pa.int64()), ("line_no", pa.int32()), ("line", pa.string()),
])


def sort_key(record_id: str, micros: int | None, file_id: int, line_no: int) -> Key:
    return record_id, _OLDEST if micros is None else -micros, -file_id, -line_no


def _packed(rows: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, _ROWS, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
        w.write_table(rows, max_chunksize=PAGE_ROWS)
    return sink.getvalue().to_pybytes()


def _segments(bounds: list[Key], run_bytes: int):
    def cut(held: list[pa.RecordBatch], run: str) -> pa.RecordBatch:
        """One sorted run as its segments."""
        t = pa.Table.from_batches(held).cast(_ROWS)
        keys = [sort_key(*k) for k in zip(*(t.column(c).to_pylist() for c in ("record_id", "written_at", "file_id", "line_no")))]
        order = sorted(range(len(keys)), key=keys.__getitem__)
        t, keys = t.take(pa.array(order)), [keys[i] for i in order]
        places = [0, *(bisect.bisect_left(keys, b) for b in bounds), len(keys)]
        out = []
        for k, (a, b) in enumerate(zip(places, places[1:])):
            if a < b:
                part = t.slice(a, b - a)
                out.append((k, run, b - a, sum(len(x) for x in part.column("line").to_pylist()), _packed(part)))
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _SEGMENTS)], schema=_SEGMENTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ctx = TaskContext.get()
        part, n, held, size = ctx.partitionId() if ctx else 0, 0, [], 0
        for b in batches:
            if b.num_rows:
                held.append(b)
                size += b.nbytes
            if size > run_bytes:
                yield cut(held, f"{part}-{n}")
                n, held, size = n + 1, [], 0
        if held:
            yield cut(held, f"{part}-{n}")

    return run


def _rows_of(segment: bytes) -> Iterator[tuple[Key, tuple]]:
    """A segment's rows in order, one batch in memory at a time."""
    with pa.ipc.open_stream(segment) as r:
        for b in r:
            for row in zip(*(c.to_pylist() for c in b.columns)):
                yield sort_key(*row[:4]), row


_MERGED = pa.schema([*(pa.field("written_at", pa.timestamp("us", "UTC")) if f.name == "written_at" else f for f in _ROWS), pa.field("out_file", pa.string())])


def _merge(target: int):
    def run(segments: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, streams = 0, []
        for b in segments:
            number = b.column("range")[0].as_py()
            streams += [_rows_of(s.as_buffer()) for s in b.column("rows")]
        out, seq, filled = [], 0, 0
        for _, row in heapq.merge(*streams, key=lambda x: x[0]):
            size = len(row[4].encode()) + 1
            if filled and filled + size > target:
                seq, filled = seq + 1, 0
            filled += size
            out.append((*row, f"range-{number:06d}-{seq:04d}"))
            if len(out) == 4096:
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out), _MERGED)], schema=_MERGED)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out), _MERGED)], schema=_MERGED)

    return run


def range_bounds(lines: DataFrame, ranges: int) -> list[Key]:
    """Lower bounds of all ranges but the first, from a sample of about BOUND_SAMPLES keys a
    range (MOST_SAMPLES in all)."""
    if ranges < 2:
        return []
    total = lines.count()
    share = min(1.0, min(BOUND_SAMPLES * ranges, MOST_SAMPLES) / max(total, 1))
    picked = lines.where(F.pmod(F.xxhash64("file_id", "line_no"), F.lit(1 << 30)) < int(share * (1 << 30)))
    keys = picked.select("record_id", F.unix_micros("written_at").alias("m"), "file_id", "line_no", F.octet_length("line").alias("n")).collect()
    weighed = sorted((sort_key(*r[:4]), r.n) for r in keys)
    step, filled, out = sum(n for _, n in weighed) / ranges, 0.0, []
    for k, n in weighed:
        if filled >= step * (len(out) + 1) and len(out) < ranges - 1 and (not out or k > out[-1]):
            out.append(k)
        filled += n
    return out


def merge_runs(lines: DataFrame, target_bytes: int = TARGET_BYTES, range_bytes: int = RANGE_BYTES, run_bytes: int = RUN_BYTES) -> DataFrame:
    """All lines in key order with the output file each belongs to.

    ``lines`` is read three times (bytes, bounds, runs): give it written.
    """
    n_bytes = lines.agg(F.sum(F.octet_length("line"))).first()[0] or 0
    ranges = min(MOST_RANGES, max(1, -(-int(n_bytes) // range_bytes)))
    bounds = range_bounds(lines, ranges)
    micros = lines.select("record_id", F.unix_micros("written_at").alias("written_at"), "file_id", "line_no", "line")
    segments = micros.mapInArrow(_segments(bounds, run_bytes), SEGMENTS)
    return segments.groupBy("range").applyInArrow(_merge(target_bytes), MERGED)


def write_consolidated(files: DataFrame, path: str, target_bytes: int = TARGET_BYTES, range_bytes: int = RANGE_BYTES, run_bytes: int = RUN_BYTES) -> DataFrame:
    """Merge the records of ``files`` into few files below ``path`` and read them back.

    Each output file lies in a folder of its name; a range is written by one task
    and committed by Spark's committer, so a lost executor neither loses nor
    doubles a record.
    """
    spark = files.sparkSession
    lines = materialise(lines_of(files), "lines")
    merged = merge_runs(lines, target_bytes, range_bytes, run_bytes)
    merged.write.partitionBy("out_file").parquet(path)
    return spark.read.schema(MERGED).parquet(path)


def consolidated(files: DataFrame, target_bytes: int = TARGET_BYTES) -> DataFrame:
    """As ``write_consolidated``, into the shared scratch folder."""
    return write_consolidated(files, scratch_path(files.sparkSession, "consolidated"), target_bytes)


def current_records(merged: DataFrame) -> DataFrame:
    """Each record once, with the file it is taken from."""
    best = F.max(F.struct("written_at", "file_id"))
    return merged.groupBy("record_id").agg(best.alias("b")).select("record_id", F.col("b.file_id").alias("file_id"))


def current_lines(merged: DataFrame) -> DataFrame:
    """record_id and line of each record's newest revision; of its file's lines the last counts."""
    best = F.max(F.struct("written_at", "file_id", "line_no", "line"))
    return merged.groupBy("record_id").agg(best.alias("b")).select("record_id", F.col("b.line").alias("line"))


def range_metadata(merged: DataFrame) -> DataFrame:
    """Key range, rows and bytes of each output file."""
    return merged.groupBy("out_file").agg(
        F.min("record_id").alias("min_key"), F.max("record_id").alias("max_key"),
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.octet_length("line") + 1).cast("bigint").alias("n_bytes"),
    )
