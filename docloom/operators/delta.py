"""Incremental processing by diffing immutable table-version manifests.

A *manifest* describes one version of a table: one row per data file with its
``path`` and ``version`` (a monotone number such as the modification time), and
a deletion vector, one row (``path``, ``pos``) per row that the version no longer
holds. A row enters its file with the version it was written in. Comparing two
manifests gives the files added, changed and removed, and from those the
record-level delta. The version that was processed is stored in the same
atomic commit as the output, so a crash neither skips nor repeats a record.

Defined cases: a null version covers nothing (as an old entry) and is always
pending (as a new entry); blank and null paths never match each other, such a
new entry is pending; an empty old manifest makes everything pending; repeated
entries collapse to the largest version.
"""

from __future__ import annotations

import json
import os
import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from docloom.session import scratch_path

BLANKS = r"[\x{09}-\x{0d}\x{1c}-\x{20}\x{85}\p{Z}]+"


def normal_path(path: Column) -> Column:
    """One spelling per file: no blanks around, no ``file://``, ``//`` or ``/./``."""
    p = F.regexp_replace(path, f"^{BLANKS}|{BLANKS}$", "")
    p = F.regexp_replace(p, r"(?i)^file:/*", "/")
    return F.regexp_replace(F.regexp_replace(p, r"/(?:\./)+", "/"), r"/(?:\.?/)+", "/")


def is_success(status: Column) -> Column:
    return F.lower(F.regexp_replace(status, f"^{BLANKS}|{BLANKS}$", "")) == F.lit("processed")


def manifest(entries: DataFrame, path: Column, version: Column) -> DataFrame:
    """Manifest of a version from raw entries; duplicates keep the largest version."""
    return (
        entries.select(path.alias("path"), version.cast("bigint").alias("version"))
        .groupBy("path")
        .agg(F.max("version").alias("version"))
    )


def diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """Changed entries of ``new`` against ``old``: path, version, change.

    Both sides have unique paths after aggregation, so the join keys cannot be
    skewed. ``change`` is added, modified or removed; entries whose old version
    is at least the new one are unchanged and left out.
    """
    o = old.select(F.col("path").alias("o_path"), F.col("version").alias("o_version"))
    joined = new.join(o, F.col("path") == F.col("o_path"), "full_outer")
    change = (
        F.when(F.col("path").isNull() & F.col("o_path").isNotNull(), "removed")
        .when(F.col("o_path").isNull(), "added")
        .when(F.col("o_version").isNull() | F.col("version").isNull() | (F.col("version") > F.col("o_version")), "modified")
    )
    return joined.select(
        F.coalesce("path", "o_path").alias("path"), "version", change.alias("change"),
    ).where(F.col("change").isNotNull())


def record_delta(rows: DataFrame, old: DataFrame, new: DataFrame, old_deleted: DataFrame, new_deleted: DataFrame) -> DataFrame:
    """Record-level delta between two manifests with deletion vectors.

    ``old``/``new``: unique path, version; ``old_deleted``/``new_deleted``: path, pos;
    ``rows``: path, pos, version and payload columns of all files of either manifest.
    A version of a file holds the rows written up to it, without its deleted ones; a
    null version in ``old`` holds nothing, in ``new`` all rows. Adds ``change``:
    insert (held by new only) or delete (held by old only).

    Files whose version and deletion vector are the same on both sides can't
    contribute and their rows are dropped first. Vectors are joined by (path, pos),
    never gathered, so neither a huge file nor a long vector is a hot key there.
    """
    o = old.select(F.col("path").alias("o_path"), F.col("version").alias("o_version"), F.lit(True).alias("was_file"))
    n = new.select(F.col("path").alias("n_path"), F.col("version").alias("n_version"), F.lit(True).alias("is_file"))
    files = n.join(o, F.col("n_path") == F.col("o_path"), "full_outer").select(F.coalesce("n_path", "o_path").alias("f_path"), "o_version", "n_version", "was_file", "is_file")
    side = lambda d, s: d.select(F.col("path").alias("d_path"), F.col("pos").alias("d_pos")).distinct().withColumn(s, F.lit(True))
    vectors = side(new_deleted, "n_gone").join(side(old_deleted, "o_gone"), ["d_path", "d_pos"], "full_outer")
    version = F.col("version")
    placed = rows.join(files, F.col("path").eqNullSafe(F.col("f_path")))
    was = F.col("was_file").isNotNull() & F.coalesce(version <= F.col("o_version"), F.lit(False))
    now = F.col("is_file").isNotNull() & (F.col("n_version").isNull() | F.coalesce(version <= F.col("n_version"), F.lit(True)))
    # rows that both versions may hold need a look at the vectors, rows that neither may hold none
    placed = placed.withColumns({"_was": was, "_now": now}).where("_was or _now")
    joined = placed.join(vectors, (F.col("path").eqNullSafe(F.col("d_path"))) & (F.col("pos") == F.col("d_pos")), "left")
    held_was = F.col("_was") & F.col("o_gone").isNull()
    held_now = F.col("_now") & F.col("n_gone").isNull()
    change = F.when(held_now & ~held_was, "insert").when(held_was & ~held_now, "delete")
    return joined.withColumn("change", change).where("change is not null").select(*rows.columns, "change")


def superseded(rows: DataFrame, key: str = "record_id") -> DataFrame:
    """Deletion vector of the newest version: path, pos of rows that a newer row of their key replaces.

    The newest row of each key is a partial aggregate (no window gathers a key's
    rows); all other rows are found by position, so a hot key stays spread.
    """
    rank = F.struct(F.col("version"), F.col("path"), F.col("pos"))
    kept = rows.groupBy(key).agg(F.max(rank).alias("k")).select(F.col("k.path").alias("k_path"), F.col("k.pos").alias("k_pos"))
    return rows.select("path", "pos").join(
        kept, (F.col("pos") == F.col("k_pos")) & F.col("path").eqNullSafe(F.col("k_path")), "left_anti"
    )


def content_rows(records: DataFrame) -> DataFrame:
    """Rows of the content table: path, pos, version, record_id, last_modified_timestamp_millis."""
    modified = F.col("last_modified_timestamp_millis")
    return records.select(
        normal_path(F.col("file_path")).alias("path"), F.col("row_id").alias("pos"), modified.alias("version"), "record_id", modified,
    )


def processed_manifest(control: DataFrame, step: str = "extract") -> DataFrame:
    """Manifest of what successful entries of ``step`` have covered."""
    done = control.where((F.col("step_name") == step) & is_success(F.col("status")) & F.col("seen_modified_millis").isNotNull())
    covered = manifest(done, normal_path(F.col("input")), F.col("seen_modified_millis"))
    return covered.where(F.col("path").isNotNull())


def pending_records(records: DataFrame, control: DataFrame, step: str = "extract") -> DataFrame:
    """Newest revision of each record that no successful run has covered.

    ``records`` needs row_id, record_id, file_path and last_modified_timestamp_millis,
    ``control`` step_name, status, input and seen_modified_millis; any further
    columns are ignored. Every record comes once.

    The delivered manifest (all files, superseded revisions in its deletion
    vector) is compared with the processed one; the records inserted since are
    pending. Revisions that a newer one had already superseded when they were
    processed are of no interest, so the old vector holds nothing.
    """
    rows = content_rows(records)
    delivered = manifest(rows, F.col("path"), F.col("version"))
    gone = superseded(rows)
    inserted = record_delta(rows, processed_manifest(control, step), delivered, gone.limit(0), gone).where("change = 'insert'")
    # rows that were delivered twice with their position are one record
    return inserted.groupBy("record_id").agg(F.max("last_modified_timestamp_millis").alias("last_modified_timestamp_millis"))


def commit_pending(records: DataFrame, control: DataFrame, root: str | None = None, step: str = "extract") -> DataFrame:
    """The pending records as committed output; the commit holds the version they bring the reader to."""
    spark = records.sparkSession
    log = CommitLog(spark, root or scratch_path(spark, "pending"))
    version = records.agg(F.max("last_modified_timestamp_millis")).first()[0]
    log.publish(pending_records(records, control, step), version)
    return log.read()


class CommitLog:
    """Output commits that carry the processed version.

    ``publish`` writes the data to a fresh folder and then makes it visible by
    renaming a small commit file, which names the folder and the processed
    version, to the next number. The rename never overwrites: of two runs that
    claim the same number one fails. A crash before it leaves a folder that no
    reader sees and ``vacuum`` removes; a crash after it is a finished run.
    On object stores without an exclusive rename, ``root`` belongs on a file
    system that has one.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def commits(self) -> list[dict]:
        """All commits in order; the log is one small file per run."""
        log = self._path(f"{self.root}/_log")
        if not self._fs.exists(log):
            return []
        names = sorted(s.getPath().toString() for s in self._fs.listStatus(log))
        names = [n for n in names if n.endswith(".json")]
        rows = self.spark.read.text(names, wholetext=True).collect() if names else []
        return sorted((json.loads(r.value) for r in rows), key=lambda c: c["n"])

    def processed_version(self):
        done = self.commits()
        return done[-1]["version"] if done else None

    def write(self, df: DataFrame, n: int) -> str:
        """The data of a commit to be, in a folder that no reader sees yet."""
        data = f"{self.root}/data/{n:08d}-{uuid.uuid4().hex}"
        df.write.parquet(data)
        return data

    def claim(self, data: str, n: int, version) -> dict:
        """Make the folder ``data`` commit ``n``."""
        commit = {"n": n, "version": version, "data": os.path.basename(data), "status": "processed"}
        log = self._path(f"{self.root}/_log")
        self._fs.mkdirs(log)
        tmp = self._path(f"{self.root}/_log/.{n:08d}.{uuid.uuid4().hex}")
        out = self._fs.create(tmp, False)
        out.write(bytearray(json.dumps(commit).encode()))
        out.close()
        jvm, gateway = self.spark._jvm, self.spark.sparkContext._gateway
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self.spark._jsc.hadoopConfiguration())
        exclusive = gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        exclusive[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
        try:
            context.rename(tmp, self._fs.makeQualified(self._path(f"{self.root}/_log/{n:08d}.json")), exclusive)
        except Exception as e:
            self._fs.delete(tmp, False)
            raise RuntimeError(f"another run committed {n} first") from e
        return commit

    def publish(self, df: DataFrame, version) -> dict:
        n = len(self.commits())
        return self.claim(self.write(df, n), n, version)

    def vacuum(self, older_than_hours: float = 24.0) -> int:
        """Delete data folders of runs that died before their commit; returns how many."""
        data = self._path(f"{self.root}/data")
        if not self._fs.exists(data):
            return 0
        known = {c["data"] for c in self.commits()}
        limit = (time.time() - older_than_hours * 3600) * 1000
        dead = [s.getPath() for s in self._fs.listStatus(data) if s.getPath().getName() not in known and s.getModificationTime() <= limit]
        return sum(bool(self._fs.delete(p, True)) for p in dead)

    def read(self) -> DataFrame | None:
        """All committed output."""
        paths = [f"{self.root}/data/{c['data']}" for c in self.commits()]
        return self.spark.read.parquet(*paths) if paths else None
