"""Steps chained over DataFrames, with control data and restart.

With ``root`` every step's output is written to ``{root}/{step}/run=…`` and its
inputs are entered in the control table ``{root}/_control`` once the output is
there. A later run skips what a step has entered as processed and hands the next
step the carried and the new outputs alike. A run that dies between output and
entries leaves a folder that no entry names: it is not read, and the step does its
inputs again. Without ``root`` steps are only chained.

``path`` names the column that holds a row's input. Defined cases: rows without
path are processed in every run and never carried; an input that is entered as
failed is processed again; errors that aren't ``Exception`` always propagate.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from docloom.operators.control import output_entries, pending_inputs

Step = Callable[[DataFrame], DataFrame]
ENTRIES = "filename string, input string, path string, status string, time timestamp, job string, step string"


@dataclass
class Parallel:
    """Steps over one parent. A step reads the output of the one before it in this group
    unless ``source`` names another; the first, and those whose ``source`` is "parent",
    start from the group's input. Chains that start there run at the same time."""

    steps: list[tuple[str, Step, str | None]] = field(default_factory=list)

    def add_step(self, name: str, step: Step, source: str | None = None) -> Parallel:
        self.steps.append((name, step, source))
        return self

    def chains(self) -> list[list[tuple[str, Step, str | None]]]:
        out: list[list] = []
        for name, step, source in self.steps:
            if not out or source == "parent":
                out.append([(name, step, "parent")])
            else:
                own = next((c for c in out if any(n == source for n, *_ in c)), out[-1])
                own.append((name, step, source or own[-1][0]))
        return out


@dataclass
class Pipeline:
    """A list of named steps. Each step's input is the output of the step before
    it unless ``source`` names another.

    ``on_error``: "raise" (default) or "record", which notes the error in the
    control data and stops.
    """

    steps: list[tuple[str, Step | Parallel, str | None]] = field(default_factory=list)
    on_error: str = "raise"
    root: str | None = None
    path: str = "path"
    log: list[dict] = field(default_factory=list)

    def add_step(self, name: str, step: Step | Parallel, source: str | None = None) -> Pipeline:
        self.steps.append((name, step, source))
        return self

    def add_steps(self, *steps: tuple[str, Step | Parallel]) -> Pipeline:
        for name, step in steps:
            self.add_step(name, step)
        return self

    # control data ---------------------------------------------------------------------------

    def entries(self, spark: SparkSession) -> DataFrame:
        """Everything that runs have entered so far."""
        place = f"{self.root}/_control"
        where = spark._jvm.org.apache.hadoop.fs.Path(place)
        if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
            return spark.createDataFrame([], ENTRIES)
        return spark.read.schema(ENTRIES).option("recursiveFileLookup", "true").parquet(place)

    def _job(self, spark: SparkSession, job: dict) -> None:
        """The job's part of the control data: a small file, replaced as the job goes on."""
        where = spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/_jobs/{job['job']}.json")
        out = where.getFileSystem(spark._jsc.hadoopConfiguration()).create(where, True)
        out.write(bytearray(json.dumps(job).encode()))
        out.close()

    def jobs(self, spark: SparkSession) -> list[dict]:
        """job, status (running, processed, error), steps, start, end, message of every run."""
        where = spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/_jobs")
        if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
            return []
        return sorted((json.loads(r.value) for r in spark.read.text(f"{self.root}/_jobs/*.json", wholetext=True).collect()), key=lambda j: j["start"])

    def _stored(self, job: str, name: str, step: Step, current: DataFrame) -> DataFrame:
        """Run a step on what it hasn't done, write, enter, and read all of its outputs."""
        spark = current.sparkSession
        done = self.entries(spark).where(F.col("step") == name)
        todo = pending_inputs(current, done, self.path)
        folder = f"{self.root}/{name}/run={uuid.uuid4().hex}"
        step(todo).write.parquet(folder)
        inputs = todo.select(F.col(self.path).alias("input"), F.lit(folder).alias("path")).where("input is not null").distinct()
        entries = output_entries(inputs, name).withColumn("job", F.lit(job))
        # one file: all entries of a run appear at once, and chains that run side by side don't share a folder
        entries.coalesce(1).write.parquet(f"{self.root}/_control/run={uuid.uuid4().hex}")
        ok = self.entries(spark).where((F.col("step") == name) & (F.col("status") == "processed"))
        named = {r.path for r in ok.select("path").distinct().collect()} | {folder}  # one folder a run
        return spark.read.option("mergeSchema", "true").parquet(*sorted(named))

    # running ----------------------------------------------------------------------------------

    def _one(self, job: str, name: str, step: Step, current: DataFrame, sink) -> DataFrame:
        began = time.time()
        entry = {"step": name, "status": "processed", "message": None}
        try:
            out = self._stored(job, name, step, current) if self.root else step(current)
            if sink:
                sink(name, out)
            if not self.root and not sink:
                entry["status"] = "planned"  # nothing has run yet
            return out
        except BaseException as e:
            entry |= {"status": "error", "message": str(e)[:500]}
            raise
        finally:
            self.log.append(entry | {"seconds": time.time() - began})

    def run(self, source: DataFrame | None = None, sink: Callable[[str, DataFrame], None] | None = None) -> dict[str, DataFrame]:
        """Outputs by step name; ``sink`` is called with each one as it is made."""
        job = {"job": uuid.uuid4().hex, "status": "running", "steps": [], "start": time.time(), "end": None, "message": None}
        spark = source.sparkSession if source is not None else SparkSession.active()
        out: dict[str, DataFrame] = {}
        current = source
        try:
            for name, step, wanted in self.steps:
                job["steps"].append(name)
                if self.root:
                    self._job(spark, job)
                current = out[wanted] if wanted else current
                if not isinstance(step, Parallel):
                    out[name] = current = self._one(job["job"], name, step, current, sink)
                    continue

                def chain(steps: list, parent: DataFrame = current) -> None:
                    for n, s, w in steps:
                        out[n] = self._one(job["job"], n, s, parent if w == "parent" else out[w], sink)

                chains = step.chains()
                with ThreadPoolExecutor(max(len(chains), 1)) as pool:
                    for f in [pool.submit(chain, c) for c in chains]:
                        f.result()
                if step.steps:
                    out[name] = current = out[step.steps[-1][0]]
            job["status"] = "processed"
        except Exception as e:
            job |= {"status": "error", "message": repr(e)[:500]}
            if self.on_error == "raise":
                raise
        except BaseException as e:
            job |= {"status": "error", "message": repr(e)[:500]}
            raise
        finally:
            job["end"] = time.time()
            if self.root:
                self._job(spark, job)
        return out
