"""Control data: restart, fileset guard and status as joins of file tables.

Defined cases: null paths never match; repeated entries count once; an entry
whose status isn't a success doesn't cover its input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from docloom.operators.delta import is_success


def pending_inputs(inputs: DataFrame, outputs: DataFrame, path: str = "path") -> DataFrame:
    """Inputs that no earlier output of the step covers (restart)."""
    done = outputs.where(is_success(F.col("status"))).select(F.col("input").alias("d_input")).where("d_input is not null").distinct()
    return inputs.join(done, F.col(path) == F.col("d_input"), "left_anti")


def carried_outputs(inputs: DataFrame, outputs: DataFrame, path: str = "path") -> DataFrame:
    """Earlier outputs of inputs that are skipped."""
    wanted = inputs.select(F.col(path).alias("w_path")).where("w_path is not null").distinct()
    return outputs.where(is_success(F.col("status"))).join(wanted, F.col("input") == F.col("w_path"), "left_semi")


def fileset_difference(a: DataFrame, b: DataFrame, path: str = "path") -> DataFrame:
    """path and side of the files in only one of two filesets."""
    x = a.select(F.col(path).alias("path")).distinct().withColumn("side", F.lit("left"))
    y = b.select(F.col(path).alias("path")).distinct().withColumn("side", F.lit("right"))
    return x.unionByName(y).groupBy("path").agg(F.count(F.lit(1)).alias("n"), F.min("side").alias("side")).where("n = 1").drop("n")


def file_status(files: DataFrame, outputs: DataFrame, path: str = "path") -> DataFrame:
    """Status and time of each file from its latest output, else its own."""
    last = outputs.where("input is not null").groupBy(F.col("input").alias("o_input")).agg(
        F.max(F.struct(F.col("time").alias("t"), F.col("status").alias("s"))).alias("o")
    )
    j = files.join(last, F.col(path) == F.col("o_input"), "left")
    return j.select(
        path, F.coalesce(F.col("o.s"), F.col("status")).alias("status"), F.coalesce(F.col("o.t"), F.col("time")).alias("time")
    )


def output_entries(outputs: DataFrame, step: str, status: str = "processed") -> DataFrame:
    """Step-output entries (filename, input, path, status, time, step) of written
    documents: ``outputs`` has input and path."""
    return outputs.select(
        F.regexp_extract("path", r"([^/]+)$", 1).alias("filename"), "input", "path", F.lit(status).alias("status"),
        F.current_timestamp().alias("time"), F.lit(step).alias("step"),
    )


def append_entries(entries: DataFrame, path: str) -> None:
    """Append to the table of step outputs, partitioned by step (progress of a run)."""
    entries.write.mode("append").partitionBy("step").parquet(path)


def normalised(jobs: DataFrame) -> dict[str, DataFrame]:
    """Control documents as the tables jobs and step outputs."""
    flat = jobs.select("job_id", F.explode("files_output").alias("f")).select("job_id", "f.filename", "f.input", "f.path", "f.status")
    return {"jobs": jobs.drop("files_output"), "step_outputs": flat}
