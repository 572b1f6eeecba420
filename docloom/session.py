"""Session helpers: shared scratch space and table loading."""

from __future__ import annotations

import io
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """Folder that driver and executors share, from ``spark.checkpoint.dir``.

    Only where the setting is absent in local mode (tests, a laptop) a local folder
    is made and set as the checkpoint folder of this session. On a cluster that
    folder would not be shared: there the setting is required.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    jdir = spark.sparkContext._jsc.sc().getCheckpointDir()
    if jdir.isDefined():
        return jdir.get().rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
    local = tempfile.mkdtemp(prefix="docloom-")
    spark.sparkContext.setCheckpointDir(f"file://{local}")
    return f"file://{local}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def delete_at_exit(spark: SparkSession, uri: str) -> None:
    """Let the driver's JVM delete an existing scratch path when it ends."""
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage like ``checkpoint()`` but keeps a columnar file, so later
    scans prune columns. Survives the loss of executors.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    delete_at_exit(spark, path)
    return spark.read.parquet(path)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the package to the Python workers, once per application.

    Needed where executors don't find it by themselves (no installation, other
    working folder). The archive lies in the shared folder.
    """
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    _shipped.add(app)
    root = Path(__file__).parent
    archive = io.BytesIO()
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    uri = f"{scratch_path(spark, 'package')}.zip"
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path, False)
    out.write(bytearray(archive.getvalue()))
    out.close()
    delete_at_exit(spark, uri)
    spark.sparkContext.addPyFile(uri)


# operators that leave rows where they are (names of the optimiser's plan nodes)
_NARROW = set("Project Filter LogicalRelation LogicalRDD LocalRelation Range Generate Union MapInArrow MapInPandas ArrowEvalPython".split())


def _only_scans(plan) -> bool:
    """Whether a plan has no operator that moves rows between tasks."""
    todo = [plan]
    while todo:
        p = todo.pop()
        name = p.nodeName()
        if name == "Repartition" and p.shuffle() or name not in _NARROW | {"Repartition"} and not name.startswith("Relation"):
            return False
        children = p.children()
        todo.extend(children.apply(i) for i in range(children.size()))
    return True


def spread(df: DataFrame) -> DataFrame:
    """``df`` over at least as many partitions as there are cores.

    Only a small input (a single file, say) has fewer; it is spread before
    costly work. Larger inputs are left as they are, without a shuffle.
    """
    if not _only_scans(df._jdf.queryExecution().optimizedPlan()):
        return df  # it has been partitioned, and asking for the number would run its stages
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
