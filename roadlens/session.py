"""Session helpers: session construction, table reading and shared scratch tables."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def get_spark(cpus: int = 8, partitions: int | None = None, app: str = "roadlens") -> SparkSession:
    """A local session with the settings the engine is tested with."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions or cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    ship(spark)
    return spark


def ship(spark: SparkSession) -> None:
    """Sends this package to the workers, once a context, unless their path holds it already."""
    sc, root = spark.sparkContext, Path(__file__).resolve().parent.parent
    known = [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)]
    if getattr(sc, "_roadlens_shipped", False) or any(p and os.path.realpath(p) == str(root) for p in known):
        return
    target = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="roadlens-")), "roadlens.zip")
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted((root / "roadlens").rglob("*.py")):
            z.write(f, f.relative_to(root))
    sc.addPyFile(target)
    sc._roadlens_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``. Where that is unset a local session gets a temporary one; a cluster must set it."""
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not path:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        sc.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="roadlens-"))
        path = sc.getCheckpointDir()
    return path.rstrip("/")


def _file(spark: SparkSession, path: str):
    """(the store that holds a path, the path) on the JVM."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def materialize(df: DataFrame, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` to a Parquet table in the shared folder and read it back.

    Cuts lineage in a way that survives lost executors; unlike a cached table it
    needs no executor memory and is read with column pruning and pushed filters. The
    tables of an application are deleted when its driver ends, or by ``discard`` before.
    """
    spark = df.sparkSession
    ship(spark)
    sc = spark.sparkContext
    folder = f"{scratch_dir(spark)}/roadlens/{sc.applicationId}"
    if getattr(sc, "_roadlens_scratch", None) != folder:
        store, where = _file(spark, folder)
        store.mkdirs(where)
        store.deleteOnExit(where)
        sc._roadlens_scratch = folder
    path = f"{folder}/{uuid.uuid4().hex}"
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._roadlens_path = path
    return out


def shuffled(df: DataFrame) -> DataFrame:
    """``df``, a side of a join that grows with the input: the join shuffles both sides, whatever Spark takes their sizes for.

    A scratch table is sized by its compressed files, several times less than its rows in
    memory; a plan of several such joins broadcasts all of them through the driver at once.
    """
    return df.hint("merge")


def discard(*tables: DataFrame) -> None:
    """Deletes tables that ``materialize`` wrote, once nothing reads them any more; others are left alone."""
    for t in tables:
        if path := getattr(t, "_roadlens_path", None):
            store, where = _file(t.sparkSession, path)
            store.delete(where, True)
