"""Where intermediate tables go, and how lineage is cut."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    That is `spark.checkpoint.dir`, or the folder given to `SparkContext.setCheckpointDir`. Only a local
    session may do without: it gets a temporary folder. A cluster without a shared folder is refused, as its
    executors would write to their own disks.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base:
        return base.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return tempfile.mkdtemp(prefix="gapweave-")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/gapweave/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write `df` to the shared folder and read it back, so later stages never recompute it."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_scratch(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder that nothing reads any more."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def rename(spark: SparkSession, path: str, name: str) -> None:
    source = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = source.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.rename(source, spark._jvm.org.apache.hadoop.fs.Path(name)):
        raise OSError(f"Cannot rename {path} to {name}")


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers, as `spark-submit --py-files` would."""
    context = spark.sparkContext
    if getattr(context, "_gapweave_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    staged = os.path.join(tempfile.mkdtemp(prefix="gapweave-"), "gapweave")
    context.addPyFile(shutil.make_archive(staged, "zip", root, "gapweave"))
    context._gapweave_shipped = True
