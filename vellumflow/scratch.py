"""Tables between the steps of a query, in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Only where all run on one machine (a local master)
    and it is unset, a temporary folder takes its place; on a cluster that would be a folder of each executor's own."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="vellumflow-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def _file(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def fresh_folder(spark: SparkSession) -> str:
    """A folder of its own under the shared one, that goes when the application ends."""
    path = f"{shared_dir(spark)}/vellumflow/{uuid.uuid4().hex}"
    at, system = _file(spark, path)
    system.mkdirs(at)
    system.deleteOnExit(at)
    return path


def save(df: DataFrame, name: str) -> DataFrame:
    """Cuts the lineage: writes ``df`` as a table in the shared folder and reads it back. The table goes with discard(),
    or when the application ends."""
    spark = df.sparkSession
    path = fresh_folder(spark)
    df.write.parquet(f"{path}/{name}")
    out = spark.read.schema(df.schema).parquet(f"{path}/{name}")
    out._saved_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes tables that save() wrote, once all that was made of them is saved too."""
    for df in tables:
        at, system = _file(df.sparkSession, df._saved_at)
        system.delete(at, True)
        system.cancelDeleteOnExit(at)
