"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; a temporary folder only for a local master without one."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return sc.getCheckpointDir().rstrip("/")
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    path = tempfile.mkdtemp(prefix="sievework-")
    sc.setCheckpointDir(path)
    return path


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet under the shared folder and return the written table.

    This cuts the lineage as checkpoint() does, survives lost executors, and is columnar and compressed.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/sievework/{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")  # shuffle files are of no use once the table is written
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, *frames: DataFrame) -> None:
    """Delete tables of materialise() that nothing reads any more."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for df in frames:
        for file in df.inputFiles()[:1]:
            path = jvm.org.apache.hadoop.fs.Path(file).getParent()
            if "/sievework/" in path.toString():
                path.getFileSystem(conf).delete(path, True)
