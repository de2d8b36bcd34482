"""Where intermediate data goes so that it outlives a lost executor."""

from __future__ import annotations

import atexit
import hashlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """Shared folder named by ``spark.checkpoint.dir``; a temp folder only in local mode."""
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured
    current = sc.getCheckpointDir()
    if current is not None:
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="storelens-"))
    return sc.getCheckpointDir()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder; nothing happens if it is gone or the session has ended."""
    if spark.sparkContext._jsc is None or spark.sparkContext._jsc.sc().isStopped():
        return
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def scratch_path(spark: SparkSession, kind: str) -> str:
    """A new path in the shared folder for intermediate output; it is removed when the driver ends."""
    path = f"{shared_dir(spark)}/{kind}-{spark.sparkContext.applicationId}-{uuid.uuid4().hex}"
    atexit.register(remove, spark, path)
    return path


def stored(df: DataFrame, kind: str = "rows") -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back: later reads prune columns, see the same rows, and outlive executors."""
    spark = df.sparkSession
    path = scratch_path(spark, kind)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def files_fingerprint(spark: SparkSession, directory: str) -> str:
    """Changes when a file under ``directory`` is added, removed, resized or rewritten."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(directory)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(path, True)
    files = []
    while found.hasNext():
        f = found.next()
        files.append(f"{f.getPath()} {f.getLen()} {f.getModificationTime()}")
    return hashlib.md5("\n".join(sorted(files)).encode()).hexdigest()[:16]


def materialize(df: DataFrame) -> DataFrame:
    """Compute a reduced table once into the shared folder, for plans that read it several times."""
    shared_dir(df.sparkSession)
    return df.checkpoint()
