"""Where intermediate tables are written so that a lost executor never costs more than one step."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_dir(spark: SparkSession) -> str:
    """A fresh directory in the shared folder named by `spark.checkpoint.dir`; it goes when the driver ends.

    Only a local session may do without the setting and gets a temporary folder: executors on other machines
    could not read it. Whether the folder that a cluster names is shared is the cluster's word.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        path = f"{shared.rstrip('/')}/vendaria-{uuid.uuid4().hex}"
        files, directory = _file_system(spark, path)
        files.mkdirs(directory)
        files.deleteOnExit(directory)  # results may read it lazily, so not before
        return path
    if spark.conf.get("spark.master", "").startswith("local"):
        path = tempfile.mkdtemp(prefix="vendaria-")
        atexit.register(shutil.rmtree, path, ignore_errors=True)
        return path
    raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a job has written `path` to its end."""
    files, _ = _file_system(spark, path)
    return files.exists(_path(spark, f"{path}/_SUCCESS"))


def discard(spark: SparkSession, path: str) -> None:
    files, directory = _file_system(spark, path)
    files.delete(directory, True)


def directories(spark: SparkSession, path: str) -> list[tuple[str, str]]:
    """(name, path) of the partition folders in `path`; none if it does not exist."""
    files, directory = _file_system(spark, path)
    if not files.exists(directory):
        return []
    found = [s.getPath() for s in files.listStatus(directory) if s.isDirectory()]
    return sorted((p.getName(), p.toString()) for p in found if "=" in p.getName())


def make_folder(spark: SparkSession, path: str) -> None:
    files, directory = _file_system(spark, path)
    files.mkdirs(directory)


def is_folder(spark: SparkSession, path: str) -> bool:
    files, directory = _file_system(spark, path)
    return files.exists(directory)


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _file_system(spark: SparkSession, path: str):
    directory = _path(spark, path)
    return directory.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), directory


def materialize(df: DataFrame, path: str) -> DataFrame:
    """Write `df` once and continue from the files: short lineage, known size, columnar re-reads."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
