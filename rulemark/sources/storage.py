"""Shared folder for intermediate tables, and the file system behind a path."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from rulemark.errors import SettingsError


#: Folders of local sessions, by application.
_LOCAL_FOLDERS: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Where it is unset, only a local session gets a folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise SettingsError("set spark.checkpoint.dir to a folder all executors share")
    application = spark.sparkContext.applicationId
    if application not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[application] = tempfile.mkdtemp(prefix="rulemark-")
    return _LOCAL_FOLDERS[application]


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A path in the shared folder that nobody else uses."""
    return f"{shared_folder(spark).rstrip('/')}/rulemark/{purpose}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, purpose: str = "table") -> tuple[DataFrame, str]:
    """Write ``df`` once and read it back, so that later jobs do not repeat it."""
    path = new_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def detached(df: DataFrame) -> DataFrame:
    """The same rows, independent of the files they came from; Spark cleans the copy up."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def _located(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    system, target = _located(spark, path)
    return system.exists(target)


def any_path(spark: SparkSession, pattern: str) -> bool:
    """Does any file or folder fit the pattern?"""
    system, target = _located(spark, pattern)
    return bool(system.globStatus(target))


def delete_folder(spark: SparkSession, path: str) -> None:
    system, target = _located(spark, path)
    system.delete(target, True)


def file_names(spark: SparkSession, folder: str) -> list[str]:
    """Names of what lies in a folder; none if there is no folder."""
    system, target = _located(spark, folder)
    return [s.getPath().getName() for s in system.listStatus(target)] if system.exists(target) else []


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that appears under its name only when it is whole."""
    system, target = _located(spark, path)
    _, draft = _located(spark, f"{path}.{uuid.uuid4().hex}.draft")
    stream = system.create(draft, True)
    stream.write(text.encode())
    stream.close()
    system.delete(target, False)
    if not system.rename(draft, target):
        raise OSError(f"cannot write {path}")


def read_text(spark: SparkSession, path: str) -> str:
    return spark.read.text(path, wholetext=True).first()[0]
