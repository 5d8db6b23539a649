"""Files and folders by the paths Spark knows them by: opened in tasks, put in place."""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrameWriter, SparkSession


def qualified(spark: SparkSession, path: str) -> str:
    """The path in full, with its file system, as Spark takes it."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    return system.makeQualified(hadoop).toString().rstrip("/")


def beside(target: str, mark: str = "staged") -> str:
    """A new path in the folder of ``target`` that readers of that folder don't see."""
    folder, name = posixpath.split(target.rstrip("/"))
    return f"{folder}/.{mark}-{uuid.uuid4().hex}-{name}"


def put_in_place(spark: SparkSession, staged: str, target: str) -> None:
    """Moves ``staged`` to ``target``. What lay there is moved aside first, and back again
    if the move fails, then deleted. No data is read or written, only names change."""
    make = spark._jvm.org.apache.hadoop.fs.Path
    system = make(target).getFileSystem(spark._jsc.hadoopConfiguration())
    old = beside(target, "old")
    system.mkdirs(make(target).getParent())
    replaces = system.exists(make(target))
    if replaces and not system.rename(make(target), make(old)):
        raise OSError(f"could not move {target} aside")
    if not system.rename(make(staged), make(target)):
        if replaces:
            system.rename(make(old), make(target))
        raise OSError(f"could not move {staged} to {target}")
    if replaces:
        system.delete(make(old), True)


def write_snapshot(spark: SparkSession, writer: DataFrameWriter, target: str) -> None:
    """Writes Parquet beside ``target`` and puts it in place when it is whole: a write that
    fails leaves what was there, and readers see the old snapshot or the new one."""
    staged = beside(target)
    try:
        writer.mode("errorifexists").parquet(staged)
    except Exception:
        make = spark._jvm.org.apache.hadoop.fs.Path
        make(staged).getFileSystem(spark._jsc.hadoopConfiguration()).delete(make(staged), True)
        raise
    put_in_place(spark, staged, target)


def opener() -> Callable:
    """A function from a path to its file system and the path there. It travels with the
    task, as workers need not have this package."""

    def opened(path: str):
        from urllib.parse import urlsplit

        from pyarrow import fs

        parts = urlsplit(path, allow_fragments=False)
        if parts.scheme in ("", "file"):
            return fs.LocalFileSystem(), path.removeprefix("file:").replace("///", "/", 1)
        scheme = "s3" if parts.scheme in ("s3a", "s3n") else parts.scheme
        system, _ = fs.FileSystem.from_uri(f"{scheme}://{parts.netloc}/")
        plain = path.split("://", 1)[1]
        return system, plain if scheme in ("s3", "gs") else "/" + plain.split("/", 1)[1]

    return opened
