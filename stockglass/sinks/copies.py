"""Copies of files, byte for byte.

A task copies one file at a time as a stream, so files of any size, encoding or line
end come out as they are. SHA-256 of what was read is compared with that of what is
then found in the copy. Copies are made beside their target and take its place when
all of them are right.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from stockglass.session import scratch_dir
from stockglass.sources.files import beside, opener, put_in_place, qualified
from stockglass.sources.landing import list_landing

REPORT = "source string, target string, bytes bigint, source_sha256 string, copy_sha256 string"
CHUNK = 8 << 20  # bytes of a file a task holds
FILES_A_TASK = 8  # small files that share a task, at most
TASKS = 2000  # at most


def _copier(chunk: int):
    # Defined here so that it travels with the task: workers need not have this package.
    opened = opener()

    def stream(path: str) -> Iterator[bytes]:
        system, plain = opened(path)
        with system.open_input_stream(plain) as file:
            while block := file.read(chunk):
                yield block

    def digest(path: str) -> str:
        found = hashlib.sha256()
        for block in stream(path):
            found.update(block)
        return found.hexdigest()

    def copy(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for source, target in zip(batch["source"], batch["target"]):
                system, plain = opened(target)
                system.create_dir(plain.rsplit("/", 1)[0], recursive=True)
                # A second attempt of the task writes a file of its own.
                part = f"{plain.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}"
                read, size = hashlib.sha256(), 0
                with system.open_output_stream(part) as out:
                    for block in stream(source):
                        read.update(block)
                        size += out.write(block)
                system.move(part, plain)
                rows.append((source, target, size, read.hexdigest(), digest(target)))
            yield pd.DataFrame(rows, columns=["source", "target", "bytes", "source_sha256", "copy_sha256"])

    return copy


def copy_files(spark: SparkSession, targets: dict[str, str]) -> DataFrame:
    """Copies files or folders; ``targets``: where each copy goes -> what it is a copy of.

    Returns one row per file. What lay at a target is replaced, but not before all
    copies have been made and compared; if one differs, nothing is replaced. Hidden
    files of a folder (``_SUCCESS``) are not copied. A source without a file is an error.
    """
    staged, parts = {}, []
    for target, source in targets.items():
        source, target = qualified(spark, source), qualified(spark, target)
        staged[target] = beside(target)
        files = list_landing(spark, source)
        if files.isEmpty():
            raise FileNotFoundError(source)
        inside = F.substring("path", len(source) + 1, 1 << 30)
        parts.append(files.select(F.col("path").alias("source"), F.concat(F.lit(staged[target]), inside).alias("target")))
    files = parts[0]
    for part in parts[1:]:
        files = files.unionAll(part)
    listed = scratch_dir(spark, "copy-list")
    files.write.parquet(listed)
    files = spark.read.schema("source string, target string").parquet(listed)
    tasks = min(TASKS, max(1, files.count() // FILES_A_TASK, spark.sparkContext.defaultParallelism))
    report = scratch_dir(spark, "copy-report")
    files.repartition(tasks).mapInPandas(_copier(CHUNK), REPORT).write.parquet(report)
    copied = spark.read.schema(REPORT).parquet(report)
    wrong = copied.where("source_sha256 <> copy_sha256").select("source").limit(10).collect()
    if wrong:
        raise OSError(f"copies differ from {', '.join(r.source for r in wrong)}")
    places = F.col("target")
    for target, stage in staged.items():
        put_in_place(spark, stage, target)
        places = F.when(F.startswith(places, F.lit(stage)), F.concat(F.lit(target), F.substring(places, len(stage) + 1, 1 << 30))).otherwise(places)
    return copied.withColumn("target", places)
