"""Products that change as a whole: a run writes its own folders, and a manifest that names its files makes it the product.

A run that fails leaves files that no manifest names, and the product before it stays. Files follow bytes: rows are
ranged over as many tasks as their size asks for, and a commune's rows lie together.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deslinde.session import cut

MANIFESTS = "_manifests"


def ranged(df: DataFrame, columns: Sequence[str], bytes_per_file: int = 256 << 20, bytes_per_row: int = 200) -> DataFrame:
    """Rows ranged by ``columns`` over tasks of about ``bytes_per_file``, so that a folder gets files by its size and not by the tasks before."""
    tasks = max(1, -(-df.count() * bytes_per_row // bytes_per_file))
    return df.repartitionByRange(tasks, *columns).sortWithinPartitions(*columns)


def _listing(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length")


def publish(spark: SparkSession, outputs: dict[str, DataFrame], folder: str, order: dict[str, Sequence[str]], run: str | None = None) -> str:
    """Write every output as Parquet by commune under a new run, then its manifest: (output, path, length) of each file.

    ``order`` gives the columns that rows of an output are ranged by, the commune first. Returns the run's name; later
    runs have later names.
    """
    run = run or f"{len(_runs(spark, folder)):08d}-{uuid.uuid4().hex[:8]}"
    files = None
    for name, rows in outputs.items():
        path = f"{folder}/runs/{run}/{name}"
        ranged(cut(rows), order[name]).write.mode("overwrite").partitionBy("comuna").parquet(path)
        own = _listing(spark, path).where("path like '%.parquet'").select(F.lit(name).alias("output"), "path", "length")
        files = own if files is None else files.unionByName(own)
    line = F.to_json(F.struct("output", "path", "length")).alias("value")
    # one file, written under its own name only when it is whole
    files.select(line).coalesce(1).write.mode("overwrite").text(f"{folder}/{MANIFESTS}/{run}")
    return run


def _runs(spark: SparkSession, folder: str) -> list[str]:
    """Runs with a finished manifest, in order."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{MANIFESTS}")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    done = [s.getPath() for s in fs.listStatus(path)]
    return sorted(p.getName() for p in done if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))


def manifest(spark: SparkSession, folder: str, run: str | None = None) -> DataFrame:
    """(output, path, length) of the files of a run, by default the last that was finished."""
    runs = _runs(spark, folder)
    if not runs:
        return spark.createDataFrame([], "output string, path string, length bigint")
    text = spark.read.text(f"{folder}/{MANIFESTS}/{run or runs[-1]}")
    return text.select(F.from_json("value", "output string, path string, length bigint").alias("f")).select("f.*")


def read_published(spark: SparkSession, folder: str, output: str, run: str | None = None) -> DataFrame:
    """An output as the last finished run (or ``run``) has it."""
    runs = _runs(spark, folder)
    if not runs:
        raise ValueError(f"nothing is published in {folder}")
    return spark.read.option("basePath", f"{folder}/runs/{run or runs[-1]}/{output}").parquet(f"{folder}/runs/{run or runs[-1]}/{output}")


def retire(spark: SparkSession, folder: str, keep: int = 2) -> list[str]:
    """Remove all but the last ``keep`` finished runs, and what unfinished ones left; returns the names removed."""
    kept = set(_runs(spark, folder)[-keep:])
    hadoop = spark._jvm.org.apache.hadoop.fs
    fs = hadoop.Path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    gone = set()
    for part in ("runs", MANIFESTS):
        path = hadoop.Path(f"{folder}/{part}")
        for status in fs.listStatus(path) if fs.exists(path) else []:
            name = status.getPath().getName()
            if name not in kept:
                fs.delete(status.getPath(), True)
                gone.add(name)
    return sorted(gone)
