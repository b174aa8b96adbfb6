"""Session defaults and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Joins against a unique-key side are left to AQE, which measures every
# shuffle partition and splits the hot ones; forcing it lets the split happen
# even where a later aggregate would have liked to reuse the partitioning.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # rows here are heavy (polygons tested edge by edge), so small shuffles stay spread
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    "spark.sql.session.timeZone": "UTC",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators count on."""
    for key, value in DEFAULTS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    _ship_package(spark)
    return spark


def _ship_package(spark: SparkSession) -> None:
    """Hand the package to the Python workers, once per context; the Arrow steps import it."""
    sc = spark.sparkContext
    if getattr(sc, "_deslinde_shipped", False):
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="spark-deslinde-", dir="/tmp")) / "deslinde.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(archive))
    sc._deslinde_shipped = True


def _checkpoint_dir(spark: SparkSession) -> str:
    """The folder the session names; a private one only in local mode."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        named = tempfile.mkdtemp(prefix="spark-deslinde-", dir="/tmp")
    sc.setCheckpointDir(named)
    return named


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from there.

    Used where one result feeds several branches or an iteration: the branches
    read the written rows, so a lost executor costs a re-read and not a re-run,
    and both branches are sure to see the same rows.
    """
    _checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def large(side: DataFrame) -> DataFrame:
    """A side of a join that grows with the layer. Spark takes its size from the compressed input and would broadcast it through the driver."""
    return side.hint("merge")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder for intermediate tables, beside the checkpoints, where every executor reaches it."""
    return f"{_checkpoint_dir(spark)}/scratch/{uuid.uuid4().hex}/{name}"


def spread(df: DataFrame) -> DataFrame:
    """Share a table of few files over the cores, for steps that are heavy per row.

    A table with at least as many files as cores is left alone.
    """
    n = df.sparkSession.sparkContext.defaultParallelism
    return df if len(df.inputFiles()) >= n else df.repartition(n)
