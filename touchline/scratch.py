"""Shared scratch folder for results that a later step must read back unchanged.

The folder is the one the cluster names in ``spark.checkpoint.dir``.  Only a local-mode
session without that setting (tests, laptops) gets a folder of its own.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
_local_roots: dict[str, str] = {}


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder path below the shared scratch folder; not created yet."""
    return f"{_root(spark)}/{label}-{uuid.uuid4().hex}"


def _root(spark: SparkSession) -> str:
    app = spark.conf.get("spark.app.id")
    shared = spark.conf.get(SETTING, None)
    if shared:
        return f"{shared.rstrip('/')}/touchline-{app}"
    if not spark.conf.get("spark.master", "local").startswith("local"):
        raise RuntimeError(f"{SETTING} must name a folder that all executors share")
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="touchline-")
    return _local_roots[app]


def spill(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as parquet in the scratch folder and read it back.

    Cuts lineage, survives lost executors, keeps column pruning for later readers and
    gives the planner true sizes (so broadcasts stay size-checked).
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dealt(df: DataFrame, label: str, *by: str, rows: int = 100_000) -> DataFrame:
    """``df`` spilled, then dealt by hash of ``by`` to slices of about ``rows`` rows.

    The number of slices follows the rows and not the session's shuffle partitions, so that
    later steps on ``by``, which need no further exchange, hold as much in a task at any size.
    """
    kept = spill(df, label)
    slices = max(1, -(-kept.count() // rows))
    return kept.repartition(slices, *by)


def drop_scratch(spark: SparkSession) -> bool:
    """Delete what this application spilled; call it once the results are written."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_root(spark))
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return files.delete(path, True)
