"""Intermediate results kept as Parquet in the folder that all executors share.

A written table cuts the lineage, survives lost executors, and gives the planner the real size
of a reduced result, so that joins against it are broadcast only when they fit.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_folder: str | None = None
_scopes: list[list[str]] = []


def shared_folder(spark: SparkSession) -> str:
    """`spark.checkpoint.dir` of the session. Where it is unset a private folder is used, but
    only on a local master: on a cluster a machine's own folder would be lost with it."""
    global _local_folder
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if _local_folder is None:
        _local_folder = tempfile.mkdtemp(prefix="gondola-")
    return _local_folder


def new_path(spark: SparkSession, name: str, kept: bool = False) -> str:
    """`kept`: the table outlives the innermost `intermediate`."""
    path = f"{shared_folder(spark)}/gondola/{name}-{uuid.uuid4().hex}"
    scopes = _scopes[:-1] if kept else _scopes
    if scopes:
        scopes[-1].append(path)
    return path


@contextmanager
def intermediate(spark: SparkSession) -> Iterator[None]:
    """Tables written within are removed at the end, also after a failure. For jobs whose
    result does not read them any more."""
    _scopes.append([])
    try:
        yield
    finally:
        for name in _scopes.pop():
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


# Shuffle files go when the job that made them ends, not when the driver happens to collect its
# garbage; tables are packed more densely than by default.
SPARING = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
}


@contextmanager
def spare_disk(spark: SparkSession) -> Iterator[None]:
    """For jobs that write one table after the other: each holds no more disk than its own."""
    before = {key: spark.conf.get(key, None) for key in SPARING}
    for key, value in SPARING.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def materialize(df: DataFrame, name: str, kept: bool = False) -> DataFrame:
    """Write the frame and return it read back (an action)."""
    spark = df.sparkSession
    path = new_path(spark, name, kept)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
