"""The clean table, the quality log and the exports."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F


def _write_days(df: DataFrame, path: str) -> None:
    """Replace the days present in `df` and leave the others. Rows are rebalanced by day, so
    that a large day is written by several tasks and a small one by one."""
    (
        df.hint("rebalance", "fecha")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy("fecha")
        .parquet(path)
    )


def stored_days(spark: SparkSession, path: str) -> DataFrame | None:
    """The days a table holds, told by its folders without opening a file; None if there is no
    table yet."""
    try:
        files = (
            spark.read.format("binaryFile")
            .option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
            .load(path)
        )
    except AnalysisException:
        return None
    day = F.regexp_extract("path", r"/fecha=(\d{4}-\d{2}-\d{2})/", 1)
    return files.select(F.try_to_date(F.nullif(day, F.lit(""))).alias("fecha")).distinct()


def pending(df: DataFrame, path: str, force: bool = False) -> DataFrame:
    """Rows of days that the table at `path` does not hold yet; all rows when forced."""
    days = None if force else stored_days(df.sparkSession, path)
    return df if days is None else df.join(days, "fecha", "left_anti")


def write_clean(df: DataFrame, path: str) -> None:
    _write_days(df, path)


def read_clean(spark: SparkSession, path: str, first=None, last=None) -> DataFrame:
    """The clean table, or the days from `first` to `last`: only their partitions are read."""
    df = spark.read.parquet(path)
    if first is not None:
        df = df.where(F.col("fecha") >= F.lit(str(first)).cast("date"))
    if last is not None:
        df = df.where(F.col("fecha") <= F.lit(str(last)).cast("date"))
    return df


def upsert_quality(metrics: DataFrame, path: str) -> None:
    """Replace the days present in `metrics` in the quality log."""
    _write_days(metrics, path)


def read_quality(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).orderBy("fecha")


def export_star(tables: dict[str, DataFrame], path: str) -> None:
    """One CSV folder with header per table."""
    for name, df in tables.items():
        df.write.mode("overwrite").option("header", True).csv(f"{path}/{name}")


def export_json(record: DataFrame, path: str) -> None:
    """A record as strict JSON; null fields are kept."""
    record.write.mode("overwrite").option("ignoreNullFields", False).json(path)
