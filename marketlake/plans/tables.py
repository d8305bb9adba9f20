"""Tables by name: written, registered and replaced in the session catalog.

A table is an external Parquet table at a path. Its layout (partition columns,
buckets, order within a bucket) is part of its registration, so a scan by name
prunes partitions and buckets, and joins on the bucket column need no exchange.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.operators import maintain

#: Bytes of a bucket file to aim for.
FILE_BYTES = 128 * 1024 * 1024


@dataclass(frozen=True)
class Layout:
    """How a table lies: partition columns, and buckets of one column sorted within."""

    partition_by: tuple[str, ...] = ()
    bucket_by: str | None = None
    buckets: int = 0
    sort_by: tuple[str, ...] = ()


def symbol_layout(buckets: int) -> Layout:
    """The layout of silver: by year, in buckets of symbols, each symbol's days in order."""
    return Layout(("trade_year",), "symbol", buckets, ("symbol", "trade_date"))


def buckets_for(partition_bytes: int, file_bytes: int = FILE_BYTES) -> int:
    """Buckets that give files of about ``file_bytes`` in a partition of ``partition_bytes``."""
    return max(1, math.ceil(partition_bytes / file_bytes))


def _bucket(layout: Layout):
    # the hash that Spark's buckets use, so each task holds whole buckets
    return F.pmod(F.hash(layout.bucket_by), F.lit(layout.buckets))


def distributed(df: DataFrame, layout: Layout) -> DataFrame:
    """Rows dealt by (partition, bucket), so that each of them is one file.

    Adaptive execution joins small ones in a task and splits a group that is
    larger than its advisory size (a hot symbol's year) into more files.
    """
    keys = list(layout.partition_by)
    if layout.buckets:
        df = df.withColumn("_bucket", _bucket(layout))
        keys.append("_bucket")
    return df.hint("rebalance", *keys).drop("_bucket") if keys else df


def write(df: DataFrame, name: str, path: str, layout: Layout) -> DataFrame:
    """Create or replace the table ``name`` at ``path``; returns its scan."""
    writer = distributed(df, layout).write.format("parquet").mode("overwrite").option("path", path)
    if layout.partition_by:
        writer = writer.partitionBy(*layout.partition_by)
    if layout.buckets:
        writer = writer.bucketBy(layout.buckets, layout.bucket_by)
        if layout.sort_by:
            writer = writer.sortBy(*layout.sort_by)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def overwrite_partitions(df: DataFrame, name: str, layout: Layout) -> None:
    """Replace the partitions of the table that ``df`` has rows of; the others stay."""
    spark = df.sparkSession
    columns = spark.table(name).columns
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "dynamic")
    try:
        distributed(df.select(*columns), layout).write.mode("overwrite").insertInto(name)
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def _ddl(schema) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)


def register(spark: SparkSession, name: str, path: str, layout: Layout = Layout(), journal: str | None = None,
             schema=None) -> DataFrame:
    """Name a table that lies at ``path`` and recover its partitions; returns its scan.

    With the ``journal`` of a compaction each partition is registered where it
    is now. ``schema`` (by default that of the files) types the columns, the
    partition columns too: dates and years written as folder names are text
    unless it says otherwise.
    """
    schema = schema or spark.read.parquet(path).schema
    sql = f"CREATE TABLE {name} ({_ddl(schema)}) USING parquet"
    if layout.partition_by:
        sql += f" PARTITIONED BY ({', '.join(layout.partition_by)})"
    if layout.buckets:
        order = f" SORTED BY ({', '.join(layout.sort_by)})" if layout.sort_by else ""
        sql += f" CLUSTERED BY ({layout.bucket_by}){order} INTO {layout.buckets} BUCKETS"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"{sql} LOCATION '{_quoted(path)}'")
    if layout.partition_by and journal is None:
        spark.catalog.recoverPartitions(name)
    elif layout.partition_by:
        for partition, location in maintain.manifest(spark, path, journal).items():
            spec = ", ".join(f"{k} = '{_quoted(v)}'" for k, v in (p.split("=", 1) for p in partition.split("/")))
            spark.sql(f"ALTER TABLE {name} ADD PARTITION ({spec}) LOCATION '{_quoted(location)}'")
    return spark.table(name)


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def swap_partitions(spark: SparkSession, name: str, partitions: dict[str, str]) -> None:
    """Point partitions of a registered table (``a=1/b=2``) at new locations; readers see old or new files."""
    for partition, location in partitions.items():
        spec = ", ".join(f"{k} = '{_quoted(v)}'" for k, v in (p.split("=", 1) for p in partition.split("/")))
        spark.sql(f"ALTER TABLE {name} PARTITION ({spec}) SET LOCATION '{_quoted(location)}'")
    spark.catalog.refreshTable(name)
