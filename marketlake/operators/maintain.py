"""Table maintenance: small-file compaction and z-order clustering (M1-M3).

Compaction plans from file metadata (``_metadata.file_path/file_size``),
read as a distributed scan; only one row per partition directory reaches
the driver. Z-ordering maps each clustering column to a rank bucket from
approximate quantiles (a bounded list of split points), interleaves the
bucket bits with column expressions, and range-partitions on the result.
"""

from __future__ import annotations

import logging
import math
import re
import uuid
from collections.abc import Callable, Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.session import exists

log = logging.getLogger(__name__)

# Compaction target and trigger.
TARGET_FILE_BYTES = 128 * 1024 * 1024
MIN_INPUT_FILES = 10

ZORDER_BITS = 10  # bits per column -> 2**10 rank buckets


def file_stats(df: DataFrame) -> DataFrame:
    """One row per data file: path, partition directory, size, rows."""
    files = df.select(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_size").alias("file_size"),
    )
    return files.groupBy("file_path", "file_size").agg(F.count(F.lit(1)).alias("rows")).withColumn(
        "partition", F.regexp_replace("file_path", "/[^/]*$", "")
    )


def compaction_plan(
    df: DataFrame,
    target_bytes: int = TARGET_FILE_BYTES,
    min_input_files: int = MIN_INPUT_FILES,
) -> DataFrame:
    """M1: per partition directory -- files, bytes, rows, rewrite?, target file count."""
    stats = file_stats(df)
    return stats.groupBy("partition").agg(
        F.count(F.lit(1)).alias("input_files"),
        F.sum("file_size").alias("input_bytes"),
        F.sum("rows").alias("rows"),
    ).withColumns({
        "rewrite": F.col("input_files") >= min_input_files,
        "target_files": F.greatest(F.lit(1), F.ceil(F.col("input_bytes") / F.lit(target_bytes))).cast("bigint"),
    })


def _sortable(c: Column, dtype: str) -> Column:
    """An order-preserving numeric image of a column that is no string."""
    if dtype in ("date",):
        return F.unix_date(c).cast("double")
    if dtype.startswith("timestamp"):
        return F.unix_micros(c.cast("timestamp")).cast("double")
    return c.cast("double")


def _sample_points(df: DataFrame, column: str, points: int) -> list[str]:
    """At most ``points`` - 1 split points of a text column, from a bounded sample.

    The sample is the distinct values with the smallest hashes, so families of
    values with a long common prefix are told apart like any others.
    """
    values = df.select(F.col(column).alias("v")).where(F.col("v").isNotNull()).distinct()
    rows = values.orderBy(F.xxhash64("v"), "v").limit(16 * points).collect()
    ranked = sorted({r["v"] for r in rows}, key=lambda v: v.encode("utf-8"))
    cuts = [ranked[i * len(ranked) // points] for i in range(1, points)] if ranked else []
    return sorted(set(cuts), key=lambda v: v.encode("utf-8"))


def _text_bucket(c: Column, cuts: list[str]) -> Column:
    """How many of the sorted ``cuts`` are at most the value, by binary search.

    The number found so far grows by halving strides; a point beyond the last is
    null and adds nothing. One comparison and one number a step: this runs for
    every row, twice where a range partitioner samples.
    """
    if not cuts:
        return F.lit(0).cast("bigint")
    points = F.array(*[F.lit(x) for x in cuts])
    strides = F.array(*[F.lit(1 << b) for b in reversed(range(len(cuts).bit_length()))])
    found = F.aggregate(strides, F.lit(0), lambda n, stride: F.when(F.get(points, n + stride - 1) <= c, n + stride).otherwise(n))
    return found.cast("bigint")


def with_zorder(df: DataFrame, columns: Sequence[str], bits: int = ZORDER_BITS,
                accuracy: int = 10000, out: str = "_z") -> DataFrame:
    """Add the interleaved rank-bucket bits of ``columns`` as bigint ``out``.

    Numbers and dates are cut at quantiles from one ``percentile_approx``
    aggregate, texts at split points of a bounded sample: 2**bits - 1 points
    per column, independent of the table size. Each row finds its bucket by
    binary search, JVM-side. ``df`` is read again for the points: give a
    written table.
    """
    from pyspark.ml.feature import Bucketizer

    dtypes = dict(df.dtypes)
    n = 2 ** bits
    texts = {c: _sample_points(df, c, n) for c in columns if dtypes[c] == "string"}
    images = {c: _sortable(F.col(c), dtypes[c]) for c in columns if c not in texts}
    probs = [i / n for i in range(1, n)]
    row = df.select(*[F.percentile_approx(x, probs, accuracy).alias(c) for c, x in images.items()]).first() if images else {}
    staged = df
    for j, c in enumerate(columns):
        if c in texts:
            staged = staged.withColumn(f"_bkt_{j}", _text_bucket(F.col(c), texts[c]))
            continue
        inner = sorted({float(x) for x in (row[c] or []) if x is not None and not math.isnan(x)})
        staged = Bucketizer(splits=[-math.inf, *inner, math.inf], inputCol=f"_img_{j}", outputCol=f"_bkt_{j}",
                            handleInvalid="keep").transform(staged.withColumn(f"_img_{j}", images[c])).drop(f"_img_{j}")
    z = F.lit(0).cast("bigint")
    for j in range(len(columns)):
        bucket = F.col(f"_bkt_{j}").cast("bigint")
        for b in range(bits):
            bit = F.shiftright(bucket, b).bitwiseAND(F.lit(1))
            z = z.bitwiseOR(F.shiftleft(bit, b * len(columns) + j))
    return staged.withColumn(out, z).drop(*[f"_bkt_{j}" for j in range(len(columns))])


def zorder(df: DataFrame, columns: Sequence[str], num_partitions: int | None = None,
           within: Sequence[str] = ()) -> DataFrame:
    """M2: cluster rows by the z-value of ``columns`` (content unchanged).

    ``within`` columns (table partitions) come first in the order. Without
    ``num_partitions`` adaptive execution sizes the partitions from their bytes.
    """
    cols = [c for c in columns if c in df.columns]
    if not cols:
        return df
    # A row hash as secondary range key: rows sharing one z-value (a hot
    # symbol-day) spread over several output files instead of one task.
    # It is no column, so it is not shuffled.
    salt = F.xxhash64(*[F.col(c) for c in df.columns])
    keyed = with_zorder(df, cols)
    order = [*within, "_z", salt]
    dealt = keyed.repartitionByRange(num_partitions, *order) if num_partitions else keyed.repartitionByRange(*order)
    return dealt.sortWithinPartitions(*within, "_z").drop("_z")


def _plain(path: str) -> str:
    """A path without its scheme and authority, and without a slash at the end."""
    return re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "", unquote(path)).rstrip("/")


def relative(directory: str, root: str) -> str:
    """The part of a directory below a table's root, ``''`` for the root itself."""
    return _plain(directory)[len(_plain(root)):].strip("/")


def partition_columns(paths: Sequence[str], root: str) -> list[str]:
    """Columns of a table laid out as ``<root>/a=1/b=2``; directories above the root do not count."""
    names = [[p.split("=", 1)[0] for p in relative(path, root).split("/") if "=" in p] for path in paths]
    return names[0] if names and all(n == names[0] for n in names) else []


def rewrite(
    spark: SparkSession,
    src: str,
    dst: str,
    zorder_by: Sequence[str] = ("symbol", "trade_date"),
    target_bytes: int = TARGET_FILE_BYTES,
    min_input_files: int = MIN_INPUT_FILES,
    force: bool = False,
) -> int:
    """Compact (and z-order) a Parquet table from ``src`` into ``dst``.

    Each directory is judged by itself: one with at least ``min_input_files``
    data files (or any, with ``force``) is rewritten into ``ceil(bytes /
    target)`` files or so, the others are copied as they are. Partition columns
    stay partition columns. Returns the number of files the rewritten
    directories are meant to have, 0 when no directory needs it (then ``dst``
    is not written).
    """
    df = spark.read.parquet(src)
    # one row per directory, file metadata only
    plan = compaction_plan(df, target_bytes, min_input_files).collect()
    chosen = [r for r in plan if force or r["rewrite"]]
    if not chosen:
        return 0
    parts = partition_columns([r["partition"] for r in plan], src)
    read = spark.read.option("basePath", src).parquet if parts else spark.read.parquet
    n_out = sum(r["target_files"] for r in chosen)
    out = zorder(read(*[r["partition"] for r in chosen]), zorder_by, n_out, within=parts)
    out.write.mode("overwrite").partitionBy(*parts).parquet(dst)
    if rest := [r["partition"] for r in plan if r not in chosen]:
        read(*rest).write.mode("append").partitionBy(*parts).parquet(dst)
    return n_out


# --- compaction with partial progress ---------------------------------------------

JOURNAL = "seq bigint, partition string, location string"


def _journal(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(JOURNAL).option("recursiveFileLookup", "true").json(path)


def manifest(spark: SparkSession, table: str, journal: str) -> dict[str, str]:
    """Where each partition of a table is now: {``a=1/b=2``: directory}, one entry per partition.

    Partitions that no compaction has moved are below ``table`` itself.
    """
    found = {relative(r["partition"], table): r["partition"] for r in
             file_stats(spark.read.parquet(table)).select("partition").distinct().collect()}
    if exists(spark, journal):
        moved = _journal(spark, journal).groupBy("partition").agg(F.max_by("location", "seq").alias("location")).collect()
        found |= {r["partition"]: r["location"] for r in moved}
    return found


def _root(location: str, partition: str) -> str:
    return location[:len(location.rstrip("/")) - len(partition)].rstrip("/") if partition else location


def _read_parts(spark: SparkSession, parts: dict[str, str]) -> DataFrame:
    """Rows of partitions that may lie below several roots, partition columns included."""
    roots: dict[str, list[str]] = {}
    for partition, location in sorted(parts.items()):
        roots.setdefault(_root(location, partition), []).append(location)
    frames = [spark.read.option("basePath", root).parquet(*where) for root, where in roots.items()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def read_compacted(spark: SparkSession, table: str, journal: str) -> DataFrame:
    """A table as its journal has it: each partition wholly from before or wholly from after its compaction."""
    return _read_parts(spark, manifest(spark, table, journal))


def compact_in_place(
    spark: SparkSession,
    table: str,
    journal: str,
    staging: str,
    zorder_by: Sequence[str] = ("symbol", "trade_date"),
    target_bytes: int = TARGET_FILE_BYTES,
    min_input_files: int = MIN_INPUT_FILES,
    commit_bytes: int = 64 * 1024 ** 3,
    after_commit: Callable[[list[str]], None] | None = None,
) -> list[str]:
    """M1 with partial progress: compact the partitions that need it, a commit at a time; returns them.

    A commit rewrites partitions of about ``commit_bytes`` together below a
    new folder of ``staging``, and then appends where they are now to the
    ``journal``, as one file. Until that file is there readers see the old
    files, afterwards the new ones. A run that was stopped has kept its
    commits: the next one plans from the journal, in which those partitions
    have few files, and does the others. Partitions with fewer than
    ``min_input_files`` files are not touched, and no file is removed.
    """
    now = manifest(spark, table, journal)
    where = {_plain(location): partition for partition, location in now.items()}
    stats = None
    roots: dict[str, list[str]] = {}
    for partition, location in now.items():
        roots.setdefault(_root(location, partition), []).append(location)
    for root, dirs in roots.items():
        part = compaction_plan(spark.read.option("basePath", root).parquet(*dirs), target_bytes, min_input_files)
        stats = part if stats is None else stats.unionByName(part)
    plan = sorted((where[_plain(r["partition"])], r["input_bytes"], r["target_files"])
                  for r in stats.where("rewrite").collect())
    columns = partition_columns([f"{table}/{p}" for p in now], table)
    done: list[str] = []
    while plan:
        group, size = [], 0
        while plan and (not group or size + plan[0][1] <= commit_bytes):
            size += plan[0][1]
            group.append(plan.pop(0))
        names = [p for p, _, _ in group]
        out = f"{staging}/{uuid.uuid4().hex}"
        rows = _read_parts(spark, {p: now[p] for p in names})
        zorder(rows, zorder_by, sum(n for _, _, n in group), within=columns).write.partitionBy(*columns).parquet(out)
        seq = 1 + (_journal(spark, journal).agg(F.max("seq")).first()[0] or 0) if exists(spark, journal) else 1
        entries = spark.createDataFrame([(seq, p, f"{out}/{p}" if p else out) for p in names], JOURNAL)
        # one file, which appears whole or not at all
        entries.coalesce(1).write.mode("append").json(journal)
        done += names
        if after_commit:
            after_commit(names)
    return done


def compact_tables(tables: Sequence[tuple[str, Callable[[], object]]]) -> dict[str, str]:
    """M3: run each table's compaction in priority order; a failure is logged
    and the run continues with the next table."""
    status: dict[str, str] = {}
    for name, job in tables:
        try:
            job()
            status[name] = "ok"
        except Exception as exc:  # noqa: BLE001 - isolate one table's failure
            log.warning("compaction failed for %s: %s", name, exc)
            status[name] = f"failed: {exc}"
    return status
