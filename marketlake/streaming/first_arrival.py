"""First arrival with its payload on a stream.

``dropDuplicatesWithinWatermark`` keeps any row of a key; here the row that
arrived first is kept, as in batch. Each micro-batch is reduced to one row per
key by a pre-aggregated minimum (a hot key is one row per task before the
shuffle), and joined with a table of remembered keys. What is new is appended
to bronze and remembered.

Both tables are partitioned by the micro-batch, and each batch overwrites its
own part: a batch that is replayed after a failure writes what it wrote before,
because it only looks at keys of earlier batches and at the batch time that
was stored when it first ran. A key is forgotten ``ttl_hours`` after the batch
that brought it; parts that are wholly forgotten are not read any more.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from marketlake.operators import clean
from marketlake.session import exists

# How long a key is remembered -- 24 h for equities, 48 h for derivative contracts.
EQUITY_TTL_HOURS, FO_TTL_HOURS = 24, 48


def batch_time(spark: SparkSession, state: str, batch_id: int) -> int:
    """When a batch first ran (epoch milliseconds): stored once, so a replay sees the same time."""
    path = f"{state}/times/batch_id={batch_id}"
    if not exists(spark, f"{path}/_SUCCESS"):
        now = spark.range(1).select(F.unix_millis(F.current_timestamp()).alias("seen_at"))
        now.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path).first()["seen_at"]


def _null_safe(keys: Sequence[str], left: DataFrame, right: DataFrame):
    on = F.lit(True)
    for k in keys:
        on = on & left[k].eqNullSafe(right[k])
    return on


def remembered(spark: SparkSession, state: str, batch_id: int, since_ms: int, day: str | None = None,
               days: tuple | None = None) -> DataFrame | None:
    """Keys of batches before ``batch_id`` seen since ``since_ms``; ``days`` (first, last) prunes by the key's day."""
    times = f"{state}/times"
    if not exists(spark, times) or not exists(spark, f"{state}/keys"):
        return None
    # one row per batch; only parts still remembered are read
    live = [r["batch_id"] for r in spark.read.schema("seen_at bigint, batch_id bigint").parquet(times)
            .where((F.col("batch_id") < batch_id) & (F.col("seen_at") > since_ms)).select("batch_id").collect()]
    paths = [p for p in (f"{state}/keys/batch_id={b}" for b in sorted(live)) if exists(spark, p)]
    if not paths:
        return None
    keys = spark.read.option("basePath", f"{state}/keys").parquet(*paths).drop("batch_id")
    if day and days and days[0] is not None:
        keys = keys.where(F.col(day).between(*days) | F.col(day).isNull())
    return keys


def merge_batch(batch: DataFrame, batch_id: int, *, keys: Sequence[str], order: Sequence[str], out: str, state: str,
                ttl_hours: float, partition_by: Sequence[str] = (), day: str | None = "trade_date") -> None:
    """Append the first arrivals of a micro-batch to ``out`` and remember their keys under ``state``.

    Running the same batch again changes nothing. ``day`` names a key column
    that narrows the remembered keys to the days of the batch (two values are
    read for it); None if the keys have none.
    """
    spark = batch.sparkSession
    now = batch_time(spark, state, batch_id)
    first = clean.first_arrival(batch, keys, order)
    day = day if day in keys else None
    days = tuple(batch.agg(F.min(day), F.max(day)).first()) if day else None
    known = remembered(spark, state, batch_id, now - int(ttl_hours * 3_600_000), day, days)
    if known is not None:
        first = first.join(known, _null_safe(keys, first, known), "left_anti")
    parts = [c for c in partition_by if c in first.columns]
    target = f"{out}/batch_id={batch_id}"
    # dealt by partition: few files in each, a large one split
    (first.hint("rebalance", *parts) if parts else first).write.mode("overwrite").partitionBy(*parts).parquet(target)
    # read back: the keys are those of the rows that are really there
    written = spark.read.schema(first.schema).option("basePath", target).parquet(target)
    written.select(*keys).write.mode("overwrite").parquet(f"{state}/keys/batch_id={batch_id}")


def read_bronze(spark: SparkSession, out: str, like: DataFrame) -> DataFrame:
    """The bronze table with the columns and types of ``like`` (partition columns are not guessed)."""
    return spark.read.schema(like.schema).option("basePath", out).parquet(out).select(*like.columns)


def start(cleaned: DataFrame, checkpoint: str, *, available_now: bool = True, processing_time: str | None = None,
          after_batch: Callable[[int], None] | None = None, **merge) -> StreamingQuery:
    """Run ``merge_batch`` on every micro-batch of a cleaned stream."""
    def each(batch: DataFrame, batch_id: int) -> None:
        merge_batch(batch, batch_id, **merge)
        if after_batch:
            after_batch(batch_id)

    writer = cleaned.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def start_equity(raw: DataFrame, checkpoint: str, out: str, state: str, *, order: Sequence[str] = clean.ARRIVAL_ORDER,
                 ttl_hours: float = EQUITY_TTL_HOURS, partition_by: Sequence[str] = ("trade_date", "series"), **how):
    """C7 on a stream, with the payload of each key's first arrival."""
    valid = raw.transform(clean.equity_normalise).transform(clean.equity_valid)
    return start(valid, checkpoint, keys=clean.EQUITY_KEY, order=order, out=out, state=state, ttl_hours=ttl_hours,
                 partition_by=partition_by, **how)


def start_fo(raw: DataFrame, checkpoint: str, out: str, state: str, *, order: Sequence[str] = clean.ARRIVAL_ORDER,
             ttl_hours: float = FO_TTL_HOURS, per_day: bool = True, partition_by: Sequence[str] = ("trade_date",), **how):
    """C8 on a stream; ``per_day=False`` is the key as coded, without the trade date."""
    keys = clean.FO_CONTRACT_DAY_KEY if per_day else clean.FO_CONTRACT_KEY
    valid = raw.transform(clean.fo_normalise).transform(clean.fo_valid)
    return start(valid, checkpoint, keys=keys, order=order, out=out, state=state, ttl_hours=ttl_hours,
                 partition_by=partition_by, **how)
