"""Structured Streaming cleaners (S15, S17, C3/C6 streaming).

The same normalise/filter functions as batch (``operators.clean``) run on a
streaming DataFrame; de-duplication keeps the first row per key with
``dropDuplicatesWithinWatermark``. The watermark runs on the time a record is
seen (the time of its micro-batch), not on a time inside the record: no record
is ever late, whatever order the exchange delivers in, and a key is remembered
for the delay (24 h equities, 48 h derivatives) after it was first seen. A
duplicate that comes later than that is emitted again. Cleaned, rejected and
duplicate records together are the input.

Sinks are partitioned Parquet with a checkpoint under the shared checkpoint
root, so a restarted query resumes exactly where it stopped (exactly-once
file sink).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from marketlake import schemas
from marketlake.operators import clean
from marketlake.sources import landing

# How long a key is remembered -- 24 h for equities, 48 h for
# derivative contracts.
EQUITY_DELAY = "24 hours"
FO_DELAY = "48 hours"


def read_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    fmt: str = "json",
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """A file-stream source with an explicit schema (no inference).

    JSON messages map to the record schema; a Kafka deployment reads
    ``from_json(value, schema)`` from the topic instead.
    """
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def read_messages(spark: SparkSession, path: str, stream: bool = True, max_files_per_trigger: int | None = None) -> DataFrame:
    """Message files as they are: one row (value, source_file) for each line, whatever it holds."""
    reader = spark.readStream if stream else spark.read
    if max_files_per_trigger and stream:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.format("text").load(path).select("value", F.col("_metadata.file_path").alias("source_file"))


_CORRUPT = "_corrupt_record"


def _one_record(text: Column) -> Column:
    """Whether a text that decodes is one record to its end.

    Decoding stops where the record ends and does not look at what follows.
    """
    # a record ends with a brace: where the only one is at the end, nothing follows
    flat = F.locate("}", text) == F.length(F.rtrim(text, F.lit(" \t\r\n")))
    # else the value after it in a list must be the one put there, which is longer than any in the text;
    # numbers that are none, which this reader does not take, are read as zeros
    end = F.repeat(F.lit("="), F.length(text))
    plain = F.regexp_replace(text, r"([:,\[]\s*)[+-]?(?:NaN|Infinity|INF)", "$1 0")
    after = F.get_json_object(F.concat(F.lit("["), plain, F.lit(',"'), end, F.lit('"]')), "$[1]")
    return F.when(flat, True).otherwise(F.coalesce(after == end, F.lit(False)))


def _decoded(messages: DataFrame, schema: T.StructType, value_col: str) -> DataFrame:
    """Typed columns, the message text, and why it cannot be decoded (null: it can)."""
    text = F.col(value_col).cast("string")
    wide = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    message = F.from_json(text, wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})
    rest = [c for c in messages.columns if c != value_col]
    # blank lines decode to nothing, broken JSON and values of another type to a corrupt record
    reason = (F.when(text.isNull() | (F.trim(text) == ""), F.lit("empty_message"))
              .when(F.col("_m").isNull() | F.col(f"_m.{_CORRUPT}").isNotNull() | ~_one_record(F.col("_text")),
                    F.lit("malformed_message")))
    # a filter on the reason would be pushed below the decoding, and repeat it with all that made
    # the text; one that also asks for a drawn number (which passes every row) stays where it is
    return (messages.withColumns({"_m": message, "_text": text}).withColumn("_reason", reason)
            .select("_m.*", "_text", "_reason", F.rand(0).alias("_drawn"), *[F.col(c) for c in rest]).drop(_CORRUPT))


def parse_messages(messages: DataFrame, schema: T.StructType, value_col: str = "value") -> DataFrame:
    """Decode value-only JSON messages (e.g. a Kafka topic's ``value``) to typed rows.

    Malformed messages decode to all-null rows, which the cleaners' validity
    filters remove; ``malformed_messages`` keeps them with their text.
    """
    decoded = F.from_json(F.col(value_col).cast("string"), schema)
    return messages.select(decoded.alias("_m")).select("_m.*")


def well_formed(messages: DataFrame, schema: T.StructType, value_col: str = "value") -> DataFrame:
    """Typed rows of the messages that decode, other columns (the source file) kept."""
    return _decoded(messages, schema, value_col).where("_reason IS NULL AND _drawn >= 0").drop("_text", "_reason", "_drawn")


def malformed_messages(messages: DataFrame, schema: T.StructType, value_col: str = "value") -> DataFrame:
    """Quarantine: the messages that do not decode to their end as one record, (message, reject_reason, other columns) as they came."""
    rest = [c for c in messages.columns if c != value_col]
    return (_decoded(messages, schema, value_col).where("_reason IS NOT NULL AND _drawn >= 0")
            .select(F.col("_text").alias("message"), F.col("_reason").alias("reject_reason"), *rest))


def split_messages(messages: DataFrame, name: str, value_col: str = "value") -> tuple[DataFrame, DataFrame, DataFrame]:
    """S12 for messages: (accepted, rejected with a reason, malformed); together they are the input."""
    schema = schemas.BY_NAME[name]
    typed = well_formed(messages, schema, value_col)
    accepted, rejected = landing.enforce_schema(typed, name)
    return (accepted, rejected.withColumn("reject_reason", landing.reject_reason(rejected, name)),
            malformed_messages(messages, schema, value_col))


def message_outcomes(messages: DataFrame, name: str, value_col: str = "value") -> DataFrame:
    """One row of counts (input, accepted, rejected, malformed) for a domain's messages, in one pass."""
    schema = schemas.BY_NAME[name]
    typed = _decoded(messages, schema, value_col)
    bad = F.col("_reason").isNotNull()
    reason = landing.reject_reason(typed, name)
    # a message without an ingestion time gets the present one
    return typed.agg(F.count(F.lit(1)).alias("input"), F.count_if(~bad & reason.isNull()).alias("accepted"),
                     F.count_if(~bad & reason.isNotNull()).alias("rejected"), F.count_if(bad).alias("malformed"))


def _seen_time(df: DataFrame) -> DataFrame:
    return df.withColumn("_seen_at", F.current_timestamp())


def first_per_key_stream(df: DataFrame, keys: Sequence[str], event_time: str, delay: str) -> DataFrame:
    """First row per key on a stream; state kept ``delay`` past each key's
    event time (watermark on ``event_time``, a timestamp column)."""
    return df.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))


def equity_clean_stream(df: DataFrame, delay: str = EQUITY_DELAY) -> DataFrame:
    """C7 on a stream: normalise, reject, first arrival per (symbol, trade_date)."""
    valid = df.transform(clean.equity_normalise).transform(clean.equity_valid).transform(_seen_time)
    return first_per_key_stream(valid, clean.EQUITY_KEY, "_seen_at", delay).drop("_seen_at")


def fo_clean_stream(df: DataFrame, delay: str = FO_DELAY, per_day: bool = True) -> DataFrame:
    """C8 on a stream: normalise, validity filter, first arrival per contract."""
    keys = clean.FO_CONTRACT_DAY_KEY if per_day else clean.FO_CONTRACT_KEY
    valid = df.transform(clean.fo_normalise).transform(clean.fo_valid).transform(_seen_time)
    return first_per_key_stream(valid, keys, "_seen_at", delay).drop("_seen_at")


def rejects_stream(df: DataFrame, domain: str) -> DataFrame:
    """Dead letters: the records a stream cleaner drops, with ``reject_reason``.

    Stateless (normalise + the inverse of the validity filter), so it runs as
    its own query on the same source with its own checkpoint.
    """
    if domain == "equity":
        return clean.equity_rejects(clean.equity_normalise(df))
    return clean.fo_rejects(clean.fo_normalise(df))


def write_bronze(
    df: DataFrame,
    path: str,
    checkpoint: str,
    partition_by: Sequence[str] = ("trade_date", "series"),
    available_now: bool = True,
    processing_time: str | None = None,
) -> StreamingQuery:
    """Append to a partitioned Parquet table with a checkpoint.

    ``available_now`` drains what is present and stops (batch-like
    backfill); otherwise a processing-time trigger runs continuously.
    """
    writer = (
        df.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .partitionBy(*[c for c in partition_by if c in df.columns])
        .outputMode("append")
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


# State on the executors' disks instead of in their heap.
ROCKSDB = {"spark.sql.streaming.stateStore.providerClass":
           "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}

RAW_SCHEMAS = {"equity": schemas.EQUITY_RAW, "fo": schemas.FO_RAW}


def run_available_now(query: StreamingQuery, timeout_s: int | None = None) -> None:
    """Wait until an availableNow query has drained its backlog; re-raise errors.

    There is no time limit unless one is given (tests): then an overrunning
    query is stopped.
    """
    finished = True if timeout_s is None else query.awaitTermination(timeout_s)
    if timeout_s is None:
        query.awaitTermination()
    if not finished:
        query.stop()
        raise TimeoutError(f"streaming query {query.name or query.id} did not finish in {timeout_s}s")
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


def start_query(spark, start, state_partitions: int | None = None,
                conf: dict[str, str] | None = None):
    """Start a streaming query under extra session settings, then restore them.

    ``state_partitions`` fixes the number of state-store partitions (kept in
    the checkpoint for the life of the query); default: the session's shuffle
    partitions. A started query runs on a clone of the session's conf, so
    restoring the caller's values afterwards does not affect it.
    """
    settings = dict(conf or {})
    if state_partitions:
        settings["spark.sql.shuffle.partitions"] = str(state_partitions)
    previous = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        return start()
    finally:
        for k, v in previous.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
