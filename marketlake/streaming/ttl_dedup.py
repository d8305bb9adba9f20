"""First-arrival dedup with a processing-time TTL (exact variant of C3/C6).

The watermark form (``clean_stream``) bounds state by event time. This
variant keeps one boolean per key in a value state whose TTL is processing
time, so a key is forgotten a fixed wall-clock interval after its first
record -- the keyed-state-with-timer behaviour of the stream cleaners -- and
no row is ever dropped as late. Within one micro-batch the earliest
``ingested_at`` of a key wins.

It runs on ``transformWithState`` (row-based, the fastest: its state is kept
by buckets of keys), ``transformWithStateInPandas`` or
``applyInPandasWithState`` (timeout twin, both a call for each key); all keep
state in the RocksDB store. Prefer the watermark form unless
wall-clock expiry is required; always run these with a bounded
``awaitTermination``.
"""

from __future__ import annotations

import pickle
import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

# Ship this module's code with the task (the Python workers need not have
# the package installed).
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# Fixed value: default key lifetime, 24 h in milliseconds.
DAY_MS = 24 * 60 * 60 * 1000
# Fixed values of the row-based form: buckets of keys (a stream keeps this number
# as long as its checkpoint), bytes of records that a task packs at once, and
# remembered keys in one element of a bucket's state.
KEY_BUCKETS = 2048
PACK_BYTES = 64 * 1024 * 1024
KEYS_IN_ELEMENT = 16_384


class FirstArrivalWithTTL(StatefulProcessor):
    """Emit the first row of each key; remember the key for ``ttl_ms``."""

    def __init__(self, ttl_ms: int, order: str = "ingested_at") -> None:
        self.ttl_ms = ttl_ms
        self.order = order

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "seen boolean", self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        if self.seen.exists():
            for _ in rows:  # drain: every row of a remembered key is a duplicate
                pass
            return
        best = None
        for pdf in rows:
            cand = pdf.nsmallest(1, self.order)
            if best is None or cand[self.order].iloc[0] < best[self.order].iloc[0]:
                best = cand
        if best is not None:
            self.seen.update((True,))
            yield best

    def close(self) -> None:
        pass


def _key_values(column: pa.ChunkedArray) -> list:
    """A key column's values, each equal to itself and hashable."""
    values = column.to_pylist()
    if pa.types.is_floating(column.type):
        return ["NaN" if v != v else v for v in values]
    return [repr(v) for v in values] if pa.types.is_nested(column.type) else values


def _first_places(table: pa.Table, keys: Sequence[str], order: str) -> dict[tuple, int]:
    """Where each key's first row is: the least in order, and of equal ones the first."""
    at_order, first = table[order].to_pylist(), {}
    for i, key in enumerate(zip(*[_key_values(table[k]) for k in keys])):
        best = first.setdefault(key, i)
        if best != i and at_order[i] < at_order[best]:
            first[key] = i
    return first


def _pack(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def _packer(keys: Sequence[str], order: str, bucket: str):
    """Rows to (bucket, packed rows): of the rows packed at once, the first of each key."""
    def packed(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(batches).combine_chunks()
        places = np.fromiter(_first_places(table, keys, order).values(), dtype=np.int64)
        buckets = table[bucket].to_numpy()[places]
        sort = np.argsort(buckets, kind="stable")
        table, buckets = table.drop_columns([bucket]).take(pa.array(places[sort])), buckets[sort]
        ends = [*(np.flatnonzero(np.diff(buckets)) + 1).tolist(), len(buckets)]
        begins = [0, *ends[:-1]]
        return pa.RecordBatch.from_arrays([pa.array(buckets[begins], pa.int32()), pa.array(
            [_pack(table.slice(lo, hi - lo)) for lo, hi in zip(begins, ends)], pa.binary())], ["bucket", "packed"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                size += batch.nbytes
            if size >= PACK_BYTES:
                yield packed(held)
                held, size = [], 0
        if held:
            yield packed(held)
    return pack


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows in batch.column(0):
            yield from pa.ipc.open_stream(rows.as_buffer())


class FirstArrivalRowsWithTTL(StatefulProcessor):
    """Emit the first row of each key of a bucket; remember the keys for ``ttl_ms``.

    The keys that a micro-batch brings new to a bucket are one element of its
    list state, and expire together: they were first seen at the same time. A
    bucket's state is read and extended in a few calls, not in two for each key.
    """

    def __init__(self, keys: Sequence[str], ttl_ms: int, order: str = "ingested_at") -> None:
        self.keys = list(keys)
        self.ttl_ms = ttl_ms
        self.order = order

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getListState("seen", "keys binary", self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues):
        table = pa.concat_tables([pa.ipc.open_stream(row["packed"]).read_all() for row in rows]).combine_chunks()
        first = _first_places(table, self.keys, self.order)
        for (element,) in self.seen.get():
            for known in pickle.loads(element):
                first.pop(known, None)
        if first:
            new = list(first)
            self.seen.appendList([(pickle.dumps(new[i:i + KEYS_IN_ELEMENT]),) for i in range(0, len(new), KEYS_IN_ELEMENT)])
            yield Row(packed=_pack(table.take(pa.array(first.values(), pa.int64()))))

    def close(self) -> None:
        pass


def _first_arrival_group(order: str, ttl_ms: int):
    def fn(key, pdfs, state):
        if state.hasTimedOut:
            state.remove()
            for _ in pdfs:
                pass
            return
        if state.exists:
            for _ in pdfs:
                pass
            return
        best = None
        for pdf in pdfs:
            cand = pdf.nsmallest(1, order)
            if best is None or cand[order].iloc[0] < best[order].iloc[0]:
                best = cand
        state.update((True,))
        state.setTimeoutDuration(ttl_ms)
        if best is not None:
            yield best
    return fn


def dedup_with_timeout(df: DataFrame, keys: Sequence[str], ttl_ms: int = DAY_MS,
                       order: str = "ingested_at") -> DataFrame:
    """Same semantics on ``applyInPandasWithState``: a processing-time timeout
    of ``ttl_ms`` after a key's first record removes its state."""
    return df.groupBy(*keys).applyInPandasWithState(
        _first_arrival_group(order, ttl_ms),
        outputStructType=df.schema,
        stateStructType="seen boolean",
        outputMode="append",
        timeoutConf="ProcessingTimeTimeout",
    )


def dedup_with_ttl(df: DataFrame, keys: Sequence[str], ttl_ms: int = DAY_MS,
                   order: str = "ingested_at") -> DataFrame:
    """Streaming first arrival per key with processing-time TTL state.

    The session must use the RocksDB state store provider when the query
    starts (``ROCKSDB_PROVIDER``).
    """
    return df.groupBy(*keys).transformWithStateInPandas(
        statefulProcessor=FirstArrivalWithTTL(ttl_ms, order),
        outputStructType=df.schema,
        outputMode="Append",
        timeMode="ProcessingTime",
    )


def dedup_with_ttl_rows(df: DataFrame, keys: Sequence[str], ttl_ms: int = DAY_MS,
                        order: str = "ingested_at", buckets: int = KEY_BUCKETS) -> DataFrame:
    """``dedup_with_ttl`` on the row-based ``transformWithState`` API.

    Rows are grouped by a bucket of their keys, so state calls grow with the
    buckets of a micro-batch, not with its keys. Before, each task packs its
    rows of a bucket into one value, and afterwards the first rows are unpacked.
    ``buckets`` must stay the same for the life of a checkpoint.
    """
    bucket = "_bucket"
    while bucket in df.columns:
        bucket = f"_{bucket}"
    packed = df.withColumn(bucket, F.pmod(F.hash(*keys), F.lit(buckets))).mapInArrow(
        _packer(keys, order, bucket), "bucket int, packed binary")
    first = packed.groupBy("bucket").transformWithState(
        statefulProcessor=FirstArrivalRowsWithTTL(keys, ttl_ms, order),
        outputStructType="packed binary",
        outputMode="Append",
        timeMode="ProcessingTime",
    )
    return first.mapInArrow(_unpack, df.schema)


# Session settings the TTL variants need when their query starts: RocksDB
# state (required for state TTL), and no empty micro-batches -- otherwise a
# pending processing-time expiry keeps an ``availableNow`` query running
# forever. Expired keys are then evicted in the next batch that has data,
# which is the only time a dedup decision is made. A batch commits the changes
# of each state partition, not a new snapshot of it.
START_CONF = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}


def start_with_conf(spark, start, state_partitions: int | None = None):
    """Start a streaming query under ``START_CONF`` (see ``clean_stream.start_query``).

    Restarts from the same checkpoint must use the same state store provider.
    """
    from marketlake.streaming.clean_stream import start_query

    return start_query(spark, start, state_partitions, START_CONF)
