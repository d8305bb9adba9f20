"""Small helpers shared by the text operators."""

from __future__ import annotations

import math
import os
import zlib
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import marketlake


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # Python workers import this package; on a cluster it comes with --py-files
    root = str(Path(marketlake.__file__).resolve().parents[1])
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (env.get("PYTHONPATH"), root) if x)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that no column of ``df`` has (case-insensitively)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def crc_mod(doc_id: Column, n: int) -> Column:
    """crc32 of the id written as text, modulo ``n``; a null id counts as ''."""
    return (F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n).cast("int")


def py_crc_mod(doc_id, n: int) -> int:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % n


def blocks_for(total: int | None, each: int) -> int:
    return max(1, math.ceil((total or 0) / each))


def by_bytes(values: Iterable, size, limit: int) -> Iterator[list]:
    """Consecutive runs of ``values`` whose sizes add up to about ``limit``."""
    run, held = [], 0
    for v in values:
        run.append(v)
        held += size(v)
        if held >= limit:
            yield run
            run, held = [], 0
    if run:
        yield run


def binary_list(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null as b''."""
    return [b"" if v is None else v for v in column.cast(pa.large_binary()).to_pylist()]


def rows(schema: pa.Schema, *columns) -> pa.RecordBatch:
    arrays = [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


#: Bits of a set of keys that is sent to tasks (16 MB at most). It only tells what cannot be in the set:
#: a false hit costs work, and what depends on it is settled exactly afterwards.
LEAST_BITS, MOST_BITS = 16, 27


def key_bits(keys: DataFrame, n: int) -> np.ndarray:
    """Set of the (hashed) ``key`` column of ``n`` rows, or-ed together by Spark as a bounded number of 64-bit rows."""
    size = min(max(LEAST_BITS, math.ceil(math.log2(16 * max(n, 1)))), MOST_BITS)
    top = f"shiftrightunsigned(key, {64 - size})"
    got = (keys.select(F.expr(f"shiftright({top}, 6)").alias("at"),
                       F.expr(f"shiftleft(1L, cast({top} & 63 AS int))").alias("v"))
           .groupBy("at").agg(F.bit_or("v").alias("v")).toArrow())
    out = np.zeros(1 << (size - 6), np.int64)
    out[got.column("at").to_numpy()] = got.column("v").to_numpy()
    return out.view(np.uint8)


def in_bits(bits: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Which of the unsigned keys may be in a set of bits."""
    at = key >> np.uint64(64 - int(math.log2(len(bits) * 8)))
    return (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
