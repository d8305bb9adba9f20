"""SimHash near-duplicates by covering locality-sensitive hashing.

For radius r the 64 bit positions are dealt to the nonzero vectors of
{0,1}^(r+1). Each nonzero vector v gives one table, whose mask keeps the
positions whose vector has an odd inner product with v. Any r positions span
at most r dimensions, so some v is orthogonal to all of them: its mask keeps
none of the differing bits, and a pair within the radius surely meets in that
table. No pair is missed, whatever the data.

Copies first become one row per distinct fingerprint, so groups of equal texts
never meet in a bucket. A bucket of up to ``SMALL_BUCKET`` fingerprints is
compared directly. A larger one (near copies by the thousand) is linked through
its members' one-bit neighbours instead: two fingerprints differ in at most
two bits exactly when they share a neighbour, and a neighbour has at most 65
members; so the work stays in proportion to the members, with nothing left out.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import binary_list, fresh
from marketlake.llm.graph import components

SHINGLE = 3
MAX_BITS = 2
SMALL_BUCKET = 64
SEED = 42
#: Shingles unpacked to bits at a time.
UNPACK = 65_536


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of a text in UTF-8: the majority of each bit over all shingles."""
    words = text.lower().split()  # bytes: only A-Z and ASCII white space
    if not words:
        return 0
    if len(words) < shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    h = np.array([xxhash.xxh64_intdigest(g, SEED) for g in grams], dtype=">u8")
    ones = np.zeros(64, np.int64)
    for i in range(0, len(h), UNPACK):
        part = np.ascontiguousarray(h[i:i + UNPACK])
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(h)).tobytes(), "big")


def masks(radius: int) -> list[int]:
    """One mask for each nonzero vector of {0,1}^(radius+1)."""
    vectors = range(1, 1 << (radius + 1))
    of_bit = [1 + i % len(vectors) for i in range(64)]
    return [sum(1 << i for i in range(64) if (of_bit[i] & v).bit_count() % 2) for v in vectors]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """(id, row, fp) for every row; fp as a signed 64-bit number, row a hash of the text."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for b in batches:
            fp = [_signed(fingerprint(t, shingle)) for t in binary_list(b.column(2))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fp, pa.int64())], names=["id", "row", "fp"])

    return docs.select(id_col, F.xxhash64(text_col), text_col).mapInArrow(run, f"id {id_type}, row bigint, fp bigint")


def hex64(c: Column) -> Column:
    return F.lower(F.lpad(F.hex(c), 16, "0"))


def _star(radius: int):
    """Links within a small bucket: enough of them to join all that are linked."""
    def run(batches):
        for b in batches:
            left, right = [], []
            for bucket in b.column(0).to_pylist():
                f = np.array(sorted(bucket), np.int64).view(np.uint64)
                near = np.bitwise_count(f[:, None] ^ f[None, :]) <= radius
                group = list(range(len(f)))
                for i, j in zip(*np.nonzero(np.triu(near, 1))):
                    a, c = group[i], group[j]
                    if a != c:
                        group = [a if g == c else g for g in group]
                        left.append(int(f[i].view(np.int64)))
                        right.append(int(f[j].view(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())],
                                             names=["a", "b"])

    return run


def links(distinct: DataFrame, max_bits: int, small_bucket: int = SMALL_BUCKET) -> DataFrame:
    """Links (a, b) that join all fingerprints (column fp, distinct) within ``max_bits``."""
    tables = F.array(*[F.struct(F.lit(t).cast("tinyint").alias("t"),
                                F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key"))
                       for t, m in enumerate(masks(max_bits))])
    keyed = distinct.select("fp", F.inline(tables))
    sizes = keyed.groupBy("t", "key").agg(F.count("*").alias("n")).where("n > 1")
    met = keyed.join(sizes, ["t", "key"])
    small = (met.where(F.col("n") <= small_bucket).groupBy("t", "key")
             .agg(F.collect_list("fp").alias("bucket")).select("bucket").mapInArrow(_star(max_bits), "a bigint, b bigint"))
    near = met.where(F.col("n") > small_bucket).select("fp").distinct()
    return small.unionByName(_by_neighbours(near, max_bits))


def _by_neighbours(near: DataFrame, max_bits: int) -> DataFrame:
    """Links of fingerprints that share a neighbour within half the distance.

    For an even distance d, two fingerprints within d share one that is at most
    d/2 bits away from both, and sharing one implies being within d. For an odd
    distance the pairs found at (d+1)/2 are checked.
    """
    steps = (max_bits + 1) // 2
    flips = [0] + [sum(1 << i for i in c) for k in range(1, steps + 1) for c in combinations(range(64), k)]
    at = near.select("fp", F.explode(F.transform(
        F.array(*[F.lit(_signed(x)) for x in flips]), lambda x: F.col("fp").bitwiseXOR(x))).alias("hub"))
    if max_bits % 2 == 0:
        hubs = at.groupBy("hub").agg(F.min("fp").alias("a"), F.max("fp").alias("top"),
                                     F.collect_list("fp").alias("all")).where("a <> top")
        return hubs.select("a", F.explode("all").alias("b")).where("a <> b").distinct()
    hubs = at.groupBy("hub").agg(F.collect_list("fp").alias("all")).where(F.size("all") > 1)
    pairs = hubs.select(F.explode("all").alias("a"), "all").select("a", F.explode("all").alias("b"))
    return pairs.where((F.col("a") < F.col("b"))
                       & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)).distinct()


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    max_bits: int = MAX_BITS, small_bucket: int = SMALL_BUCKET) -> DataFrame:
    """``id_col``, fingerprint, component_id for every row.

    component_id is the smallest id reachable over links of at most
    ``max_bits`` differing bits (null only if all ids there are null). A null
    or empty text has fingerprint zero and is linked like any other; a null id
    takes part in links; equal rows give equal rows. Other columns are ignored.
    """
    return _grouped(docs, id_col, text_col, shingle, max_bits, small_bucket).select(
        F.col("id").alias(id_col), hex64(F.col("fp")).alias("fingerprint"), "component_id")


def _grouped(docs: DataFrame, id_col: str, text_col: str, shingle: int, max_bits: int, small_bucket: int) -> DataFrame:
    """(fp, id, row, root, component_id) of every row; root names its group."""
    fps = fingerprints(docs, id_col, text_col, shingle).checkpoint()
    distinct = fps.groupBy("fp").agg(F.min("id").alias("least")).checkpoint()
    found = components(links(distinct.select("fp"), max_bits, small_bucket))
    rooted = distinct.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return fps.join(rooted.join(least, "root").select("fp", "root", "component_id"), "fp")


def keep_one(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
             max_bits: int = MAX_BITS) -> DataFrame:
    """One row of each near-duplicate group: that with the smallest id; same columns.

    Of a group's rows with that id one text stays, that with the smallest hash,
    so an id whose texts are in two groups can stay with both. Rows that repeat
    id and text are one document, of which the row with the smallest hash over
    all columns stays. Rows without an id cannot be named and stay.
    """
    names = {n: fresh(docs, n) for n in ("kept_id", "kept_row", "row")}
    groups = _grouped(docs, id_col, text_col, shingle, max_bits, SMALL_BUCKET).where(F.col("id") == F.col("component_id"))
    keep = (groups.groupBy("root").agg(F.min(F.struct("id", "row")).alias("first"))
            .select(F.col("first.id").alias(names["kept_id"]), F.col("first.row").alias(names["kept_row"])))
    rows = docs.withColumn(names["row"], F.xxhash64(text_col))
    rows = rows.join(keep, (rows[id_col] == keep[names["kept_id"]]) & (rows[names["row"]] == keep[names["kept_row"]]))
    one = rows.groupBy(names["kept_id"], names["kept_row"]).agg(
        F.min_by(F.struct(*docs.columns), F.xxhash64(*docs.columns)).alias("one"))
    return one.select("one.*").unionByName(docs.where(F.col(id_col).isNull()))
