"""Nearest neighbours by inner product over balanced posting lists.

Vectors get one more entry that brings them all to one length, so that the
largest inner product is the smallest distance. Balanced binary clustering of a
bounded sample gives centroids in leaf order; a graph of near centroids is kept
in memory. Every distinct vector is found its lists by a search in that graph:
the nearest one, and on a boundary also others that are almost as near, unless
a list that it has is nearer to them. A query searches the graph likewise and
takes the lists within a ratio of its nearest centroid's distance.

Neighbouring lists form groups, and a group's rows are dealt into parts of
bounded size; queries go to the groups of their lists and meet each part as a
block of rows. Equal vectors are one entry with their smallest ids, which are
all that a result can hold.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlake.llm.common import fresh
from marketlake.session import scratch_path

NEAREST = 20
#: The centroids are fitted on about so many distinct vectors, chosen by hash; every vector is indexed.
SAMPLE = 65_536
#: Vectors for each list, and lists at most (they get longer beyond: the graph stays a few MB).
LIST_ROWS, MAX_LISTS = 256, 8_192
#: Neighbours of a centroid in the graph; a walk starts from every so many centroids.
DEGREE, ENTRY = 24, 32
#: A vector is also put on lists whose centroid is farther than its nearest by this share at most, and on so many in all.
REPLICA_RATIO, REPLICAS = 0.05, 4
#: ... unless a centroid that it has is nearer to the new one than this share of the vector's distance.
APART = 0.5
#: A query takes the lists up to this share farther than its nearest.
QUERY_RATIO = 0.15
#: Lists of a group; rows of an index part and of a query block.
GROUP_LISTS, PART_ROWS, QUERY_ROWS = 16, 16_384, 8_192


# --- centroids and their graph ----------------------------------------------------

def _halves(x: np.ndarray, rng) -> np.ndarray:
    """Which half each row belongs to: two means, cut so that both sides are as large."""
    a = x[rng.integers(len(x))]
    b = x[((x - a) ** 2).sum(axis=1).argmax()]
    for _ in range(6):
        side = x @ (b - a)
        right = np.zeros(len(x), bool)
        right[np.argsort(side, kind="stable")[len(x) // 2:]] = True
        a, b = x[~right].mean(axis=0), x[right].mean(axis=0)
    return right


def balanced_centroids(x: np.ndarray, lists: int) -> np.ndarray:
    """About ``lists`` means of equally large cells, in the order of the leaves, so that neighbours are near."""
    rng = np.random.default_rng(len(x))

    def cells(rows: np.ndarray, n: int) -> list[np.ndarray]:
        if n < 2 or len(rows) < 4:
            return [rows]
        right = _halves(x[rows], rng)
        return cells(rows[~right], n // 2) + cells(rows[right], n - n // 2)

    return np.array([x[c].mean(axis=0) for c in cells(np.arange(len(x)), lists)], np.float32)


def centroid_graph(centroids: np.ndarray, degree: int = DEGREE) -> np.ndarray:
    """The nearest ``degree`` centroids of each, and its neighbours in leaf order so that all are connected."""
    k = len(centroids)
    degree = min(degree, k - 1)
    norm = (centroids.astype(float) ** 2).sum(axis=1)
    out = np.empty((k, degree + 2), np.int32)
    for a in range(0, k if degree else 0, 1024):
        d = norm - 2 * (centroids[a:a + 1024].astype(float) @ centroids.T)
        d[np.arange(len(d)), np.arange(a, a + len(d))] = np.inf  # not itself
        out[a:a + 1024, :degree] = np.argpartition(d, degree - 1, axis=1)[:, :degree]
    out[:, degree], out[:, degree + 1] = (np.arange(k) - 1) % k, (np.arange(k) + 1) % k
    return out


def graph_search(x: np.ndarray, centroids: np.ndarray, graph: np.ndarray,
                 ratio: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, list, distance) of the lists within ``ratio`` of each row's nearest, nearest first.

    The walk starts from every ``ENTRY``-th centroid and goes on from each node
    that is within ``ratio`` of the row's nearest distance so far; a whole
    batch of rows takes each step together.
    """
    n, k = len(x), len(centroids)
    norm, own = (centroids ** 2).sum(axis=1), (x ** 2).sum(axis=1)
    far = np.float32((1 + ratio) ** 2)
    entries = np.arange(0, k, ENTRY)
    d = np.maximum(own[:, None] + norm[entries] - 2 * (x @ centroids[entries].T), 0)
    best = d.min(axis=1)
    seen = np.zeros(n * k, bool)
    keys = (np.arange(n)[:, None] * k + entries).ravel()
    seen[keys] = True
    near = d.ravel() <= np.repeat(best, len(entries)) * far
    found_keys, found_d = [keys[near]], [d.ravel()[near]]
    open_keys, open_d = found_keys[0], found_d[0]
    while len(open_keys):
        next_keys = ((open_keys // k * k)[:, None] + graph[open_keys % k]).ravel()
        next_keys = np.unique(next_keys[~seen[next_keys]])
        seen[next_keys] = True
        d = np.empty(len(next_keys), np.float32)
        for a in range(0, len(d), 1 << 16):
            i, j = np.divmod(next_keys[a:a + (1 << 16)], k)
            d[a:a + (1 << 16)] = own[i] + norm[j] - 2 * np.einsum("ij,ij->i", x[i], centroids[j])
        d = np.maximum(d, 0)
        np.minimum.at(best, next_keys // k, d)
        near = d <= best[next_keys // k] * far
        open_keys, open_d = next_keys[near], d[near]
        found_keys.append(open_keys)
        found_d.append(open_d)
    keys, d = np.concatenate(found_keys), np.concatenate(found_d)
    near = d <= best[keys // k] * far
    keys, d = keys[near], np.sqrt(d[near])
    order = np.lexsort((keys, d, keys // k))
    return keys[order] // k, (keys[order] % k).astype(np.int32), d[order]


def closure(x: np.ndarray, centroids: np.ndarray, graph: np.ndarray, ratio: float = REPLICA_RATIO,
            replicas: int = REPLICAS) -> tuple[np.ndarray, np.ndarray]:
    """(row, list): the lists that each row is put on."""
    r, c, d = graph_search(x, centroids, graph, ratio)
    start = np.r_[True, r[1:] != r[:-1]]
    place = np.arange(len(r)) - np.maximum.accumulate(np.where(start, np.arange(len(r)), 0))
    taken: list[np.ndarray] = [np.flatnonzero(place == 0)]
    lists = np.full((len(x), replicas), -1, np.int64)
    lists[r[taken[0]], 0] = c[taken[0]]
    held = np.ones(len(x), int)
    for p in range(1, int(place.max(initial=0)) + 1):
        at = np.flatnonzero(place == p)
        at = at[held[r[at]] < replicas]
        if not len(at):
            break
        ok = np.ones(len(at), bool)
        for s in range(replicas):
            has = lists[r[at], s]
            gap = np.sqrt(((centroids[np.maximum(has, 0)] - centroids[c[at]]) ** 2).sum(axis=1))
            ok &= (has < 0) | (gap >= APART * d[at])  # else the list that it has stands for this one
        at = at[ok]
        lists[r[at], held[r[at]]] = c[at]
        held[r[at]] += 1
        taken.append(at)
    at = np.sort(np.concatenate(taken))
    return r[at], c[at]


# --- Spark ------------------------------------------------------------------------

def _vectors(column: pa.Array, d: int) -> np.ndarray:
    """Rows of a column of lists in double precision, filled with zeros to ``d``."""
    size = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    if (size == d).all():
        return flat.reshape(-1, d)
    out = np.zeros((len(column), d))
    out[np.repeat(np.arange(len(size)), size), np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out


def usable(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, vec, h1, h2) of the rows that take part; h1 and h2 name equal vectors."""
    v = F.col(vec_col)
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))
    return (df.where(F.col(id_col).isNotNull() & v.isNotNull() & finite & F.exists(v, lambda c: c != 0))
            .select(F.col(id_col).alias("id"), v.alias("vec"), F.xxhash64(v).alias("h1"),
                    F.xxhash64(v, F.lit(1)).alias("h2")))


def _unit(x: np.ndarray, longest: float, query: bool) -> np.ndarray:
    """Points on the unit sphere whose distances rank inner products; queries get 0 as their further entry."""
    most = np.abs(x).max(axis=1, keepdims=True)
    if query:
        x = x / most
        return np.hstack([x / np.sqrt((x ** 2).sum(axis=1, keepdims=True)), np.zeros((len(x), 1))]).astype(np.float32)
    x = x / longest
    return np.hstack([x, np.sqrt(np.maximum(1 - (x ** 2).sum(axis=1, keepdims=True), 0))]).astype(np.float32)


def _dealt(rows: DataFrame, shared, query: bool) -> DataFrame:
    """A row (grp, lists, ...) of ``rows`` for each group that has lists of it; ``rows`` begin with vec."""
    names = rows.columns[1:]

    def find(batches):
        centroids, graph, d, longest, ratio = shared.value
        for b in batches:
            for a in range(0, b.num_rows, 512):
                part = b.slice(a, 512)
                x = _unit(_vectors(part.column(0), d), longest, query)
                if query:
                    r, c, _ = graph_search(x, centroids, graph, ratio)
                else:
                    r, c = closure(x, centroids, graph)
                order = np.lexsort((c, r))
                r, c = r[order], c[order]
                grp = c // GROUP_LISTS
                start = np.flatnonzero(np.r_[True, (r[1:] != r[:-1]) | (grp[1:] != grp[:-1])])
                ends = np.r_[start, len(r)]
                at = pa.array(r[start])
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(c, pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(grp[start], pa.int32()), lists, *(col.take(at) for col in part.columns)],
                    names=["grp", "lists", "vec", *names])

    types = rows.schema
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in types)
    return rows.mapInArrow(find, f"grp int, lists array<int>, {fields}")


def _member(lists: pa.Array, first: int) -> np.ndarray:
    size = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(lists), GROUP_LISTS), np.float32)
    out[np.repeat(np.arange(len(size)), size), lists.flatten().to_numpy() - first] = 1
    return out


def _nearest_in_unit(d: int, keep: int, id_type: pa.DataType):
    """For each query of a unit, the ``keep`` best (score, id) among the rows on its lists."""
    schema = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("vec_id", id_type), ("score", pa.float64())])

    def find(queries: pa.Table, index: pa.Table) -> pa.Table:
        out = []
        if queries.num_rows and index.num_rows:
            queries, index = queries.combine_chunks(), index.combine_chunks()
            one = lambda t, name: t.column(name).chunk(0)
            q, x = _vectors(one(queries, "vec"), d), _vectors(one(index, "vec"), d)
            first = queries.column("grp")[0].as_py() * GROUP_LISTS
            ql, xl = _member(one(queries, "lists"), first), _member(one(index, "lists"), first)
            ids = one(index, "ids")
            n_ids, begin = np.diff(ids.offsets.to_numpy()), ids.offsets.to_numpy()[:-1] - ids.offsets[0].as_py()
            flat = ids.flatten()
            values = flat.to_numpy(zero_copy_only=False)
            for a in range(0, len(q), 256):
                s = q[a:a + 256] @ x.T
                s[(ql[a:a + 256] @ xl.T == 0) | np.isnan(s)] = -np.inf
                if s.shape[1] > keep:
                    least = -np.partition(-s, keep - 1, axis=1)[:, keep - 1]
                    # what rounding may have put below an equal one stays
                    least = np.where(np.isfinite(least), least - 1e-12 * (np.abs(least) + 1), least)
                else:
                    least = np.full(len(s), -np.inf)
                i, j = np.nonzero((s >= least[:, None]) & (s > -np.inf))
                score = (q[a + i] * x[j]).sum(axis=1)  # alike in whichever unit the pair meets
                rep = np.repeat(np.arange(len(i)), n_ids[j])
                at = np.arange(len(rep)) - np.repeat(np.cumsum(n_ids[j]) - n_ids[j], n_ids[j]) + begin[j][rep]
                i, score = i[rep], score[rep]
                order = np.lexsort((values[at], -score, i))
                i, score, at = i[order], score[order], at[order]
                rank = np.arange(len(i)) - np.searchsorted(i, i)
                top = rank < keep
                src = pa.array(a + i[top])
                out.append(pa.Table.from_arrays(
                    [one(queries, "h1").take(src), one(queries, "h2").take(src), flat.take(pa.array(at[top])),
                     pa.array(score[top])], schema=schema))
        return pa.concat_tables(out) if out else schema.empty_table()

    return find


def _by_group(spark, df: DataFrame, each: int, name: str) -> DataFrame:
    """(grp, ``name``): into how many parts of about ``each`` rows a group is dealt; one small row for each group."""
    return df.groupBy("grp").agg(F.ceil(F.count("*") / each).cast("int").alias(name))


def _found(spark, queries: DataFrame, index: DataFrame, parts: DataFrame, d: int, keep: int) -> DataFrame:
    """(h1, h2, found): for each query vector its best (minus score, vec_id), at most ``keep``, best first."""
    path = scratch_path(spark, "ann-queries")
    queries.write.parquet(path)
    queries = spark.read.parquet(path)
    blocks = _by_group(spark, queries, QUERY_ROWS, "blocks")
    n_parts = parts.join(blocks, "grp")
    id_type = index.schema["ids"].dataType.elementType.simpleString()
    left = (queries.join(F.broadcast(n_parts), "grp")
            .withColumn("block", F.pmod("h2", "blocks").cast("int"))
            .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts", "blocks"))
    right = (index.join(F.broadcast(n_parts), "grp")
             .withColumn("part", F.pmod("h2", "parts").cast("int"))
             .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("parts", "blocks"))
    unit = ["grp", "part", "block"]
    arrow_id = pa.int32() if id_type == "int" else pa.int64()
    pairs = left.groupBy(*unit).cogroup(right.groupBy(*unit)).applyInArrow(
        _nearest_in_unit(d, keep, arrow_id), f"h1 bigint, h2 bigint, vec_id {id_type}, score double")
    # a replica may meet a query in several groups: equal rows share a rank
    best = Window.partitionBy("h1", "h2").orderBy(F.desc("score"), "vec_id")
    return (pairs.withColumn("rank", F.dense_rank().over(best)).where(F.col("rank") <= keep)
            .groupBy("h1", "h2")
            .agg(F.array_sort(F.collect_set(F.struct((-F.col("score")).alias("minus"), "vec_id"))).alias("found")))


def nearest(df: DataFrame, queries=None, *, id_col: str = "vec_id", vec_col: str = "embedding", k: int = NEAREST,
            ratio: float = QUERY_RATIO, sample: int = SAMPLE, list_rows: int = LIST_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of every query row by inner product.

    ``queries`` is a condition on ``df`` (by default: the id is divisible by
    20); candidates are all rows with another id. Ties go to the smaller id.
    Rows without an id and vectors that are null, empty, zero, or hold null or
    non-finite entries take no part; shorter vectors count as filled with zeros.
    Repeated rows of an id and vector are one; an id with several vectors is a
    candidate, or query, with each. A query for which the lists give fewer than
    ``k`` (and fewer than there are) is searched again on all lists. Other
    columns of ``df`` may be used by ``queries`` and are not carried. Ids are
    integers.
    """
    spark = df.sparkSession
    marked = df.withColumn(mark := fresh(df, "is_query"), F.coalesce(
        queries if queries is not None else F.col(id_col) % 20 == 0, F.lit(False)))
    rows = usable(marked, id_col, vec_col)
    asked = usable(marked.where(mark), id_col, vec_col)
    most = F.array_max(F.transform("vec", lambda c: F.abs(c.cast("double"))))
    length = most * F.sqrt(F.aggregate(F.transform("vec", lambda c: c.cast("double") / most), F.lit(0.0),
                                       lambda s, c: s + c * c))
    # equal vectors: one entry with the ids that can be in a result (the query's own may be among them)
    keep = k + 1
    ids = (rows.select("h1", "h2", "id").distinct()
           .withColumn("rank", F.row_number().over(Window.partitionBy("h1", "h2").orderBy("id")))
           .where(F.col("rank") <= keep).groupBy("h1", "h2").agg(F.array_sort(F.collect_list("id")).alias("ids")))
    distinct = rows.groupBy("h1", "h2").agg(F.first("vec").alias("vec"))
    path = scratch_path(spark, "ann-vectors")
    distinct.join(ids, ["h1", "h2"]).select("vec", "h1", "h2", "ids").write.parquet(path)
    vectors = spark.read.parquet(path)
    n, n_ids, longest, d = vectors.agg(F.count("*"), F.sum(F.size("ids")), F.max(length), F.max(F.size("vec"))).first()
    n, longest, d = n or 0, longest or 1.0, d or 1
    fitted = vectors.where(F.pmod("h1", F.lit(math.ceil(max(n, 1) / sample))) == 0).select("vec").toArrow()
    x = _unit(_vectors(fitted.column(0).combine_chunks(), d), longest, False) if fitted.num_rows else np.zeros((1, d + 1), np.float32)
    centroids = balanced_centroids(x, max(1, min(MAX_LISTS, math.ceil(n / list_rows), len(x))))
    graph = centroid_graph(centroids)
    shared = lambda r: spark.sparkContext.broadcast((centroids, graph, d, longest, r))
    path = scratch_path(spark, "ann-index")
    _dealt(vectors, shared(ratio), False).write.parquet(path)
    index = spark.read.parquet(path)
    parts = _by_group(spark, index, PART_ROWS, "parts")
    unique = asked.groupBy("h1", "h2").agg(F.first("vec").alias("vec")).select("vec", "h1", "h2")
    path = scratch_path(spark, "ann-found")
    _found(spark, _dealt(unique, shared(ratio), True), index, parts, d, keep).write.parquet(path)
    found = spark.read.parquet(path)
    if (n_ids or 0) < keep:
        want = n_ids or 0
    else:
        want = keep
    short = unique.join(found.where(F.size("found") >= want), ["h1", "h2"], "left_anti").select("vec", "h1", "h2")
    if not short.isEmpty():
        again = _found(spark, _dealt(short, shared(float("inf")), True), index, parts, d, keep)
        found = found.where(F.size("found") >= want).unionByName(again)
    own = asked.select(F.col("id").alias("query_id"), "h1", "h2").distinct()
    others = F.slice(F.filter("found", lambda f: f["vec_id"] != F.col("query_id")), 1, k)
    return (own.join(found, ["h1", "h2"]).select("query_id", F.posexplode(others).alias("at", "f"))
            .select("query_id", (F.col("at") + 1).alias("rank"), F.col("f.vec_id").alias("vec_id"),
                    (-F.col("f.minus")).alias("score")))
