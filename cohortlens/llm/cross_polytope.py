"""Nearest neighbours by cosine with cross-polytope hashing.

A unit vector is turned by a pseudo-rotation (three rounds of random signs and
a fast Hadamard transform) and hashed to its nearest signed axis. A table
hashes every vector by one such function, or by several when the corpus needs
more buckets (the last of them over fewer axes, so the buckets hold about
``BUCKET_ROWS`` vectors at any size). A query looks into the buckets of its
own most likely axes in each table (multiprobe), and what lies there is
ranked by the exact cosine.

How many buckets a query probes is measured, not set: the true neighbours of a
bounded sample of queries are found by one scan of all rows, and the probes
are the fewest that reach ``target`` of them. If no number of probes does, a
function is taken away; with a single function all buckets can be probed,
which is exact.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from cohortlens.llm.common import materialize

TABLES = 4
BUCKET_ROWS = 400  # vectors in a bucket, about
MAX_PROBES = 4096  # buckets that a query visits in a table of several functions, at most
SAMPLE_QUERIES = 200  # queries whose true neighbours set the number of probes
TARGET = 0.95  # share of the sample's neighbours that must be found
BLOCK = 1024  # vectors, and queries, compared at a time
NO_ID = (1 << 63) - 1  # a null id: after all others
_EPS = 1e-12  # above the rounding of a matrix product


def _signs(d: int, table: int, function: int) -> np.ndarray:
    return np.random.default_rng([d, table, function]).choice(np.array([-1.0, 1.0]), size=(3, d))


def rotate(u: np.ndarray, table: int, function: int) -> np.ndarray:
    """A pseudo-rotation of the rows of ``u``, padded to a power of two."""
    n, width = u.shape
    d = 1 << max(0, (width - 1).bit_length())
    y = np.zeros((n, d))
    y[:, :width] = u
    for s in _signs(d, table, function):
        y = y * s
        h = 1
        while h < d:
            z = y.reshape(n, d // (2 * h), 2, h)
            y = np.stack([z[:, :, 0] + z[:, :, 1], z[:, :, 0] - z[:, :, 1]], axis=2).reshape(n, d)
            h *= 2
        y = y / math.sqrt(d)
    return y


def codes(u: np.ndarray, table: int, axes: tuple) -> np.ndarray:
    """The bucket of each row: its nearest signed axis under each function,
    the ``axes`` of a function limited to that many (None: all)."""
    out = np.zeros(len(u), np.int64)
    for f, limit in enumerate(axes):
        y = rotate(u, table, f)[:, :limit]
        a = np.abs(y).argmax(axis=1)
        out = out * (2 * y.shape[1]) + 2 * a + (y[np.arange(len(u)), a] < 0)
    return out


def _costs(u: np.ndarray, table: int, axes: tuple) -> list[np.ndarray]:
    """Per function: how far each signed axis lies behind the nearest one."""
    out = []
    for f, limit in enumerate(axes):
        y = rotate(u, table, f)[:, :limit]
        s = np.stack([y, -y], axis=2).reshape(len(u), -1)
        out.append((s.max(axis=1, keepdims=True) - s) ** 2)
    return out


def probes(u: np.ndarray, table: int, axes: tuple, count: int) -> tuple[np.ndarray, np.ndarray]:
    """(costs, buckets) of the ``count`` likeliest buckets of each row, in order.
    The best combinations of several functions extend best ones of fewer."""
    cost, code = np.zeros((len(u), 1)), np.zeros((len(u), 1), np.int64)
    for c in _costs(u, table, axes):
        w = c.shape[1]
        cost = (cost[:, :, None] + c[:, None, :]).reshape(len(u), -1)
        code = (code[:, :, None] * w + np.arange(w)[None, None, :]).reshape(len(u), -1)
        if cost.shape[1] > count:
            at = np.argpartition(cost, count - 1, axis=1)[:, :count]
            cost, code = np.take_along_axis(cost, at, 1), np.take_along_axis(code, at, 1)
    at = np.argsort(cost, axis=1, kind="stable")
    return np.take_along_axis(cost, at, 1), np.take_along_axis(code, at, 1)


def code_cost(u: np.ndarray, code: np.ndarray, table: int, axes: tuple) -> np.ndarray:
    """The cost for each row of the one bucket given for it."""
    total, left = np.zeros(len(u)), code.copy()
    for c in reversed(_costs(u, table, axes)):
        total += c[np.arange(len(u)), left % c.shape[1]]
        left //= c.shape[1]
    return total


def by_width(col: pa.ChunkedArray | pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, matrix) of the vectors of each length, scaled by powers of
    two so that neither squares nor products leave the range of doubles."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
        if isinstance(col, pa.ChunkedArray):
            col = col.chunk(0) if col.num_chunks else pa.array([], col.type)
    size = np.diff(np.asarray(col.offsets))
    flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    start = np.cumsum(size) - size
    for w in np.unique(size).tolist():
        rows = np.flatnonzero(size == w)
        m = flat[start[rows][:, None] + np.arange(w)[None, :]]
        yield rows, np.ldexp(m, -np.frexp(np.abs(m).max(axis=1))[1][:, None])


def _unit(m: np.ndarray) -> np.ndarray:
    return m / np.sqrt((m * m).sum(axis=1, keepdims=True))


def _slot(width: int, table: int, code: np.ndarray) -> np.ndarray:
    return (np.int64(width) << 46) + (np.int64(table) << 40) + code


def _index(axes: tuple, tables: int, names: list[str]):
    """(slot, names...) of each vector in each table."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for whole in (b.slice(i, 4 * BLOCK) for i in range(0, b.num_rows, 4 * BLOCK)):
                for rows, m in by_width(whole.column("v")):
                    part, u = whole.take(pa.array(rows)), _unit(m)
                    for t in range(tables):
                        slot = _slot(m.shape[1], t, codes(u, t, axes))
                        yield pa.RecordBatch.from_arrays([pa.array(slot), *[part.column(n) for n in names]], names=["slot", *names])
    return run


def _probe(axes: tuple, tables: int, count: int, names: list[str]):
    """(slot, names...) of each query and bucket that it visits."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(1, min(BLOCK, (1 << 16) // count))
        for b in batches:
            for rows, m in by_width(b.column("v")) if b.num_rows else ():
                for i in range(0, len(rows), step):
                    part, u = b.take(pa.array(rows[i:i + step])), _unit(m[i:i + step])
                    for t in range(tables):
                        code = probes(u, t, axes, count)[1]
                        again = part.take(pa.array(np.repeat(np.arange(len(u)), code.shape[1])))
                        yield pa.RecordBatch.from_arrays([pa.array(_slot(m.shape[1], t, code.ravel())), *[again.column(n) for n in names]],
                                                         names=["slot", *names])
    return run


def _needed(sample, axes: tuple, tables: int, k: int):
    """For each query of the sample, the k nearest vectors of the partition:
    (qid, score, cid, probes that find it)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, vectors = sample.value
        queries = [(own[r], m, _unit(m)) for r, m in by_width(pa.array(vectors, pa.list_(pa.float64())))]
        best = {m.shape[1]: [np.zeros((0, 4))] for _, m, _ in queries}
        costs = {m.shape[1]: [probes(u, t, axes, MAX_PROBES)[0] for t in range(tables)] for _, m, u in queries}
        keep: dict[int, tuple] = {}
        for b in batches:
            if not b.num_rows:
                continue
            cid = b.column("cid").to_numpy()
            for rows, m in by_width(b.column("v")):
                for ids, _, uq in (q for q in queries if q[1].shape[1] == m.shape[1]):
                    u = _unit(m)
                    s = uq @ u.T
                    s[ids[:, None] == cid[rows][None, :]] = -2  # its own class
                    at = np.argpartition(-s, min(k, s.shape[1]) - 1, axis=1)[:, :k]
                    q = np.repeat(np.arange(len(ids)), at.shape[1])
                    at = at.ravel()
                    need = np.full(len(at), np.iinfo(np.int64).max)
                    for t in range(tables):
                        c = code_cost(uq[q], codes(u[at], t, axes), t, axes)
                        line = costs[m.shape[1]][t]
                        rank = (line[q] < c[:, None] - _EPS).sum(axis=1) + 1
                        need = np.minimum(need, np.where(rank > line.shape[1], np.iinfo(np.int64).max, rank))
                    new = (q, s[q, at], cid[rows][at], need)
                    old = keep.get(m.shape[1])
                    q, sc, c, nd = [np.concatenate(x) for x in zip(old, new)] if old else new
                    order = np.lexsort((c, -sc, q))
                    first = np.searchsorted(q[order], q[order], side="left")
                    order = order[np.arange(len(order)) - first < k]
                    keep[m.shape[1]] = tuple(x[order] for x in (q, sc, c, nd))
        for ids, m, _ in queries:
            if m.shape[1] in keep:
                q, sc, c, nd = keep[m.shape[1]]
                real = sc > -2
                yield pa.RecordBatch.from_arrays([pa.array(ids[q[real]]), pa.array(sc[real]), pa.array(c[real]), pa.array(nd[real])],
                                                 names=["qid", "score", "cid", "need"])
    return run


def _rank(k: int):
    """One block of vectors against one of queries: the k best of each query,
    and all that tie with the last by rounding, scored exactly."""
    def run(key: tuple, vectors: pa.Table, queries: pa.Table) -> pa.Table:
        if not vectors.num_rows or not queries.num_rows:
            return _FOUND.empty_table()
        (_, a), = by_width(vectors.column("v"))
        (_, b), = by_width(queries.column("v"))
        cid, first = vectors.column("cid").to_numpy(), vectors.column("first").to_numpy()
        qid = queries.column("qid").to_numpy()
        s = _unit(b) @ _unit(a).T
        if s.shape[1] > k:
            s = s >= np.partition(s, s.shape[1] - k, axis=1)[:, s.shape[1] - k][:, None] - _EPS
            q, at = np.nonzero(s)
        else:
            q, at = [x.ravel() for x in np.indices(s.shape)]
        score = np.empty(len(q))
        na, nb = np.sqrt((a * a).sum(axis=1)), np.sqrt((b * b).sum(axis=1))
        for i in range(0, len(q), 1 << 16):
            x, y = q[i:i + (1 << 16)], at[i:i + (1 << 16)]
            score[i:i + (1 << 16)] = (b[x] * a[y]).sum(axis=1) / (nb[x] * na[y])
        order = np.lexsort((cid[at], first[at], -score, q))
        q, at, score = q[order], at[order], score[order]
        top = np.arange(len(q)) - np.searchsorted(q, q, side="left") < k
        q, at, score = q[top], at[top], score[top]
        ids = vectors.column("ids").take(pa.array(at)).cast(_FOUND.field("ids").type)
        return pa.table([pa.array(qid[q]), pa.array(score), pa.array(cid[at]), pa.array(first[at]), ids], schema=_FOUND)
    return run


_FOUND = pa.schema([("qid", pa.int64()), ("score", pa.float64()), ("cid", pa.int64()), ("first", pa.int64()), ("ids", pa.list_(pa.int64()))])


def _search(queries: DataFrame, classes: DataFrame, axes: tuple, tables: int, count: int, k: int) -> DataFrame:
    """The k best classes of each query (qid, v): qid, score, cid, first, ids."""
    v = classes.schema["v"].dataType.simpleString()
    n = classes.select("v").mapInArrow(_index(axes, tables, []), "slot long").groupBy("slot").agg(F.count(F.lit(1)).alias("n"))
    m = queries.select("v").mapInArrow(_probe(axes, tables, count, []), "slot long").groupBy("slot").agg(F.count(F.lit(1)).alias("m"))
    blocks = materialize(n.join(m, "slot").select("slot", F.ceil(F.col("n") / BLOCK).alias("nb"), F.ceil(F.col("m") / BLOCK).alias("nq")), "cp_blocks")
    upto = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), F.col(c) - 1))
    left = (classes.mapInArrow(_index(axes, tables, ["cid", "first", "ids", "v"]), f"slot long, cid long, first long, ids array<bigint>, v {v}")
            .join(blocks, "slot").withColumn("vb", F.pmod(F.xxhash64("cid"), F.col("nb"))).withColumn("qb", upto("nq")).drop("nb", "nq"))
    right = (queries.mapInArrow(_probe(axes, tables, count, ["qid", "v"]), f"slot long, qid long, v {v}")
             .join(blocks, "slot").withColumn("qb", F.pmod(F.xxhash64("qid"), F.col("nq"))).withColumn("vb", upto("nb")).drop("nb", "nq"))
    cell = ["slot", "vb", "qb"]
    found = left.groupBy(cell).cogroup(right.groupBy(cell)).applyInArrow(
        _rank(k), "qid long, score double, cid long, first long, ids array<bigint>")
    # A class found in several tables ranks once: its rows are equal.
    best = Window.partitionBy("qid").orderBy(F.desc("score"), "first", "cid")
    found = found.withColumn("r", F.dense_rank().over(best)).where(F.col("r") <= k).drop("r")
    return materialize(found.dropDuplicates(["qid", "cid"]), "cp_found")


def _functions(rows: int, width: int) -> list[tuple]:
    """The axes of the functions of a table, most functions first."""
    full = 1 << max(0, (width - 1).bit_length())
    bits, each = math.log2(max(1.0, rows / BUCKET_ROWS)), int(math.log2(2 * full))
    out = [(None,)]
    while bits > each * len(out[0]) and 7 + each * len(out[0]) < 40:
        rest = min(each, math.ceil(bits - each * len(out[0])))
        out.insert(0, (*[None] * len(out[0]), max(1, 1 << (rest - 1))))
        if rest < each:
            break
        out[0] = (*out[0][:-1], None)
    return out


def calibrate(queries: DataFrame, classes: DataFrame, k: int, tables: int, target: float) -> tuple[tuple, int]:
    """(axes, probes) that find ``target`` of the sample's true neighbours."""
    spark = classes.sparkSession
    rows, width = classes.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    picked = queries.orderBy(F.xxhash64("qid", F.lit("sample")), "qid").limit(SAMPLE_QUERIES).collect()  # SAMPLE_QUERIES rows
    sample = spark.sparkContext.broadcast((np.array([r.qid for r in picked], np.int64), [list(map(float, r.v)) for r in picked]))
    for axes in _functions(rows or 0, width or 1):
        near = classes.select("cid", "v").mapInArrow(_needed(sample, axes, tables, k), "qid long, score double, cid long, need long")
        w = Window.partitionBy("qid").orderBy(F.desc("score"), "cid")
        need = [r.need for r in near.withColumn("r", F.row_number().over(w)).where(F.col("r") <= k).select("need").collect()]  # k a query
        if not need:
            return axes, 1
        count = int(np.sort(np.array(need))[max(0, math.ceil(target * len(need)) - 1)])
        if count <= MAX_PROBES:
            return axes, count
    return (None,), 2 << (width - 1).bit_length()


def nearest_neighbours(rows: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector: str = "embedding",
                       tables: int = TABLES, target: float = TARGET) -> DataFrame:
    """(query_id, rank, vec_id, score): for each id of ``rows`` where
    ``is_query`` holds, the ``k`` rows found nearest by cosine, nearest first,
    ties to the smaller id. The score is the exact cosine of the stored
    vectors in double precision.

    A vector that is null, empty, zero or holds a null or non-finite
    component takes no part. Vectors of different lengths are not compared.
    Rows that share an id with the query are its own and no candidates;
    repeated rows count once. Equal vectors are one class, searched once. A
    null id is no query, and as a candidate comes last among ties. A query
    that the probed buckets give fewer than ``k`` rows visits all buckets of
    one table, so it returns fewer only if there are no more. Other columns
    are not read. Empty input gives no rows.
    """
    kind = rows.schema[vector].dataType.elementType
    v = F.col(vector) if isinstance(kind, (T.FloatType, T.DoubleType)) else F.col(vector).cast("array<double>")
    sound = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    base = (rows.select(F.col(id_col).cast("long").alias("id"), v.alias("v"), F.coalesce(is_query, F.lit(False)).alias("q"))
            .where(sound).withColumn("cid", F.xxhash64("v")))
    # Classes of equal vectors, each with its k + 1 smallest ids.
    w = Window.partitionBy("cid", "v").orderBy("id")
    few = base.select("cid", "v", F.coalesce("id", F.lit(NO_ID)).alias("id")).withColumn("r", F.dense_rank().over(w)).where(F.col("r") <= k + 1)
    classes = few.groupBy("cid", "v").agg(F.sort_array(F.collect_set("id")).alias("ids")).withColumn("first", F.col("ids")[0])
    classes = materialize(classes.select("cid", "first", "ids", "v"), "cp_classes")
    asked = base.where(F.col("q") & F.col("id").isNotNull())
    queries = materialize(asked.select(F.col("cid").alias("qid"), "v").dropDuplicates(["qid"]), "cp_queries")
    names = asked.select(F.col("cid").alias("qid"), F.col("id").alias("query_id")).distinct()

    def ranked(found: DataFrame) -> DataFrame:
        each = found.select("qid", "score", F.explode("ids").alias("vec_id"))
        each = each.join(names, "qid").where(F.col("vec_id") != F.col("query_id"))
        each = each.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        return each.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    axes, count = calibrate(queries, classes, k, tables, target)
    found = _search(queries, classes, axes, tables, count, k + 1)
    size = found.groupBy("qid").agg(F.sum(F.size("ids")).alias("n"))
    short = materialize(queries.join(size.where(F.col("n") > k).select("qid"), "qid", "left_anti"), "cp_short")
    if not short.isEmpty():
        width = short.agg(F.max(F.size("v"))).first()[0]
        found = found.join(short.select("qid"), "qid", "left_anti").unionByName(
            _search(short, classes, (None,), 1, 2 << (width - 1).bit_length(), k + 1))
    return ranked(found).select("query_id", F.col("rank").cast("int").alias("rank"),
                                F.when(F.col("vec_id") != NO_ID, F.col("vec_id")).alias("vec_id"), "score")
