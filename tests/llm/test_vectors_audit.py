"""Nearest neighbours, filter audit and centroid clustering against brute force."""

import collections
import hashlib
import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.llm import cross_polytope as cp
from cohortlens.llm import filter_audit as fa
from cohortlens.llm.bisector_clusters import bisectors, bisector_clusters, tournament
from cohortlens.llm.cross_polytope import nearest_neighbours
from cohortlens.llm.filter_audit import audit_filters
from tests.conftest import SF_ORACLE
from tests.llm.helpers import DOCS, WORD

VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())),
                        T.StructField("label", T.IntegerType())])


def vectors(spark, rows, clash=True):
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], VECTORS)
    if clash:
        for c in ("v", "cid", "rank", "score", "slot", "id", "x", "cluster", "distance"):
            df = df.withColumn(c, F.lit("z"))
    return df


# --- op11 -----------------------------------------------------------------

def nearest(rows, queries, k=5):
    """All candidates by falling cosine: {query: [(id, score)]}, plain floats."""
    out = {}
    sound = {(i, tuple(v)) for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    for q, vq in [(i, v) for i, v in sound if i in queries]:
        got = {}
        for i, v in sound:
            if i != q and len(v) == len(vq):
                s = sum(a * b for a, b in zip(v, vq)) / math.sqrt(sum(a * a for a in v)) / math.sqrt(sum(a * a for a in vq))
                got[i] = max(s, got.get(i, -2))
        out[q] = sorted(got.items(), key=lambda x: (-round(x[1], 12), x[0] is None, x[0]))[:k]
    return out


def test_rotation_keeps_lengths_and_codes_are_in_range():
    x = np.random.default_rng(0).normal(size=(50, 20))
    y = cp.rotate(x, 1, 0)
    assert y.shape == (50, 32) and np.allclose((y * y).sum(1), (x * x).sum(1))
    code = cp.codes(x, 2, (None, 4))
    assert ((0 <= code) & (code < 64 * 8)).all()
    cost, bucket = cp.probes(x, 2, (None, 4), 40)
    assert (bucket[:, 0] == code).all() and (np.diff(cost, axis=1) >= 0).all()
    every = sorted(((cp.code_cost(x[:1], np.array([c]), 2, (None, 4))[0], c) for c in range(512)))
    assert np.allclose([c for c, _ in every[:40]], cost[0])


def test_recall_and_scores(spark):
    e = spark.read.parquet(f"{SF_ORACLE.replace('0.01', '0.1')}/embeddings.parquet")
    p = e.select("vec_id", "embedding").toPandas().sort_values("vec_id")
    x = np.stack(list(p.embedding)).astype(float)
    ids, n = p.vec_id.to_numpy(), np.linalg.norm(x, axis=1)
    hit = total = 0
    rows = collections.defaultdict(list)
    for r in nearest_neighbours(e, F.col("vec_id") % 50 == 0).collect():
        rows[r.query_id].append(r)
    assert set(rows) == {i for i in ids.tolist() if i % 50 == 0}
    for q, got in rows.items():
        got.sort(key=lambda r: r["rank"])
        at = int(np.searchsorted(ids, q))
        s = x @ x[at] / n / n[at]
        s[at] = -2
        assert [r["rank"] for r in got] == [1, 2, 3, 4, 5]
        assert [(-r.score, r.vec_id) for r in got] == sorted((-r.score, r.vec_id) for r in got)
        assert all(abs(r.score - s[np.searchsorted(ids, r.vec_id)]) < 1e-14 for r in got)
        hit += len({r.vec_id for r in got} & set(ids[np.argsort(-s)[:5]].tolist()))
        total += 5
    assert hit / total >= 0.9


def test_neighbours_in_several_functions_and_blocks(spark, monkeypatch):
    """Small buckets and blocks: two functions a table, split cells, a hot
    group of close vectors, copies and scaled copies."""
    rng = np.random.default_rng(3)
    base = rng.normal(size=(40, 8))
    rows = [(i, (base[i % 40] + 0.01 * rng.normal(size=8)).tolist()) for i in range(300)]
    rows += [(300 + i, (base[0] + 0.001 * rng.normal(size=8)).tolist()) for i in range(150)]
    rows += [(450 + i, base[1].tolist()) for i in range(30)] + [(480 + i, (base[1] * 2 ** i).tolist()) for i in range(10)]
    monkeypatch.setattr(cp, "BUCKET_ROWS", 4)
    monkeypatch.setattr(cp, "BLOCK", 32)
    queries = {i for i, _ in rows if i % 10 == 0}
    want, got = nearest(rows, queries), collections.defaultdict(list)
    for r in nearest_neighbours(vectors(spark, rows), F.col("vec_id") % 10 == 0).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    assert set(got) == set(want)
    assert sum(len({a for a, _ in got[q]} & {a for a, _ in want[q]}) for q in want) >= 0.9 * sum(map(len, want.values()))
    for q in (450, 460, 470, 480):  # copies: ties go to the smaller ids
        assert [a for a, _ in got[q]][:5] == [a for a, _ in want[q]][:5]


def test_neighbour_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (50, [1.0, 0.0]), (None, [1.0, 0.0]), (7, [-1.0, 0.0]), (8, [0.0, 0.0]), (9, None), (10, []),
            (11, [nan, 1.0]), (12, [inf, 1.0]), (13, [None, 1.0]), (14, [1.0, 2.0, 3.0]), (100, [2.0, 1.0, 0.0, 5.0]), (15, [1e300, 1e300]),
            (150, [0.0, 0.0])]
    got = nearest_neighbours(vectors(spark, rows), F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.vec_id, round(r.score, 9)) for r in got] == [
        (0, 50, 1.0), (0, None, 1.0), (0, 15, round(math.sqrt(0.5), 9)), (0, 7, -1.0),
        (50, 0, 1.0), (50, None, 1.0), (50, 15, round(math.sqrt(0.5), 9)), (50, 7, -1.0)]
    assert nearest_neighbours(vectors(spark, []), F.col("vec_id") % 50 == 0).collect() == []
    assert nearest_neighbours(vectors(spark, [(1, [1.0])]), F.col("vec_id") % 50 == 0).collect() == []


# --- op12 -----------------------------------------------------------------

def audit(docs, labels):
    """{(part, order, step): counts} by walking every order over every row."""
    first = {}
    for i, t, _ in docs:
        k = t or ""
        first[k] = min(first.get(k, (True, 0)), (i is None, i or 0))
    fails, parts = [], []
    for i, t, s in docs:
        t = t or ""
        w = WORD.findall(t)
        fails.append([len(w) < 50, 100 * len(set(w)) < 65 * len(w), 100 * sum("A" <= c <= "Z" for c in t) > 5 * len(t),
                      any(c in "#$%&*|" for c in t), (i is None, i or 0) > first[t]])
        parts.append(s or "")
    out, shapley = {}, collections.Counter()
    for order in itertools.permutations(range(5)):
        name = "".join("ABCDE"[f] for f in order)
        alive = [True] * len(docs)
        for step, f in enumerate(order, 1):
            c = {p: [0] * 6 for p in parts}
            for j, (p, fl) in enumerate(zip(parts, fails)):
                good, toxic = labels.get(docs[j][0], (0, 0))
                if fl[f] and alive[j]:
                    alive[j] = False
                    c[p][1] += 1
                    c[p][4] += good
                    c[p][5] += toxic
                    shapley[p, f] += 1
                elif fl[f]:
                    c[p][2] += 1
                c[p][3] += fl[f] and sum(fl) == 1
                c[p][0] += alive[j]
            for p, v in c.items():
                out[p, name, step] = v
    return {k: (*v, shapley[k[0], "ABCDE".index(k[1][k[2] - 1])]) for k, v in out.items()}


def write_files(spark, path, docs, per):
    """One Parquet file for each ``per`` rows, oldest first."""
    for a in range(0, len(docs), per):
        spark.createDataFrame([(i, t, "en", s, 0) for i, t, s in docs[a:a + per]], DOCS).coalesce(1).write.mode("append").parquet(path)


def result(df):
    return {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley)
            for r in df.collect()}


def filter_docs():
    prose = " ".join(f"w{i}" for i in range(60))
    texts = [prose, prose + " #", "Ab Cd " + prose, "same " * 60, "short", None, "", " \t\n ", "UPPER CASE TEXT", prose + "é",
             " ".join(f"x{i}" for i in range(20_000))]
    docs = [(100 - i, texts[i % len(texts)], ["a", "b", None][i % 3]) for i in range(45)]
    docs += [(None, prose, "a"), (None, "only here", "b"), (None, "only here", "b"), (7, prose, "b"), (7, prose, "a"), (7, "other", "a")]
    return docs


def test_audit_retracts_over_micro_batches(spark, tmpdir_fresh):
    docs = filter_docs()  # falling ids: nearly every file brings smaller ones
    labels = {100: (1, 0), 99: (0, 1), 7: (1, 1), 80: (1, 1), 3: (0, 0)}
    path = f"{tmpdir_fresh}/documents.parquet"
    write_files(spark, path, docs, 10)
    lab = spark.createDataFrame([(k, *v) for k, v in labels.items()] + [(80, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    assert result(audit_filters(spark, path, lab)) == audit(docs, labels)
    assert result(audit_filters(spark, path, lab, batches=1)) == audit(docs, labels)


def test_audit_goes_on_with_new_files_only(spark, tmpdir_fresh, monkeypatch):
    docs, lab = filter_docs(), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    path, run = f"{tmpdir_fresh}/documents.parquet", f"{tmpdir_fresh}/run"
    write_files(spark, path, docs[:25], 9)
    assert result(audit_filters(spark, path, lab, run_dir=run)) == audit(docs[:25], {})
    write_files(spark, path, docs[25:], 9)
    monkeypatch.setattr(fa, "LEAST_BUCKETS", 3)  # the run keeps the number it began with
    assert result(audit_filters(spark, path, lab, run_dir=run)) == audit(docs, {})
    assert result(audit_filters(spark, path, lab, run_dir=run)) == audit(docs, {})


def test_audit_of_an_empty_table(spark, tmpdir_fresh):
    path = f"{tmpdir_fresh}/documents.parquet"
    spark.createDataFrame([], DOCS).write.parquet(path)
    assert audit_filters(spark, path, spark.createDataFrame([], "doc_id long, quality int, toxic int")).collect() == []


# --- op13 -----------------------------------------------------------------

def clusters(rows, k=8, rounds=10, width=64, scale=1024):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows
            if v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return []
    dist = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    c = [v for _, v in sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]))[:k]]
    near = lambda v: min(range(len(c)), key=lambda j: (dist(v, c[j]), j))
    for _ in range(rounds):
        groups = collections.defaultdict(list)
        for _, v in kept:
            groups[near(v)].append(v)
        c = [[sum(col) // len(groups[j]) for col in zip(*groups[j])] if groups[j] else c[j] for j in range(len(c))]
    out = [(i, near(v), dist(v, c[near(v)])) for i, v in kept]
    per = collections.Counter()
    for _, j, d in out:
        per[j] += d
    return [(i, j, d, per[j], sum(per.values()), hashlib.sha256(",".join(map(str, c[j])).encode()).hexdigest()) for i, j, d in out]


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_tournament_is_the_nearest_with_ties_to_the_smaller():
    rng = np.random.default_rng(5)
    c, x = rng.integers(-3, 4, (7, 3)), rng.integers(-3, 4, (2000, 3))
    c[4] = c[2]
    want = ((x[:, None, :] - c[None]) ** 2).sum(2).argmin(1)  # the first of equals
    assert (tournament(x, *bisectors(c)) == want).all()


@pytest.mark.parametrize("n", [400, 5, 1])
def test_clusters_against_brute_force(spark, n):
    rng = np.random.default_rng(n)
    rows = [(i, rng.normal(size=64).round(3).tolist()) for i in range(n)]
    rows += [(1, rows[0][1]), (None, rng.normal(size=64).tolist())] if n > 5 else []
    assert rows_of(bisector_clusters(vectors(spark, rows).repartition(3))) == sorted(clusters(rows), key=str)


def test_cluster_edges(spark):
    one, nan = [0.5] * 64, float("nan")
    rows = [(1, one), (1, one), (2, one), (3, [-0.25] * 64), (4, None), (5, []), (6, [0.5] * 63), (7, [0.5] * 65), (8, [nan] + one[1:]),
            (9, [None] + one[1:]), (10, [float("-inf")] + one[1:]), (11, [131072.0] + one[1:]), (12, [-131072.0] + one[1:])]
    assert rows_of(bisector_clusters(vectors(spark, rows))) == sorted(clusters(rows), key=str)
    assert bisector_clusters(vectors(spark, [])).collect() == []
    assert bisector_clusters(vectors(spark, [(1, None), (2, [1.0])])).collect() == []
    huge = bisector_clusters(vectors(spark, [(1, [1e30] * 64), (2, one)])).collect()
    assert [(r.vec_id, r.inertia) for r in huge] == [(2, 0)]
