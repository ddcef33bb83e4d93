"""N-gram Jaccard self-join with a token-group matrix.

A document is the set of its distinct word shingles. Similar sets share
tokens early in any common order of tokens, so each set shows a short prefix
of its rarest tokens. Sets are partitioned into groups of similar ones, the
token-group matrix holds the union of each group's prefixes, and a set opens
only groups whose union has enough of its own prefix; opened groups are
compared exactly. Equal sets are one class throughout, and links inside one
component are not looked for again, so a group of many copies costs one pass
over it, not one comparison per pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from cohortlens.llm.common import give_back, hash_words, lean, materialize, mix64, partitions_for, text_of, text_slices, words_of
from cohortlens.llm.components import components

LINK_TOKENS, LINK_PART = 3, 8  # two linked sets share 3 + n / 8 tokens of their prefixes
BLOCK = 256  # sets compared in one task at a time
HOT_SHARE = 5e-4  # tokens in so large a share of the documents come last in the order
HOT_LEAST = 3
CHUNK_TOKENS = 2_000_000  # tokens after which a task reports its frequent ones
FILTER_BYTES = 64 << 20  # filter of candidate classes, at most
SEGMENTS = 64


def smallest_size(percent: int) -> int:
    """Sets smaller than this are linked to equal sets only."""
    return -(-percent // (100 - percent))


def prefix_length(n: int, percent: int) -> int:
    """Linked sets have at least percent * n / 100 tokens in common, so the
    first l of these, in any order of tokens, lie in the first
    n - percent * n / 100 + l of each; l = LINK_TOKENS + n / LINK_PART. A
    longer prefix than needed for one token in common lets chance passages,
    which share few tokens, be told from similar texts early."""
    return min(n, n - -(-percent * n // 100) + LINK_TOKENS + n // LINK_PART)


def needed(n, percent: int):
    """Column: prefix tokens that a set of ``n`` shares with any set it links to,
    which may have percent * n / 100 tokens only."""
    return F.lit(LINK_TOKENS) + F.floor(F.ceil(n * percent / 100) / LINK_PART)


def shingle_sets(texts: pa.Array, words: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text: ``words`` words in a row,
    A-Z lower-cased; with fewer words the whole sequence is one."""
    w, row = words_of(pc.ascii_lower(texts))
    h = hash_words(w)
    n = len(texts)
    count = np.bincount(row, minlength=n)
    first = np.cumsum(count) - count
    out = [np.zeros(0, np.uint64)] * n
    with np.errstate(over="ignore"):
        full = np.zeros(0, np.uint64)
        if len(h) >= words:
            m = len(h) - words + 1
            full = mix64(h[:m] + np.uint64(words))
            for k in range(1, words):
                full = mix64(full * np.uint64(0x9E3779B97F4A7C15) + h[k:k + m])
        for i in np.flatnonzero(count):
            a, c = first[i], count[i]
            if c >= words:
                s = np.sort(full[a:a + c - words + 1])
                out[i] = s[np.append(True, s[1:] != s[:-1])]
            else:
                x = mix64(h[a:a + 1] + np.uint64(c) + np.uint64(1 << 40))
                for k in range(1, c):
                    x = mix64(x * np.uint64(0x9E3779B97F4A7C15) + h[a + k:a + k + 1])
                out[i] = x
    return out


def class_id(s: np.ndarray) -> int:
    """64-bit identity of a set."""
    import xxhash

    return xxhash.xxh3_64_intdigest(s.tobytes(), seed=len(s)) - (1 << 63)


def _classes(words: int):
    """(0, doc_id, n, cid, null) per row, and (1, null, docs, token, count) for
    tokens that are frequent in a stretch of the partition."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, seen = [], 0, set()

        def frequent() -> pa.RecordBatch:
            tok, c = np.unique(np.concatenate(held), return_counts=True)
            hot = c >= max(HOT_LEAST, int(HOT_SHARE * len(held)))
            tok, c = tok[hot].view(np.int64), c[hot]
            k = len(tok)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.ones(k, np.int32)), pa.nulls(k, pa.int64()), pa.array(c.astype(np.int64)), pa.array(tok)], names=names)

        names = ["kind", "doc_id", "n", "cid"]
        for b in text_slices(batches):
            sets = shingle_sets(b.column(1), words)
            cids = [class_id(s) if len(s) else None for s in sets]
            for s, c in zip(sets, cids):
                if c is not None and c not in seen:
                    seen.add(c)
                    held.append(s)
                    size += len(s)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.zeros(len(sets), np.int32)), b.column(0), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array(cids, pa.int64())], names=names)
            if size > CHUNK_TOKENS:
                yield frequent()
                held, size = [], 0
        if held:
            yield frequent()
    return lean(run)


def _prefixes(words: int, percent: int, hot):
    """(token, cid) for the prefix tokens of each class of the partition."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot_tok, hot_cnt = (np.frombuffer(x, np.uint64) for x in hot.value)
        least, seen = smallest_size(percent), set()
        for b in text_slices(batches):
            toks, cids, lens = [], [], []
            for s in shingle_sets(b.column(0), words):
                n = len(s)
                if n < least:
                    continue
                c = class_id(s)
                if c in seen:
                    continue
                seen.add(c)
                p = prefix_length(n, percent)
                if len(hot_tok):
                    at = np.minimum(np.searchsorted(hot_tok, s), len(hot_tok) - 1)
                    freq = np.where(hot_tok[at] == s, hot_cnt[at], np.uint64(0))
                    if freq.any():
                        s = s[np.argsort(freq, kind="stable")]
                toks.append(s[:p])
                cids.append(c)
                lens.append(p)
            if toks:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(toks).view(np.int64)),
                                                  pa.array(np.repeat(np.array(cids, np.int64), lens))], names=["token", "cid"])
    return lean(run)


PART_ROWS = 1_000_000  # rows of one token that are held before they leave in parts


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (token, cid) in order of both: the distinct rows of tokens with two
    or more classes, and how many those are (of a token that leaves in parts,
    how many of the part)."""
    tok, cid = np.zeros(0, np.int64), np.zeros(0, np.int64)
    begun = None  # the token whose first part has left: what follows of it is shared, even one row

    def out(t, c):
        starts = np.flatnonzero(np.append(True, t[1:] != t[:-1])) if len(t) else np.zeros(0, np.int64)
        n = np.repeat(np.diff(np.append(starts, len(t))), np.diff(np.append(starts, len(t))))
        if begun is not None:
            n[t == begun] = PART_ROWS
        n = np.minimum(n, PART_ROWS)
        m = n > 1
        return pa.RecordBatch.from_arrays([pa.array(t[m]), pa.array(c[m]), pa.array(n[m].astype(np.int64))], names=["token", "cid", "df"])

    for b in batches:
        tok = np.concatenate([tok, b.column(0).to_numpy()])
        cid = np.concatenate([cid, b.column(1).to_numpy()])
        if not len(tok):
            continue
        keep = np.append(True, (tok[1:] != tok[:-1]) | (cid[1:] != cid[:-1]))
        tok, cid = tok[keep], cid[keep]
        cut, part = int(np.searchsorted(tok, tok[-1], side="left")), False  # the last token may go on
        if cut == 0 and len(tok) > PART_ROWS:
            cut, part = len(tok) - 1, True  # a very frequent one leaves in parts; its last row tells repeats
        if cut:
            yield out(tok[:cut], cid[:cut])
            begun = tok[0] if part else begun
            tok, cid = tok[cut:], cid[cut:]
    if len(tok):
        yield out(tok, cid)


def _segment_bits(size: int):
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        bits = np.zeros(size * 8, bool)
        bits[_bit(pdf["cid"].to_numpy(), size)] = True
        return pd.DataFrame({"seg": [key[0]], "bits": [np.packbits(bits, bitorder="little").tobytes()]})
    return run


def _bit(cids: np.ndarray, size: int) -> np.ndarray:
    return (mix64(cids.view(np.uint64)) % np.uint64(size * 8)).astype(np.int64)


def _sets(words: int, percent: int, size: int, wanted):
    """(cid, tokens) of the classes that the filter holds."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap, least, seen = np.frombuffer(wanted.value, np.uint8), smallest_size(percent), set()
        for b in text_slices(batches):
            cids, blobs = [], []
            for s in shingle_sets(b.column(0), words):
                if len(s) < least:
                    continue
                c = class_id(s)
                if c in seen:
                    continue
                k = np.array([c], np.int64)
                at = int(_bit(k, size)[0])
                if bitmap[(c & (SEGMENTS - 1)) * size + (at >> 3)] >> (at & 7) & 1:
                    seen.add(c)
                    cids.append(c)
                    blobs.append(s.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(cids, pa.int64()), pa.array(blobs, pa.binary())], names=["cid", "tokens"])
    return lean(run)


def _all_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(token, cid) of all tokens of the sets."""
    for b in batches:
        for part in (b.slice(i, 1024) for i in range(0, b.num_rows, 1024)):
            toks = [np.frombuffer(x, np.int64) for x in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(toks)), part.column(0).take(
                pa.array(np.repeat(np.arange(len(toks)), [len(t) for t in toks])))], names=["token", "cid"])


def overlaps(sets: list[np.ndarray], columns: int = 4096) -> np.ndarray:
    """Sizes of all intersections, as a product of 0 / 1 matrices taken a few
    thousand tokens at a time."""
    n = len(sets)
    if n == 2:
        k = len(np.intersect1d(*sets, assume_unique=True))
        return np.array([[len(sets[0]), k], [k, len(sets[1])]])
    ids = np.unique(np.concatenate(sets), return_inverse=True)[1]
    doc = np.repeat(np.arange(n), [len(s) for s in sets])
    df = np.bincount(ids)
    renum = np.cumsum(df > 1) - 1
    keep = df[ids] > 1
    ids, doc = renum[ids[keep]], doc[keep]
    order = np.argsort(ids, kind="stable")
    ids, doc = ids[order], doc[order]
    total = np.zeros((n, n), np.int64)
    last = int(ids[-1]) + 1 if len(ids) else 0
    edges = np.searchsorted(ids, np.arange(0, last + columns, columns))
    for k, (a, e) in enumerate(zip(edges[:-1], edges[1:])):
        m = np.zeros((n, columns), np.float32)
        m[doc[a:e], ids[a:e] - k * columns] = 1
        total += np.rint(m @ m.T).astype(np.int64)
    np.fill_diagonal(total, [len(s) for s in sets])
    return total


def _link(percent: int):
    """Compare the sets of one block; (a, b) edges that span its components."""
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.drop_duplicates("cid").sort_values("cid")
        cids = pdf["cid"].tolist()
        a, b = [], []
        if len(cids) > 1:
            sets = [np.frombuffer(x, np.uint64) for x in pdf["tokens"]]
            o = overlaps(sets)
            size = np.array([len(s) for s in sets])
            near = 100 * o >= percent * (size[:, None] + size[None, :] - o)
            left = np.ones(len(cids), bool)
            for i in range(len(cids)):
                if not left[i]:
                    continue
                left[i] = False
                todo = [i]
                while todo:
                    for j in np.flatnonzero(near[todo.pop()] & left):
                        left[j] = False
                        a.append(cids[i])
                        b.append(cids[j])
                        todo.append(int(j))
        return pd.DataFrame({"a": np.array(a, np.int64), "b": np.array(b, np.int64)})
    return run


def _compare(blocks: DataFrame, sets: DataFrame, percent: int, name: str) -> DataFrame:
    """Edges between the sets of each block (block, cid)."""
    return materialize(blocks.join(sets, "cid").groupBy("block").applyInPandas(_link(percent), "a long, b long"), name)


def jaccard_links(docs: DataFrame, words: int = 4, percent: int = 85) -> tuple[DataFrame, DataFrame]:
    """(classes, edges): classes has doc_id, n_shingles and cid (the class of
    equal sets; null for an empty set) per row of ``docs``; edges (a, b) span
    the components of the links between classes."""
    spark = docs.sparkSession
    parts = partitions_for(spark)
    text = docs.select(text_of().alias("text"))
    first = materialize(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
                        .mapInArrow(_classes(words), "kind int, doc_id long, n long, cid long"), "jj_classes")
    classes = first.where("kind = 0").select("doc_id", F.col("n").alias("n_shingles"), "cid")
    total = classes.count()
    # Tokens in HOT_SHARE of all documents: at most (mean set size / HOT_SHARE) of them.
    hot = (first.where("kind = 1").groupBy("cid").agg(F.sum("n").alias("n"))
           .where(F.col("n") >= max(HOT_LEAST, int(HOT_SHARE * total))).collect())
    table = np.array(sorted((r[0] & ((1 << 64) - 1), r[1]) for r in hot), np.uint64).reshape(-1, 2)
    hot_b = spark.sparkContext.broadcast((table[:, 0].tobytes(), table[:, 1].tobytes()))

    shared = (text.mapInArrow(_prefixes(words, percent, hot_b), "token long, cid long")
              .repartition(parts, "token").sortWithinPartitions("token", "cid")
              .mapInArrow(_shared, "token long, cid long, df long"))
    shared = materialize(shared, "jj_shared")
    stats = shared.groupBy("cid").agg(
        F.count(F.lit(1)).alias("k"), F.max(F.struct("df", "token")).getField("token").alias("key1"),
        F.min(F.xxhash64("token")).alias("key2"))
    sizes = classes.where(F.col("cid").isNotNull()).groupBy("cid").agg(F.max("n_shingles").alias("n"))
    stats = stats.join(sizes, "cid").withColumn("need", needed(F.col("n"), percent))
    cand = materialize(stats.where(F.col("k") >= F.col("need")).drop("k"), "jj_candidates")

    size = min(FILTER_BYTES // SEGMENTS, max(1 << 10, 2 * cand.count() // SEGMENTS))
    bitmap = bytearray(SEGMENTS * size)
    segs = cand.withColumn("seg", F.col("cid").bitwiseAND(SEGMENTS - 1)).groupBy("seg").applyInPandas(_segment_bits(size), "seg long, bits binary")
    for seg, bits in segs.collect():  # FILTER_BYTES at most
        bitmap[seg * size:(seg + 1) * size] = bits
    wanted = spark.sparkContext.broadcast(bytes(bitmap))
    sets = text.mapInArrow(_sets(words, percent, size, wanted), "cid long, tokens binary").join(cand.select("cid"), "cid", "left_semi")
    sets = materialize(sets.dropDuplicates(["cid"]), "jj_sets")

    # Groups of similar classes, by their most shared token and by a minimum
    # hash; large ones in blocks that have the group's first class in common.
    edges = None
    for key in ("key1", "key2"):
        rows = cand.select(F.col(key).alias("key"), "cid")
        group = rows.groupBy("key").agg(F.count(F.lit(1)).alias("c"), F.min("cid").alias("lead")).where("c > 1")
        rows = rows.join(group, "key").withColumn("nb", F.ceil(F.col("c") / BLOCK))
        rows = rows.withColumn("block", F.xxhash64(F.lit(key), "key", F.pmod(F.xxhash64("cid"), F.col("nb"))))
        lead = group.withColumn("nb", F.ceil(F.col("c") / BLOCK)).where("nb > 1").withColumn("s", F.explode(F.sequence(F.lit(0).cast("long"), F.col("nb") - 1)))
        lead = lead.select(F.xxhash64(F.lit(key), "key", "s").alias("block"), F.col("lead").alias("cid"))
        rows = materialize(rows.select("block", "cid"), "jj_blocks")
        if key == "key1":
            home = rows.withColumnRenamed("block", "grp")
        e = _compare(rows.union(lead), sets, percent, "jj_links")
        edges = e if edges is None else edges.union(e)

    # The token-group matrix over the groups, and who must open which: a set of
    # the smaller component asks groups that hold a member of a larger one (by
    # size, then id), so a large component is asked, but does not ask. Sets of
    # one group have been compared.
    comp = components(edges).toDF("cid", "comp")
    comp = comp.join(comp.groupBy("comp").agg(F.count(F.lit(1)).alias("sz")), "comp")
    # Among the candidates the order of tokens is made exact: by how many of
    # them hold a token. A passage in many of them comes last, and of a set
    # that shares nothing else it is not in the prefix.
    own = (sets.mapInArrow(lean(_all_tokens), "token long, cid long").repartition(parts, "token")
           .sortWithinPartitions("token", "cid").mapInArrow(lean(_shared), "token long, cid long, df long"))
    own = own.join(cand.select("cid", "need", "n"), "cid")
    by_set = Window.partitionBy("cid")
    length = F.least(F.col("n"), F.col("n") - F.ceil(F.col("n") * percent / 100) + LINK_TOKENS + F.floor(F.col("n") / LINK_PART))
    # Tokens of one set only come first; what is left of the prefix goes to the shared ones.
    own = (own.withColumn("c", F.count(F.lit(1)).over(by_set)).withColumn("r", F.row_number().over(by_set.orderBy("df", "token")))
           .where(F.col("r") <= length - (F.col("n") - F.col("c"))).select("token", "cid", "need"))
    m = (own.join(home, "cid", "left").join(comp, "cid", "left")
         .select("token", "cid", "need", F.coalesce("grp", "cid").alias("grp"), F.coalesce("comp", "cid").alias("comp"),
                 F.coalesce("sz", F.lit(1)).alias("sz")))
    m = materialize(m, "jj_matrix")
    several = m.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("token")
    m = materialize(m.join(several, "token"), "jj_matrix2")
    enough = m.groupBy("cid").agg(F.count(F.lit(1)).alias("k"), F.first("need").alias("need")).where("k >= need").select("cid", "k")
    m = materialize(m.join(enough, "cid"), "jj_matrix3")
    matrix = materialize(m.groupBy("token", F.col("grp").alias("g")).agg(F.max(F.struct("sz", "comp")).alias("top")), "jj_groups")
    # A group that shares ``need`` of a set's k tokens has one of its k - need + 1
    # rarest: only these look for groups, the rest is counted for those found.
    spread = matrix.groupBy("token").agg(F.count(F.lit(1)).alias("groups"))
    m = m.join(spread, "token").withColumn("r", F.row_number().over(by_set.orderBy("groups", "token")))
    m = materialize(m, "jj_ranked")
    larger = (F.col("top.sz") > F.col("sz")) | ((F.col("top.sz") == F.col("sz")) & (F.col("top.comp") > F.col("comp")))
    found = (m.where((F.col("groups") > 1) & (F.col("r") <= F.col("k") - F.col("need") + 1)).join(matrix, "token")
             .where((F.col("g") != F.col("grp")) & larger).select("cid", "g", "need").distinct())
    opened = (found.join(m.select("cid", "token", "sz", "comp"), "cid").join(matrix, ["token", "g"]).where(larger)
              .groupBy("cid", "g").agg(F.count(F.lit(1)).alias("k"), F.first("need").alias("need"))
              .where(F.col("k") >= F.col("need")).select("cid", "g"))
    opened = materialize(opened, "jj_opened")
    chunks = opened.groupBy("g").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("nq"))
    asked = opened.join(chunks, "g").select(F.xxhash64("g", F.pmod(F.xxhash64("cid"), F.col("nq"))).alias("block"), "cid")
    members = cand.select("cid").join(home, "cid", "left").select("cid", F.coalesce("grp", "cid").alias("g")).join(chunks, "g")
    members = members.withColumn("s", F.explode(F.sequence(F.lit(0).cast("long"), F.col("nq") - 1)))
    members = members.select(F.xxhash64("g", "s").alias("block"), "cid")
    more = _compare(asked.union(members), sets, percent, "jj_opened_links")
    return classes, edges.union(more)


def jaccard_join(docs: DataFrame, words: int = 4, percent: int = 85) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles and component_id, the smallest
    doc_id that links reach.

    Two rows link when their shingle sets have a Jaccard similarity of
    ``percent`` / 100 or more; equal non-empty sets always do. A null, empty
    or white-space text has an empty set and is linked with nothing. Rows
    that share a doc_id are compared like any others. A null doc_id is never
    the smallest. Other columns are not read. Empty input gives no rows.
    """
    rows = _rooted(docs, words, percent)
    names = rows.where(F.col("root").isNotNull()).groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return (rows.join(names, "root", "left")
            .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")))


def _rooted(docs: DataFrame, words: int, percent: int) -> DataFrame:
    classes, edges = jaccard_links(docs, words, percent)
    root = components(edges).toDF("cid", "root")
    return classes.join(root, "cid", "left").withColumn("root", F.coalesce("root", "cid"))


def _attach_class(names: list[str], words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches, "_j_text"):
            sets = shingle_sets(b.column(b.schema.get_field_index("_j_text")), words)
            cid = pa.array([class_id(s) if len(s) else None for s in sets], pa.int64())
            yield pa.RecordBatch.from_arrays([*[b.column(i) for i in range(len(names))], cid], names=[*names, "_j_cid"])
    return lean(run)


def keep_one(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One row of each component of ``docs``, all columns unchanged: a row with
    its smallest doc_id (null last). Rows without words are in no component
    and stay, one for each doc_id."""
    rows = _rooted(docs, words, percent).where(F.col("root").isNotNull())
    first = rows.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "cid")).alias("f"))
    keep = materialize(first.select(F.col("f.cid").alias("_j_key"), F.col("f.doc_id").alias("_j_id")), "jj_keep")
    schema = T.StructType([*docs.schema.fields, T.StructField("_j_cid", T.LongType())])
    d = docs.withColumn("_j_text", text_of()).mapInArrow(_attach_class(docs.columns, words), schema)
    d = d.withColumn("_j_key", F.coalesce("_j_cid", F.xxhash64("doc_id")))
    chosen = F.col("_j_cid").isNull() | F.col("doc_id").cast("long").eqNullSafe(F.col("_j_id"))
    matched = F.col("_j_cid").isNull() | F.col("_j_found")
    j = d.join(keep.withColumn("_j_found", F.lit(True)), "_j_key", "left").where(matched & chosen)
    return j.dropDuplicates(["_j_key"]).select(*docs.columns)
