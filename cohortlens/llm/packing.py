"""Token ids packed into fixed-length sequences.

Texts are encoded, overlong ones are cut into parts without loss, and parts
are packed by best-fit-decreasing: longest first, each into the open sequence
with the least room that still holds it, found by a search down a segment
tree over capacities. Each sequence is a row of the id matrix, with the
cumulative lengths of its segments and positions that restart at each one.
"""

from __future__ import annotations

import base64
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import give_back, lean, text_of, text_slices

LENGTH = 2048
PAD_ID = 50_256  # free in the vocabulary; never inside a segment
GROUP_BYTES = 8 << 20  # of text that one task packs
PACKS = ("group int, pack int, n_tokens int, doc_ids array<bigint>, parts array<int>, cu_seqlens array<int>, "
         "input_ids binary, position_ids binary")


class TextEncoder:
    """Ids of whole texts, special strings read as ordinary text."""

    def __init__(self, ranks: str, pattern: str):
        import tiktoken

        with open(ranks, "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.encode = tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=table, special_tokens={}).encode_ordinary

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, offsets)."""
        parts = [np.array(self.encode(t), np.uint16) for t in texts.to_pylist()]
        return np.concatenate([np.zeros(0, np.uint16), *parts]), np.cumsum([0, *(len(p) for p in parts)])


def _parts(ranks: str, pattern: str, length: int):
    """(doc_id, part, ids): the ids of each text in parts of at most ``length``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = TextEncoder(ranks, pattern)
        for b in text_slices(batches):
            ids, off = enc.ids(b.column(1))
            n = np.diff(off)
            k = -(-n // length)
            row = np.repeat(np.arange(len(n)), k)
            part = np.arange(len(row)) - np.repeat(np.cumsum(k) - k, k)
            start = off[:-1][row] + part * length
            edges = np.append(start, off[-1]) * 2
            blobs = pa.Array.from_buffers(pa.large_binary(), len(row), [None, pa.py_buffer(edges.astype(np.int64).tobytes()),
                                                                        pa.py_buffer(ids.astype("<u2").tobytes())])
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(row)), pa.array(part.astype(np.int32)), blobs.cast(pa.binary())],
                                             names=["doc_id", "part", "ids"])
    return lean(run)


class CapacityTree:
    """How many open sequences have each remaining capacity, as a segment tree
    of counts; finds the least capacity that holds a length."""

    def __init__(self, length: int):
        self.leaves = 1 << length.bit_length()
        self.count = [0] * (2 * self.leaves)

    def add(self, capacity: int, by: int) -> None:
        i = capacity + self.leaves
        while i:
            self.count[i] += by
            i >>= 1

    def least(self, length: int) -> int:
        """The least capacity >= length that some sequence has, or -1."""
        i = length + self.leaves
        if self.count[i]:
            return length
        while i > 1:  # climb until a right neighbour has something, then go down its left side
            if not i & 1 and self.count[i + 1]:
                i += 1
                while i < self.leaves:
                    i = 2 * i if self.count[2 * i] else 2 * i + 1
                return i - self.leaves
            i >>= 1
        return -1


def best_fit_decreasing(sizes: list[int], length: int) -> list[list[int]]:
    """Sequences as lists of indices into ``sizes`` (each 1 .. length)."""
    tree, open_, packs = CapacityTree(length), {}, []
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        c = tree.least(sizes[i])
        if c < 0:
            packs.append([i])
            k, c = len(packs) - 1, length
        else:
            k = open_[c].pop()
            tree.add(c, -1)
            packs[k].append(i)
        c -= sizes[i]
        if c:
            open_.setdefault(c, []).append(k)
            tree.add(c, 1)
    return packs


def _pack(length: int):
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "part", "ids"], kind="stable", na_position="last")
        docs, parts, blobs = pdf["doc_id"].tolist(), pdf["part"].tolist(), pdf["ids"].tolist()
        rows = []
        for k, members in enumerate(best_fit_decreasing([len(x) // 2 for x in blobs], length)):
            n = [len(blobs[i]) // 2 for i in members]
            total = sum(n)
            ids = b"".join(blobs[i] for i in members) + np.full(length - total, PAD_ID, "<u2").tobytes()
            pos = np.concatenate([*[np.arange(x, dtype="<u2") for x in n], np.zeros(length - total, "<u2")])
            rows.append((key[0], k, total, [None if pd.isna(docs[i]) else int(docs[i]) for i in members],
                         [parts[i] for i in members], [0, *np.cumsum(n).tolist()], ids, pos.tobytes()))
        give_back()
        return pd.DataFrame(rows, columns=["group", "pack", "n_tokens", "doc_ids", "parts", "cu_seqlens", "input_ids", "position_ids"])
    return run


def pack_documents(docs: DataFrame, ranks: str, pattern: str, length: int = LENGTH) -> DataFrame:
    """One row per packed sequence: group and pack (its name), n_tokens,
    doc_ids and parts of its segments, cu_seqlens (0, end of each segment),
    input_ids (``length`` little-endian uint16, padded with PAD_ID) and
    position_ids (restarting at each segment; 0 in the padding).

    ``ranks`` is a .tiktoken file of at most 65 536 ids whose pattern is
    ``pattern``. A text of more than ``length`` ids is cut into parts; every
    id of every text is in exactly one sequence. Null and empty texts have
    no ids and are in none. Repeated rows are packed each; a null doc_id
    stays null. Other columns are not read. Empty input gives no rows.
    """
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    total = d.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0  # one number
    groups = max(1, math.ceil(total / GROUP_BYTES))
    parts = d.mapInArrow(_parts(ranks, pattern, length), "doc_id long, part int, ids binary")
    keyed = parts.withColumn("group", F.pmod(F.xxhash64("doc_id", "part", "ids"), F.lit(groups)).cast("int"))
    return keyed.groupBy("group").applyInPandas(_pack(length), PACKS)


def segments(packs: DataFrame) -> DataFrame:
    """(doc_id, part, ids) back from packed rows: the round trip."""
    z = packs.select("input_ids", F.posexplode(F.arrays_zip("doc_ids", "parts")).alias("i", "s"), "cu_seqlens")
    start, end = F.get("cu_seqlens", F.col("i")), F.get("cu_seqlens", F.col("i") + 1)
    return z.select(F.col("s.doc_ids").alias("doc_id"), F.col("s.parts").alias("part"),
                    F.substring("input_ids", start * 2 + 1, (end - start) * 2).alias("ids"))


def write_packs(packs: DataFrame, path: str) -> None:
    """The id matrix, segment lengths and positions as Parquet files."""
    packs.write.mode("overwrite").parquet(path)
