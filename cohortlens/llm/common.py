"""Helpers shared by the training-data operators.

Words everywhere are runs of bytes outside space, tab, LF, VT, FF and CR.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.operators.materialize import materialize
from cohortlens.sources.tables import table_path

WORD = r"[^\x20\x09-\x0D]+"

# Text handled at a time inside a task; one longer text is a slice of its own.
SLICE_BYTES = 1 << 20

__all__ = ["WORD", "SLICE_BYTES", "documents", "text_of", "materialize", "text_slices", "words_of", "mix64",
           "hash_words", "utf8_buffer", "partitions_for", "give_back", "lean"]


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def text_of(c: str | Column = "text") -> Column:
    """The text, null read as empty."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c.cast("string"), F.lit(""))


def partitions_for(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def utf8_buffer(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string / binary array without nulls; zero copy."""
    if not (pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type)):
        width, bufs = np.int32, arr.buffers()
    else:
        width, bufs = np.int64, arr.buffers()
    off = np.frombuffer(bufs[1], dtype=width)[arr.offset:arr.offset + len(arr) + 1].astype(np.int64)
    data = np.frombuffer(bufs[2], dtype=np.uint8) if bufs[2] is not None and bufs[2].size else np.zeros(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def text_slices(batches: Iterator[pa.RecordBatch], text: str = "text",
                limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into pieces of about ``limit`` bytes of text, so the
    working memory of a task does not depend on the length of a batch."""
    for b in batches:
        if b.num_rows == 0:
            continue
        _, off = utf8_buffer(b.column(b.schema.get_field_index(text)))
        start = 0
        while start < b.num_rows:
            end = int(np.searchsorted(off, off[start] + limit, side="right")) - 1
            end = max(start + 1, min(end, b.num_rows))
            yield b.slice(start, end - start)
            start = end


def words_of(arr: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts, and for each word the index of its text."""
    parts = pc.ascii_split_whitespace(arr)
    flat = parts.flatten()
    row = pc.list_parent_indices(parts).to_numpy(zero_copy_only=False)
    full = pc.greater(pc.binary_length(flat), 0)
    keep = full.to_numpy(zero_copy_only=False)
    if keep.all():
        return flat, row
    return flat.filter(full), row[keep]


def give_back() -> None:
    """Return to the system what this worker holds and does not use. Workers
    are reused by later stages, and freed arrays would otherwise stay with
    them until the executor's memory is full."""
    import ctypes

    pa.default_memory_pool().release_unused()
    libc = ctypes.CDLL(None)
    if hasattr(libc, "mallopt"):  # glibc: large arrays always by mmap, so that freeing them frees memory
        libc.mallopt(-3, 1 << 18)
        libc.malloc_trim(0)


def lean(run):
    """The map function ``run``, giving memory back before and after its partition."""
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        yield from run(batches)
        give_back()
    return wrapped


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (multiply and xor-shift)."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> np.uint64(33))
        x = x * np.uint64(0xFF51AFD7ED558CCD)
        x = x ^ (x >> np.uint64(33))
        x = x * np.uint64(0xC4CEB9FE1A85EC53)
        return x ^ (x >> np.uint64(33))


PLACES = 4096


def hash_words(words: pa.Array) -> np.ndarray:
    """64-bit hash of each (non-empty) word: a sum over its bytes of a random
    number per byte value times one per place, finished by ``mix64``. Words of
    more than PLACES bytes are hashed by xxh3."""
    if not len(words):
        return np.zeros(0, np.uint64)
    buf, off = utf8_buffer(words)
    size = np.diff(off)
    byte = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    place = mix64(np.arange(1, PLACES + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)) | np.uint64(1)
    at = np.arange(len(buf), dtype=np.int64) - np.repeat(off[:-1], size)
    long = np.flatnonzero(size > PLACES)
    if len(long):
        at = np.minimum(at, PLACES - 1)
    with np.errstate(over="ignore"):
        h = mix64(np.add.reduceat(byte[buf] * place[at], off[:-1]) + size.astype(np.uint64))
    if len(long):
        import xxhash

        for i in long.tolist():
            h[i] = xxhash.xxh3_64_intdigest(buf[off[i]:off[i + 1]].tobytes())
    return h
