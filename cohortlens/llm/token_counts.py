"""Token counts through a digest cache.

The cache is a Parquet table (digest, tokenizer, n_tokens): digest is the
SHA-256 of the normalised content, tokenizer the SHA-256 of the tokenizer
file. Texts are joined to it by digest; only distinct misses are encoded,
and their counts are appended for the next run.

Normalisation takes white space off both ends (the tokenizer drops white
space, so counts do not change); null is the empty text.
"""

from __future__ import annotations

import hashlib
import os
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.llm.common import partitions_for, text_of, text_slices, words_of
from cohortlens.session import checkpoint_dir

SPACES = " \t\n\x0b\x0c\r"
CACHE_SCHEMA = "digest binary, tokenizer string, n_tokens long"
MISS_SCHEMA = "digest binary, packed binary"
# Distinct words whose counts a Python worker remembers; the memo is dropped when full.
MEMO_WORDS = 400_000


def tokenizer_digest(path: str) -> str:
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


def content_digest(text="text"):
    """The digest of a text as a native column expression."""
    return F.unhex(F.sha2(F.btrim(text_of(text), F.lit(SPACES)).cast("binary"), 256))


def _distinct_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One (digest, compressed text) row per distinct text of the partition,
    so a text with very many copies leaves a task once."""
    import zstandard

    z = zstandard.ZstdCompressor(level=1)
    strip, seen = SPACES.encode(), set()
    for b in text_slices(batches):
        keys, packed = [], []
        for t in b.column(0).cast(pa.binary()).to_pylist():
            t = t.strip(strip)
            k = hashlib.sha256(t).digest()
            if k not in seen:
                seen.add(k)
                keys.append(k)
                packed.append(z.compress(t))
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(packed, pa.binary())],
                                         names=["digest", "packed"])


class WordCounter:
    """Token counts of whole texts of a tokenizer whose pre-tokenizer cuts at
    white space and drops it: the count of a text is then the sum over its
    words, and each distinct word is encoded once. Texts that hold a special
    token's string with white space in it do not arise (none has any)."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.encode = Tokenizer.from_file(path).encode_batch
        self.memo: dict[str, int] = {}

    def counts(self, texts: pa.Array):
        import numpy as np

        words, row = words_of(texts)
        out = np.zeros(len(texts), np.int64)
        if len(words):
            d = words.dictionary_encode()
            distinct = d.dictionary.to_pylist()
            if len(self.memo) > MEMO_WORDS:
                self.memo.clear()
            miss = [w for w in distinct if w not in self.memo]
            for i in range(0, len(miss), 10_000):
                part = miss[i:i + 10_000]
                self.memo.update(zip(part, (len(e.ids) for e in self.encode(part, add_special_tokens=False))))
            table = np.fromiter((self.memo[w] for w in distinct), np.int64, len(distinct))
            out += np.bincount(row, weights=table[d.indices.to_numpy()], minlength=len(texts)).astype(np.int64)
        return out


def _encode(path: str, version: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        counter, z, seen = WordCounter(path), zstandard.ZstdDecompressor(), set()
        for b in batches:
            keys, texts, size = [], [], 0

            def flush():
                n = counter.counts(pa.array(texts, pa.binary()).cast(pa.string()))
                return pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.binary()), pa.array([version] * len(keys), pa.string()), pa.array(n)],
                    names=["digest", "tokenizer", "n_tokens"])

            for k, p in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if k in seen:
                    continue
                seen.add(k)
                t = z.decompress(p)
                keys.append(k)
                texts.append(t)
                size += len(t)
                if size > (4 << 20):
                    yield flush()
                    keys, texts, size = [], [], 0
            if keys:
                yield flush()
    return run


def read_cache(spark: SparkSession, path: str, version: str) -> DataFrame:
    """The stored counts of one tokenizer version; empty if there is no cache yet."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        return spark.createDataFrame([], CACHE_SCHEMA).select("digest", "n_tokens")
    return (spark.read.schema(CACHE_SCHEMA).parquet(path).where(F.col("tokenizer") == version)
            .groupBy("digest").agg(F.min("n_tokens").alias("n_tokens")))


def fill_cache(docs: DataFrame, tokenizer: str, cache: str) -> str:
    """Encode the distinct texts of ``docs`` that ``cache`` lacks and append
    their counts. Returns the tokenizer version."""
    spark = docs.sparkSession
    version = tokenizer_digest(tokenizer)
    found = docs.select(text_of().alias("text")).mapInArrow(_distinct_texts, MISS_SCHEMA)
    known = read_cache(spark, cache, version)
    misses = found.join(known, "digest", "left_anti").repartition(partitions_for(spark), "digest")
    misses.mapInArrow(_encode(tokenizer, version), CACHE_SCHEMA).write.mode("append").parquet(cache)
    return version


def token_counts(docs: DataFrame, tokenizer: str, cache: str | None = None, limit: int = 2048) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens and over_limit (n_tokens > limit) of
    every row of ``docs``.

    ``tokenizer`` is a word_bpe .json file whose pre-tokenizer drops white
    space; no begin, end or special tokens are added, special strings inside
    texts are handled as the library does by default. ``cache`` is a folder
    that all executors share (default: a new one under the checkpoint
    folder). Null and white-space texts have 0 tokens; repeated texts are
    encoded once; rows that share a doc_id keep their own counts. Empty
    input gives no rows.
    """
    spark = docs.sparkSession
    cache = cache or os.path.join(checkpoint_dir(spark), "token_counts", uuid.uuid4().hex)
    version = fill_cache(docs, tokenizer, cache)
    counts = read_cache(spark, cache, version)
    rows = docs.select("doc_id", F.octet_length(text_of()).cast("long").alias("n_bytes"),
                       content_digest().alias("digest"))
    return (rows.join(counts, "digest", "left")
            .select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")))
