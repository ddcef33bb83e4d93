"""Quality classifier from weak labels.

Overlapping heuristic labellers vote on every document; their accuracies come
from expectation-maximisation over the vote patterns of all documents. The
posterior labels of a bounded sample train a hashed linear scorer on byte
trigrams and word repetitions, which then scores every whole text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.llm.common import lean, text_of, text_slices, utf8_buffer, words_of
from cohortlens.llm.quality_rules import STATS, text_stats
from cohortlens.llm.weak_labels import attach_posterior, fit, pattern_counts, vote

DIMENSIONS = 1 << 16
SAMPLE_ROWS = 6000  # documents that train the scorer, at most; those of the smallest hashes
STEPS = 150
_REPEAT, _NEW, _FLAT = DIMENSIONS, DIMENSIONS + 1, DIMENSIONS + 2  # beside the trigrams
SIZE = DIMENSIONS + 3


def _grams(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed byte trigrams of the texts (letters as they are), and their rows;
    trigrams across two texts are left out."""
    if len(buf) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    code = buf[:-2].astype(np.uint32) << 16 | buf[1:-1].astype(np.uint32) << 8 | buf[2:]
    row = np.repeat(np.arange(len(off) - 1), np.diff(off))
    same = row[:-2] == row[2:]
    with np.errstate(over="ignore"):
        hashed = (code * np.uint32(2654435761)) >> np.uint32(16)
    return (hashed % DIMENSIONS)[same].astype(np.int64), row[:-2][same]


def _same_word(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row of each word, whether it equals the word two or one before)."""
    words, row = words_of(texts)
    ids = words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    rep = np.zeros(len(ids), bool)
    for k in (1, 2):
        if len(ids) > k:
            rep[k:] |= (ids[k:] == ids[:-k]) & (row[k:] == row[:-k])
    return row, rep


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, feature, value) triples: relative frequencies, by row and feature."""
    n = len(texts)
    buf, off = utf8_buffer(texts)
    gram, grow = _grams(buf, off)
    wrow, rep = _same_word(texts)
    key, c = np.unique(grow * SIZE + gram, return_counts=True)
    row, feat = key // SIZE, key % SIZE
    val = c / np.maximum(1, np.bincount(grow, minlength=n))[row]
    words = np.bincount(wrow, minlength=n)
    share = np.bincount(wrow, weights=rep, minlength=n) / np.maximum(1, words)
    every = np.arange(n)
    return (np.concatenate([row, every, every, every]),
            np.concatenate([feat, np.full(n, _REPEAT), np.full(n, _NEW), np.full(n, _FLAT)]),
            np.concatenate([val, share, 1 - share, np.ones(n)]))


def scores(texts: pa.Array, weights: np.ndarray) -> np.ndarray:
    """Linear scores of whole texts, without building the features."""
    n = len(texts)
    buf, off = utf8_buffer(texts)
    gram, grow = _grams(buf, off)
    total = np.bincount(grow, weights=weights[gram], minlength=n) / np.maximum(1, np.bincount(grow, minlength=n))
    wrow, rep = _same_word(texts)
    share = np.bincount(wrow, weights=rep, minlength=n) / np.maximum(1, np.bincount(wrow, minlength=n))
    return total + share * weights[_REPEAT] + (1 - share) * weights[_NEW] + weights[_FLAT]


def train(rows: np.ndarray, feats: np.ndarray, vals: np.ndarray, target: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """Logistic regression on soft targets by full-batch Adagrad; a target
    weighs the more, the surer it is. Features are scaled by their root mean
    square."""
    n = len(target)
    scale = np.sqrt(np.bincount(feats, weights=vals ** 2, minlength=SIZE) / max(1, n)) + 1e-4
    x = vals / scale[feats]
    weight = np.abs(2 * target - 1)
    w, seen = np.zeros(SIZE), np.full(SIZE, 1e-8)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(rows, weights=x * w[feats], minlength=n), -30, 30)))
        g = np.bincount(feats, weights=x * (weight * (p - target))[rows], minlength=SIZE) / max(1, n) + 1e-4 * w
        seen += g * g
        w -= 0.1 * g / np.sqrt(seen)
    return w / scale


def _attach_counts(names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches, "_c_text"):
            c = text_stats(b.column(b.schema.get_field_index("_c_text")))
            yield pa.RecordBatch.from_arrays([*[b.column(i) for i in range(len(names))], *[pa.array(c[x]) for x in STATS]],
                                             names=[*names, *[f"_c_{x}" for x in STATS]])
    return lean(run)


def attach_counts(docs: DataFrame) -> DataFrame:
    """``docs`` with the labellers' STATS as ``_c_<name>``; a map, no shuffle."""
    schema = T.StructType([*docs.schema.fields, *[T.StructField(f"_c_{c}", T.LongType()) for c in STATS]])
    return docs.withColumn("_c_text", text_of()).mapInArrow(_attach_counts(docs.columns), schema)


def labellers() -> list[Column]:
    """Overlapping votes: good or bad outside a band, abstention inside and in
    texts of under 20 words, where shares say little. The bands are strict;
    what a lone bad vote is worth, the fit decides."""
    n = F.col("_c_n_words")
    words = F.when(n >= 20, n.cast("double"))
    chars = F.when(n >= 20, F.col("_c_word_chars").cast("double"))
    band = lambda x, good, bad: vote(x > bad, x < good)
    share = lambda c: F.col(f"_c_{c}") / words
    return [
        band(share("n_symbols"), 0.05, 0.25),
        band(F.col("_c_n_marks") / chars, 0.1, 0.2),
        band(share("n_upper"), 0.8, 2.0),
        band(share("n_near_repeats"), 0.05, 0.15),
        band(share("n_top_word"), 0.12, 0.2),
        band(share("n_repeat_words"), 0.05, 0.1),
        vote((n < 500) & (share("n_distinct") < 0.3), (n < 500) & (share("n_distinct") > 0.5)),
    ]


def _score(names: list[str], weights):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = np.frombuffer(weights.value, np.float64)
        for b in text_slices(batches, "_c_text"):
            s = scores(b.column(b.schema.get_field_index("_c_text")), w)
            p = 1 / (1 + np.exp(-np.clip(s, -30, 30)))
            yield pa.RecordBatch.from_arrays([*[b.column(i) for i in range(len(names))], pa.array(p)], names=[*names, "score"])
    return lean(run)


def fit_scorer(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> tuple[np.ndarray, dict[int, float]]:
    """(weights, posterior per vote pattern). The patterns of all documents are
    counted; only ``sample_rows`` texts, those with the smallest hashes,
    reach the driver, as vote posteriors and hashed features."""
    votes = labellers()
    counts = pattern_counts(attach_counts(docs.select("text")), votes)
    post, _ = fit(counts, len(votes))
    # A hash bound lets a little more than the sample through, so that few texts
    # meet in the task that picks the smallest hashes.
    share = min(1.0, 1.3 * (sample_rows + 100) / max(1, sum(counts.values())))
    h = F.xxhash64("doc_id", text_of())
    few = docs.select("doc_id", "text", h.alias("_h")).where(F.pmod("_h", F.lit(1 << 31)) < int(share * (1 << 31)) + 1)
    sample = few.orderBy(F.pmod("_h", F.lit(1 << 31)), "_h").limit(sample_rows).drop("_h")
    sample = attach_posterior(attach_counts(sample), votes, post)

    def triples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches):
            row, feat, val = features(b.column(0))
            order = np.argsort(row, kind="stable")
            cut = np.searchsorted(row[order], np.arange(b.num_rows + 1))
            f, v = feat[order].astype(np.int32), val[order].astype(np.float32)
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array([f[a:e].tobytes() for a, e in zip(cut[:-1], cut[1:])], pa.binary()),
                                              pa.array([v[a:e].tobytes() for a, e in zip(cut[:-1], cut[1:])], pa.binary())],
                                             names=["posterior", "feats", "vals"])

    got = (sample.select(text_of().alias("text"), "posterior")
           .mapInArrow(triples, "posterior double, feats binary, vals binary").collect())
    if not got:
        return np.zeros(SIZE), post
    f = [np.frombuffer(r[1], np.int32) for r in got]
    rows = np.repeat(np.arange(len(got)), [len(x) for x in f])
    return train(rows, np.concatenate(f), np.concatenate([np.frombuffer(r[2], np.float32) for r in got]).astype(float),
                 np.array([r[0] for r in got])), post


def classify_quality(docs: DataFrame, threshold: float = 0.5, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Per row of ``docs``: doc_id, posterior (of the labellers), score (of the
    linear scorer, 0 to 1) and kept (score >= threshold).

    A null or empty text is scored by the constant alone, and its posterior is
    that of all labellers abstaining. Equal texts get equal scores; rows that
    share a doc_id are scored each; other columns are not read. Reruns agree
    up to the order of floating-point sums. Empty input gives no rows.
    """
    weights, post = fit_scorer(docs, sample_rows)
    w = docs.sparkSession.sparkContext.broadcast(weights.tobytes())
    d = attach_counts(docs.select("doc_id", "text"))
    names = d.columns
    schema = T.StructType([*d.schema.fields, T.StructField("score", T.DoubleType())])
    d = d.withColumn("_c_text", text_of()).mapInArrow(_score(names, w), schema)
    d = attach_posterior(d.drop("text"), labellers(), post)
    return d.select("doc_id", "posterior", "score", (F.col("score") >= threshold).alias("kept"))
