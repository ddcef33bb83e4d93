"""Quality rules under weak supervision.

Each rule votes good or bad or abstains; expectation-maximisation estimates
how far each can be trusted, and the posterior probability of good decides,
in place of a filter that all rules must pass. Two base rules stay hard.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.llm.common import lean, text_of, text_slices, utf8_buffer, words_of
from cohortlens.llm.weak_labels import attach_posterior, fit, pattern_counts, vote

MIN_WORDS = 50
SYMBOLS = b"#*$%&|<>"
MARKS = bytes(c for c in range(33, 127) if not chr(c).isalnum())  # ASCII punctuation and symbols
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_marks", "n_distinct",
         "n_top_word", "n_near_repeats", "n_letterless")


def _count_bytes(buf: np.ndarray, off: np.ndarray, table: np.ndarray) -> np.ndarray:
    return np.diff(np.searchsorted(np.flatnonzero(table[buf]), off)).astype(np.int64)


def repeated_window_words(ids: np.ndarray, row: np.ndarray, distinct: int) -> np.ndarray:
    """For each word: whether it stands in a 3-word window that occurs twice
    or more in its text."""
    n = len(ids)
    out = np.zeros(n, bool)
    if n < 3:
        return out
    at = np.flatnonzero(row[2:] == row[:-2])
    if not len(at):
        return out
    # Exact numbers for pairs, then for (row, pair, word): no hash, no collision.
    pair = np.unique(ids[at].astype(np.int64) * distinct + ids[at + 1], return_inverse=True)[1]
    tri = np.unique(pair.astype(np.int64) * distinct + ids[at + 2], return_inverse=True)[1]
    r = row[at] - row[at[0]]
    key = r.astype(np.int64) * (int(tri.max()) + 1) + tri
    _, inv, cnt = np.unique(key, return_inverse=True, return_counts=True)
    hit = at[cnt[inv] > 1]
    out[hit] = out[hit + 1] = out[hit + 2] = True
    return out


def text_stats(texts: pa.Array) -> dict[str, np.ndarray]:
    """The STATS of each text of a null-free string array. n_top_word: how
    often its most frequent word stands in it; n_near_repeats: words equal to
    one of the two before; n_letterless: words without any letter."""
    n = len(texts)
    per = lambda row, w=None: np.bincount(row, weights=w, minlength=n).astype(np.int64)
    buf, off = utf8_buffer(texts)
    tables = {}
    for name, chars in (("n_symbols", SYMBOLS), ("n_marks", MARKS), ("n_upper", bytes(range(65, 91)))):
        t = np.zeros(256, bool)
        t[list(chars)] = True
        tables[name] = _count_bytes(buf, off, t)
    words, row = words_of(texts)
    d = words.dictionary_encode()
    ids, k = d.indices.to_numpy(zero_copy_only=False), max(1, len(d.dictionary))
    chars = pc.utf8_length(d.dictionary).to_numpy(zero_copy_only=False) if len(words) else np.zeros(0, np.int64)
    letterless = pc.invert(pc.match_substring_regex(d.dictionary, r"\pL")).to_numpy(zero_copy_only=False) if len(words) else np.zeros(0, bool)
    near = np.zeros(len(ids), bool)
    for gap in (1, 2):
        if len(ids) > gap:
            near[gap:] |= (ids[gap:] == ids[:-gap]) & (row[gap:] == row[:-gap])
    own, times = np.unique(row.astype(np.int64) * k + ids, return_counts=True)
    top = np.zeros(n, np.int64)
    np.maximum.at(top, own // k, times)
    lines = pc.split_pattern(texts, "\n")
    flat, lrow = lines.flatten(), pc.list_parent_indices(lines).to_numpy(zero_copy_only=False)
    dup = np.zeros(n, np.int64)
    if len(flat):
        dl = flat.dictionary_encode()
        filled = pc.greater(pc.binary_length(pc.ascii_trim_whitespace(dl.dictionary)), 0).to_numpy(zero_copy_only=False)
        li = dl.indices.to_numpy(zero_copy_only=False)
        keep = filled[li]
        li, lr = li[keep].astype(np.int64), lrow[keep].astype(np.int64)
        once = np.unique(lr * len(dl.dictionary) + li)
        dup = per(lr) - per(once // max(1, len(dl.dictionary)))
    return {"n_words": per(row), "word_chars": per(row, chars[ids] if len(ids) else None), "n_dup_lines": dup,
            "n_repeat_words": per(row, repeated_window_words(ids, row, k)), "n_distinct": per(own // k), "n_top_word": top, "n_near_repeats": per(row, near),
            "n_letterless": per(row, letterless[ids] if len(ids) else None), **tables}


def _attach(names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches, "_q_text"):
            s = text_stats(b.column(b.schema.get_field_index("_q_text")))
            yield pa.RecordBatch.from_arrays([*[b.column(i) for i in range(len(names))], *[pa.array(s[c]) for c in STATS]],
                                             names=[*names, *[f"_q_{c}" for c in STATS]])
    return lean(run)


def attach_stats(docs: DataFrame) -> DataFrame:
    """``docs`` with the STATS of its text as columns ``_q_<name>``; a map over
    the rows, without a shuffle."""
    schema = T.StructType([*docs.schema.fields, *[T.StructField(f"_q_{c}", T.LongType()) for c in STATS]])
    return docs.withColumn("_q_text", text_of()).mapInArrow(_attach(docs.columns), schema)


def rules() -> list:
    """The votes over the columns of STATS. Between the two bounds, or without
    words, a rule abstains. The rules overlap: junk of symbols, tables and
    stammered words is seen by several of them, each in its own way, so that
    agreement tells which to believe. The two on repetition are strict on
    purpose; on texts that all others call good they are outvoted."""
    words = F.when(F.col("_q_n_words") > 0, F.col("_q_n_words").cast("double"))
    chars = F.when(F.col("_q_word_chars") > 0, F.col("_q_word_chars").cast("double"))
    mean = chars / words
    band = lambda x, good, bad: vote(x > bad, x < good)
    share = lambda c: F.col(f"_q_{c}") / words
    return [
        vote((mean < 3) | (mean > 7), (mean > 4) & (mean < 6.5)),
        band(share("n_symbols"), 0.05, 0.2),
        band(F.col("_q_n_marks") / chars, 0.1, 0.2),
        band(share("n_top_word"), 0.12, 0.25),
        band(share("n_near_repeats"), 0.05, 0.2),
        band(share("n_letterless"), 0.1, 0.25),
        band(F.col("_q_n_dup_lines") * 20 / words, 0.1, 0.2),
        band(share("n_repeat_words"), 0.05, 0.1),
        band(F.col("_q_n_upper") / chars, 0.2, 0.4),
    ]


def judge(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``docs`` with ``_q_`` columns: STATS, posterior, base_failed, kept.

    Two maps over the texts: the first only counts vote patterns for the fit,
    the second attaches the verdict, so no text is ever shuffled."""
    failed = (F.col("_q_n_words") < MIN_WORDS) | (100 * F.col("_q_n_repeat_words") > 50 * F.col("_q_n_words"))
    # Rows that the base rules reject anyway would otherwise be the whole bad class.
    counts = pattern_counts(attach_stats(docs.select("text")).where(~failed), rules())
    post, _ = fit(counts, len(rules()))
    out = attach_posterior(attach_stats(docs), rules(), post, "_q_posterior").withColumn("_q_base_failed", failed)
    return out.withColumn("_q_kept", ~F.col("_q_base_failed") & (F.col("_q_posterior") >= threshold))


def quality_rules(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Per row of ``docs``: doc_id, the STATS, base_failed, posterior, kept.

    base_failed: fewer than 50 words, or more than half of them in repeated
    3-word windows; such rows are not kept. Otherwise a row is kept if the
    posterior probability of good is ``threshold`` or more. A null or empty
    text has zero counts and fails. Equal rows get equal results; columns
    other than doc_id and text are not read. Empty input gives no rows.
    """
    out = judge(docs.select("doc_id", "text"), threshold)
    return out.select("doc_id", *[F.col(f"_q_{c}").alias(c) for c in (*STATS, "base_failed", "posterior", "kept")])


def apply_quality_rules(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that the rules keep, all columns unchanged."""
    return judge(docs, threshold).where("_q_kept").select(*docs.columns)
