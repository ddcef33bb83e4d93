"""Benchmark decontamination by spaced-seed hashing, DataFrame functions only.

Fixed masks over consecutive tokens mark the positions that enter a hash;
the others may differ. Seeds of the benchmark items are joined to the seeds
of the training texts; around each hit the item is laid along the text and
the overlap must agree in most tokens, wherever the substitutions are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import materialize, text_of

TOKEN = r"[\p{L}\p{N}]+"
# 1: the token enters the hash; 0: any token may stand there.
MASKS = ("110110011", "101011101")
# Masks added for items of so many tokens (from, to). With them every placement
# of the substitutions that OVERLAP and AGREE allow leaves a hit: three in 15
# (hence in 16), two in 10 to 14, one in 5 to 9, none in fewer.
ADDED = (
    (15, 1 << 30, ("1110000101",)),
    (10, 14, ("111011", "11010011", "11111")),
    (5, 9, ("1111", "11101", "11011", "10111")),
    (4, 4, ("1111",)), (3, 3, ("111",)), (2, 2, ("11",)), (1, 1, ("1",)),
)
OVERLAP = 16  # tokens over which agreement is judged (an item's length, if shorter)
AGREE = 0.8
# Up to so many benchmark seeds (24 bytes each) are broadcast; more are joined by shuffle.
BROADCAST_SEEDS = 1_000_000
BROADCAST_IDS = 1_000_000  # of texts with a hit, 8 bytes each; more are joined by shuffle


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))


def seeds(h: Column, masks: Sequence[tuple], counts: Sequence[Column]) -> Column:
    """The seed hashes of an array of token hashes, all positions of the first
    mask, then of the next; the mask's number is part of the hash. ``counts``
    are the positions of each mask."""
    parts = []
    for (number, mask, _, _), n in zip(masks, counts):
        at = [i for i, c in enumerate(mask) if c == "1"]
        positions = F.when(n > 0, F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)))).otherwise(F.array().cast("array<int>"))
        parts.append(F.transform(positions, _seed(h, number, at)))
    return F.concat(*parts)


def _seed(h: Column, number: int, at: list[int]):
    return lambda i: F.xxhash64(F.lit(number), *[F.get(h, i + a) for a in at])


def numbered(masks: Sequence[str]) -> list[tuple]:
    """(number, mask, from, to) of ``masks``, for items of any length, and of the added ones."""
    rows = [(mask, 0, 1 << 30) for mask in masks] + [(mask, lo, hi) for lo, hi, more in ADDED for mask in more]
    return [(k, *row) for k, row in enumerate(rows)]


def seed_rows(df: DataFrame, key: str, masks: Sequence[tuple], items: bool = False) -> DataFrame:
    """(key, seed, pos, mask): one row per mask and position; of items, only
    the masks for their length."""
    h = df.select(F.col(key), F.transform(tokens(text_of()), lambda w: F.xxhash64(w)).alias("_h"))

    def counts(size: Column) -> list[Column]:
        full = [F.greatest(size - (len(mask) - 1), F.lit(0)) for _, mask, _, _ in masks]
        return [F.when(size.between(lo, hi), n).otherwise(F.lit(0)) for n, (_, _, lo, hi) in zip(full, masks)] if items else full

    s = h.select(F.col(key), F.size("_h").alias("_size"), seeds(F.col("_h"), masks, counts(F.size("_h"))).alias("_s"))
    # The outer form: for the inner one the planner infers a filter on the size
    # of the array and computes all seeds again below the projections.
    rows = s.select(F.col(key), "_size", F.posexplode_outer("_s").alias("_i", "seed")).where(F.col("seed").isNotNull())
    pos, mask, end = F.lit(None).cast("int"), F.lit(None).cast("int"), []
    for n in counts(F.col("_size")):
        end.append(end[-1] + n if end else n)
    for k in reversed(range(len(masks))):
        here = F.col("_i") < end[k]
        pos = F.when(here, F.col("_i") - (end[k - 1] if k else F.lit(0))).otherwise(pos)
        mask = F.when(here, F.lit(masks[k][0])).otherwise(mask)
    return rows.select(F.col(key), "seed", pos.alias("pos"), mask.alias("mask"))


def overlap(doc: Column, item: Column, shift: Column, window: Column) -> Column:
    """The most tokens, of ``window`` in a row, that agree when the item's first
    token is laid on position ``shift`` of the text. One pass with running
    counts: each step adds the entering token and takes the leaving one off."""
    same = F.transform(item, lambda w, i: F.coalesce((F.get(doc, F.when(i + shift >= 0, i + shift)) == w).cast("int"), F.lit(0)))

    def step(acc: Column, i: Column) -> Column:
        now = acc["now"] + F.get(acc["same"], i) - F.when(i >= window, F.get(acc["same"], F.greatest(i - window, F.lit(0)))).otherwise(0)
        return F.struct(acc["same"].alias("same"), now.alias("now"), F.greatest(acc["best"], now).alias("best"))

    init = F.struct(same.alias("same"), F.lit(0).alias("now"), F.lit(0).alias("best"))
    return F.aggregate(F.sequence(F.lit(0), F.size(item) - 1), init, step, lambda acc: acc["best"])


def find_leaks(docs: DataFrame, benchmark: DataFrame, masks: Sequence[str] = MASKS, window: int = OVERLAP,
               agree: float = AGREE) -> DataFrame:
    """Which texts hold (parts of) benchmark items.

    Returns one row per (doc_id, item_id): item_tokens, matched (tokens that
    agree in the best stretch), needed, position (token of the text where
    the item would begin; negative if its beginning is missing) and seeds
    (hits of ``masks`` on that alignment, without the ADDED ones). Tokens are runs of letters and digits in lower
    case. A leak is a stretch of ``window`` tokens (the whole item, if it is
    shorter) of which ``agree`` or more are equal at equal distances; with
    the usual window and share, each one is found. Items and texts without
    tokens are never reported. Equal texts are each reported; rows that
    share a doc_id count as one document, an item_id likewise. Other columns
    are not read.
    """
    items = benchmark.select("item_id", text_of().alias("text"))
    every = numbered(masks)
    counted = (F.col("mask") < len(masks)).cast("long").alias("_counted")
    probe = materialize(seed_rows(items, "item_id", every, items=True).select("item_id", "seed", F.col("pos").alias("_ipos"), "mask", counted)
                        .distinct(), "seeds")
    used = {r.mask for r in probe.select("mask").distinct().collect()}  # at most one row per mask
    every = [m for m in every if m[0] in used] or every[:1]
    probe = probe.drop("mask")
    if probe.limit(BROADCAST_SEEDS + 1).count() <= BROADCAST_SEEDS:
        probe = F.broadcast(probe)
    texts = docs.select("doc_id", text_of().alias("text"))
    hits = (seed_rows(texts, "doc_id", every).select("doc_id", "seed", "pos").join(probe, "seed")
            .groupBy("doc_id", "item_id", (F.col("pos") - F.col("_ipos")).alias("_shift"))
            .agg(F.sum("_counted").alias("seeds")))
    hits = materialize(hits, "seed_hits")
    words = items.select(F.col("item_id").alias("_item"), tokens(F.col("text")).alias("_want"))
    # Only the texts with a hit are tokenised again, and shuffled: the others
    # fall to the ids of the hits, which are broadcast up to a counted number.
    ids = materialize(hits.select(F.col("doc_id").alias("_hit")).distinct(), "hit_ids")
    ids = F.broadcast(ids) if ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS else ids
    texts = materialize(texts.join(ids, F.col("doc_id").eqNullSafe(F.col("_hit")), "left_semi"), "hit_texts")
    near = hits.join(words, F.col("item_id").eqNullSafe(F.col("_item"))).drop("_item")
    near = near.withColumnRenamed("doc_id", "_doc")
    both = texts.select("doc_id", tokens(F.col("text")).alias("_have")).join(near, F.col("doc_id").eqNullSafe(F.col("_doc")))
    n = F.size("_want")
    width = F.least(n, F.lit(window))
    judged = both.select("doc_id", "item_id", n.alias("item_tokens"), F.col("_shift").alias("position"), "seeds",
                         overlap(F.col("_have"), F.col("_want"), F.col("_shift"), width).alias("matched"),
                         F.ceil(width * agree).cast("int").alias("needed"))
    best = F.max(F.struct("matched", "seeds", (-F.col("position")).alias("p"), "item_tokens", "needed")).alias("_b")
    return (judged.where(F.col("matched") >= F.col("needed")).groupBy("doc_id", "item_id").agg(best)
            .select("doc_id", "item_id", "_b.item_tokens", "_b.matched", "_b.needed", (-F.col("_b.p")).alias("position"), "_b.seeds"))


def remove_leaks(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` without a leak, all columns unchanged. Rows are told
    apart by doc_id and text, so a clean row stays if it shares the doc_id, or
    the lack of one, with a leaking row."""
    key = F.xxhash64("doc_id", text_of())
    keyed = docs.select(key.alias("doc_id"), "text")
    found = materialize(find_leaks(keyed, benchmark, **options).select(F.col("doc_id").alias("_leak")).distinct(), "leaks")
    return docs.withColumn("_key", key).join(found, F.col("_key") == F.col("_leak"), "left_anti").drop("_key")
