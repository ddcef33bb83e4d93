"""Mixing sources to target weights by the cube method.

Every document of a source is to be taken ``target / source_size`` times on
average. The whole part of that rate is taken outright; the fraction is an
inclusion probability, and the cube method turns the probabilities into
0 / 1 draws while two totals of the source stay balanced: words and
documents. A flight step moves the probabilities of three documents along
the null space of the two balancing constraints until one of them reaches 0
or 1. Flights run in bounded blocks, in parallel; what each block leaves
open (at most two documents) is flown again in coarser blocks. A source is
landed at the level where one block of it is left: its last one or two
documents are rounded so that they miss the totals least. If one of them was
long, shorter documents of the whole source are turned over, in the block
itself or, for a source of several blocks, by quotas per document size.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.llm.common import WORD, materialize, text_of

EPS = 1e-9


def source_targets(sizes: DataFrame, weights: Sequence[int] = (1, 2, 3), max_repeats: int = 3) -> DataFrame:
    """(source, source_size, source_docs, target) from (source, size) rows.

    Sources in code-point order, null last, weigh ``weights`` in turn and share
    the total size; a target stops at ``max_repeats`` times its source's size
    and the excess goes to the others by weight. Solved in one pass: in
    ascending order of cap per weight, the sources before the first whose cap
    covers its share are capped, all others share the rest. The windows run
    over one row per source.
    """
    per = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"),
                                      F.count(F.lit(1)).alias("source_docs"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    pos = F.row_number().over(order) - 1
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (pos % len(weights) + 1).cast("int"))
    per = per.withColumn("_w", w).withColumn("_cap", (F.col("source_size") * max_repeats).cast("double"))
    by_cap = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("source").asc_nulls_last())
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    per = (per.withColumn("_k", F.row_number().over(by_cap))
           .withColumn("_capped", F.coalesce(F.sum("_cap").over(before), F.lit(0.0)))
           .withColumn("_used", F.coalesce(F.sum("_w").over(before), F.lit(0.0)))
           .withColumn("_total", F.sum("source_size").over(everything).cast("double"))
           .withColumn("_weight", F.sum("_w").over(everything))
           .withColumn("_level", (F.col("_total") - F.col("_capped")) / (F.col("_weight") - F.col("_used"))))
    per = per.withColumn("_free", F.when(F.col("_cap") >= F.col("_w") * F.col("_level"), F.col("_k")))
    per = (per.withColumn("_first", F.min("_free").over(everything))
           .withColumn("_common", F.max(F.when(F.col("_k") == F.col("_first"), F.col("_level"))).over(everything)))
    target = F.when(F.col("_first").isNull() | (F.col("_k") < F.col("_first")), F.col("_cap")) \
        .otherwise(F.least(F.col("_cap"), F.col("_w") * F.col("_common")))
    return per.select("source", "source_size", "source_docs", target.alias("target"))


def _step(p: list, s: list) -> list | None:
    """A direction in the null space of (sizes, ones) for the units at hand."""
    if len(p) >= 3:
        u = [s[1] - s[2], s[2] - s[0], s[0] - s[1]]
        return u if any(u) else [1.0, -1.0, 0.0]
    if len(p) == 2 and s[0] == s[1]:
        return [1.0, -1.0]
    return None


def fly(prob: np.ndarray, size: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Flight phase over one block: probabilities after it, at most two of
    them strictly between 0 and 1; both balanced totals are unchanged."""
    prob = prob.astype(float).copy()
    draws = rng.random(len(prob) + 4)
    hand: list[int] = []
    nxt = used = 0
    n = len(prob)
    while True:
        while len(hand) < 3 and nxt < n:
            if EPS < prob[nxt] < 1 - EPS:
                hand.append(nxt)
            else:
                prob[nxt] = round(prob[nxt])
            nxt += 1
        p, s = [prob[i] for i in hand], [float(size[i]) for i in hand]
        u = _step(p, s)
        if u is None:
            return prob
        scale = max(abs(x) for x in u)
        u = [x / scale for x in u]
        up = min(((1 - q) / x if x > 0 else -q / x) for q, x in zip(p, u) if x)
        down = min((q / x if x > 0 else (q - 1) / x) for q, x in zip(p, u) if x)
        move = up if draws[used] * (up + down) < down else -down
        used += 1
        left = []
        for i, q, x in zip(hand, p, u):
            q += move * x
            if q <= EPS:
                prob[i] = 0.0
            elif q >= 1 - EPS:
                prob[i] = 1.0
            else:
                prob[i] = q
                left.append(i)
        if len(left) == len(hand):  # rounding kept every unit open: settle the closest
            i = min(left, key=lambda k: min(prob[k], 1 - prob[k]))
            prob[i] = round(prob[i])
            left.remove(i)
        hand = left


def land(prob: np.ndarray, size: np.ndarray, words: float, docs: float, movable: np.ndarray) -> np.ndarray:
    """Landing phase: round the few open units so that words, then documents,
    miss their totals least. If a long document had to be rounded, shorter
    ``movable`` ones are turned over, longest that fits first, until no turn
    brings the words nearer."""
    prob = prob.copy()
    open_ = np.flatnonzero((prob > 0) & (prob < 1))
    if len(open_):
        w, d = words - float(prob @ size) + float(prob[open_] @ size[open_]), docs - float(prob.sum() - prob[open_].sum())
        prob[open_] = min(itertools.product((0.0, 1.0), repeat=len(open_)),
                          key=lambda r: (abs(float(np.dot(r, size[open_])) - w), abs(sum(r) - d), r))
    miss = words - float(prob @ size)
    for i in np.argsort(-size, kind="stable"):
        gain = size[i] if prob[i] == 0 else -size[i]
        if movable[i] and size[i] > 0 and gain * miss > 0 and size[i] <= abs(miss):
            prob[i] = 1 - prob[i]
            miss -= gain
    return prob


def _fly_block(one: str):
    """Fly a block; land it if column ``one`` says it is all that is left of its source."""
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["size", "_h", "doc_id"], ascending=[False, True, True], kind="stable",
                              na_position="last").reset_index(drop=True)
        last = bool(pdf[one].iat[0])
        rng = np.random.default_rng([int(key[0]) & 0xFFFFFFFF, int(key[1]), int(last)])
        size = pdf["size"].to_numpy(dtype=float)
        start = pdf["_p"].to_numpy(dtype=float)
        p = fly(start, size, rng)
        if last:
            p = land(p, size, float(start @ size), float(start.sum()), (start > EPS) & (start < 1 - EPS))
        pdf["_p"] = p
        return pdf
    return run


def _quotas(pdf: pd.DataFrame) -> pd.DataFrame:
    """How many documents of each size to turn over, longest that fits first."""
    pdf = pdf.sort_values("size", ascending=False, kind="stable")
    rest, quota = float(pdf["_miss"].iat[0]), []
    for size, n in zip(pdf["size"].tolist(), pdf["_n"].tolist()):
        k = min(n, int(rest // size))
        rest -= k * size
        quota.append(k)
    return pdf.assign(_quota=quota)[["_sid", "size", "_quota"]]


def _turn_over(units: DataFrame, block_rows: int) -> DataFrame:
    """The repair of the landing for sources of several blocks: ``units`` with
    all ``_p`` 0 or 1, some turned over so that the words of each such source
    come nearer to its target. Documents of one size are picked block by block,
    so no task holds more than a block or one count per size or block."""
    movable = (F.col("source_docs") > block_rows) & (F.col("_p0") > EPS) & (F.col("_p0") < 1 - EPS)
    miss = (units.where(movable).groupBy("_sid", "target")
            .agg(F.sum((F.col("_base") + F.col("_p").cast("long")) * F.col("size")).alias("_taken"))
            .select(F.col("_sid").alias("_s"), (F.col("target") - F.col("_taken")).alias("_gap")))
    miss = materialize(miss, "mix_miss")
    fits = movable & (F.col("size") > 0) & (F.col("size") <= F.abs("_gap")) & (F.col("_p") == F.when(F.col("_gap") > 0, 0.0).otherwise(1.0))
    units = (units.join(miss, F.col("_sid") == F.col("_s"), "left").drop("_s")
             .withColumn("_miss", F.when(fits, F.abs("_gap"))).drop("_gap"))
    units = materialize(units, "mix_landed")
    sizes = units.where("_miss IS NOT NULL").groupBy("_sid", "size", "_miss").agg(F.count(F.lit(1)).alias("_n"))
    quotas = (sizes.groupBy("_sid").applyInPandas(_quotas, "_sid long, size long, _quota long").where("_quota > 0")
              .select(F.col("_sid").alias("_s"), F.col("size").alias("_len"), "_quota"))
    quotas = materialize(quotas, "mix_quotas")
    units = units.join(quotas, (F.col("_sid") == F.col("_s")) & (F.col("size") == F.col("_len")) & F.col("_miss").isNotNull(), "left")
    units = units.drop("_s", "_len", "_miss")
    rest = units.where("_quota IS NULL").drop("_quota")
    blocks = F.ceil(F.col("source_docs") / F.lit(block_rows))
    some = units.where("_quota IS NOT NULL").withColumn("_r", F.xxhash64("row_key", "_h")).withColumn("_b", F.pmod("_r", blocks).cast("int"))
    some = materialize(some, "mix_turned")
    before = Window.partitionBy("_sid", "size").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    counts = (some.groupBy("_sid", "size", "_b").agg(F.count(F.lit(1)).alias("_n"))
              .withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n"))
    nth = F.row_number().over(Window.partitionBy("_sid", "size", "_b").orderBy("_r", "doc_id"))
    turn = F.col("_before") + F.col("_k") <= F.col("_quota")
    some = (some.withColumn("_k", nth).join(counts, ["_sid", "size", "_b"])
            .withColumn("_p", F.when(turn, 1 - F.col("_p")).otherwise(F.col("_p"))))
    return rest.unionByName(some.select(rest.columns))


def mix_sources(docs: DataFrame, weights: Sequence[int] = (1, 2, 3), max_repeats: int = 3,
                block_rows: int = 4096) -> DataFrame:
    """Decide how often each document is taken.

    Returns one row per row of ``docs``: doc_id, source, size (words),
    source_size, target (of its source), copies (times taken) and taken
    (= copies * size). A null text has size 0; a null source is a source of
    its own, last in order. Equal rows are separate units. A source without
    words has target 0 and takes nothing. Draws depend only on the rows, so
    reruns agree. Empty input gives no rows.
    """
    out = _draws(docs, weights, max_repeats, block_rows)
    return out.select("doc_id", "source", "size", "source_size", "target", "copies", "taken")


def _row_key():
    return F.xxhash64("doc_id", F.col("source").cast("string"), text_of())


def _draws(docs: DataFrame, weights: Sequence[int], max_repeats: int, block_rows: int) -> DataFrame:
    sized = materialize(docs.select(F.col("doc_id"), F.col("source").cast("string").alias("source"), _row_key().alias("row_key"),
                                    F.regexp_count(text_of(), F.lit(WORD)).cast("long").alias("size")), "mix_sizes")
    targets = materialize(source_targets(sized, weights, max_repeats), "mix_targets")
    t = targets.withColumnRenamed("source", "_src")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    units = (sized.join(t, F.col("source").eqNullSafe(F.col("_src")), "left")
             .withColumn("_base", F.floor(rate + EPS).cast("long"))
             .withColumn("_p", F.greatest(rate - F.floor(rate + EPS), F.lit(0.0)))
             .withColumn("_p0", F.col("_p"))
             .withColumn("_h", F.xxhash64("doc_id", "size"))
             .withColumn("_sid", F.xxhash64(F.coalesce(F.col("source"), F.lit("")), F.col("source").isNull()))
             .drop("_src"))
    biggest = targets.agg(F.max("source_docs")).first()[0] or 0  # one number: how many rounds
    blocks_max = max(1, math.ceil(biggest / block_rows))
    several = blocks_max > 1
    done, shrink = [], F.ceil(F.col("source_docs") / F.lit(block_rows))
    open_ = units
    for level in itertools.count():
        last = blocks_max == 1
        keyed = (open_.withColumn("_b", F.pmod(F.xxhash64("_h", F.lit(level)), F.greatest(shrink, F.lit(1))).cast("int"))
                 .withColumn("_one", shrink <= 1))
        flown = materialize(keyed.groupBy("_sid", "_b").applyInPandas(_fly_block("_one"), keyed.schema), "mix_flight").drop("_b", "_one")
        settled = (F.col("_p") == 0) | (F.col("_p") == 1)
        if last:
            done.append(flown)
            break
        done.append(flown.where(settled))
        open_ = flown.where(~settled)
        shrink = F.ceil(shrink * 2 / F.lit(block_rows))
        blocks_max = max(1, math.ceil(blocks_max * 2 / block_rows))
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    if several:
        out = _turn_over(out, block_rows)
    copies = F.col("_base") + F.col("_p").cast("long")
    return out.select("doc_id", "source", "row_key", "size", "source_size", "target", copies.alias("copies"),
                      (copies * F.col("size")).alias("taken"))


def apply_mix(docs: DataFrame, weights: Sequence[int] = (1, 2, 3), max_repeats: int = 3,
              block_rows: int = 4096) -> DataFrame:
    """The mixed corpus: each row of ``docs`` repeated as often as taken, all
    columns kept. Rows that agree in doc_id, source and text share their
    draws, the most copies first."""
    m = _draws(docs, weights, max_repeats, block_rows).groupBy("row_key").agg(
        F.sort_array(F.collect_list("copies"), asc=False).alias("_copies"))
    d = docs.withColumn("_key", _row_key())
    d = d.withColumn("_k", F.row_number().over(Window.partitionBy("_key").orderBy("_key")))
    times = F.element_at("_copies", F.col("_k"))
    return (d.join(m.withColumnRenamed("row_key", "_key"), "_key").where(times > 0)
            .withColumn("_t", F.explode_outer(F.array_repeat(F.lit(1), times.cast("int")))).select(*docs.columns))
