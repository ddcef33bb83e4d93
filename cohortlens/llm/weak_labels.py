"""Weak supervision: accuracies of voting labellers by expectation-maximisation.

A labeller votes good (2), bad (1) or abstains (0). The votes of a row make
a pattern, a base-3 number; with m labellers there are at most 3 ** m
patterns, so the pattern counts of any corpus are a small table. The
two-class model is fitted on those counts: per class and labeller the rate
of bad among its votes. An abstention says nothing about the class.
"""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ABSTAIN, BAD, GOOD = 0, 1, 2
# Pseudo-votes (bad, good) and pseudo-rows of the prior: fixed numbers, so that
# in any sizeable corpus the votes decide. Most rows are taken to be good, and
# good rows to get a bad vote now and then.
PRIOR_BAD, PRIOR_GOOD, PRIOR_ROWS = (1.0, 1.0), (1.0, 19.0), (1.0, 9.0)
MAX_LABELLERS = 9  # 19 683 patterns at most


def vote(bad: Column, good: Column) -> Column:
    """bad and good conditions to a vote; null or neither: abstain."""
    return F.when(bad, F.lit(BAD)).when(good, F.lit(GOOD)).otherwise(F.lit(ABSTAIN))


def pattern(votes: list[Column]) -> Column:
    out = F.lit(0)
    for v in votes:
        out = out * 3 + v
    return out.cast("int")


def digits(patterns: np.ndarray, m: int) -> np.ndarray:
    """(n, m) votes of the patterns."""
    return np.stack([patterns // 3 ** (m - 1 - i) % 3 for i in range(m)], axis=1) if m else np.zeros((len(patterns), 0), int)


def fit(counts: Mapping[int, int], m: int, iterations: int = 500) -> tuple[dict[int, float], np.ndarray]:
    """EM over pattern counts. Returns the posterior probability of good per
    pattern and the rates of bad votes [class (bad, good), labeller].

    Starts from a soft majority in which one bad vote outweighs the good ones;
    what a bad vote is worth in the end is estimated: a labeller whose bad votes
    the others do not share is outvoted by them. A labeller that would vote bad
    more often on good rows than on bad ones is held at equal odds, so the
    classes cannot swap. The priors (see above) only settle what few rows leave
    open. Without rows the result is empty."""
    if not counts:
        return {}, np.full((2, m), 0.5)
    pats = np.array(sorted(counts), dtype=np.int64)
    n = np.array([counts[int(p)] for p in pats], dtype=float)
    v = digits(pats, m)
    bad, good = (v == BAD).sum(1), (v == GOOD).sum(1)
    post = np.where(bad > 0, 0.1, np.where(good > 0, 0.95, 0.5))
    rate = np.full((2, m), 0.5)  # of bad among the votes, by class (bad, good) and labeller
    for _ in range(iterations):
        share = (n @ post + PRIOR_ROWS[1]) / (n.sum() + sum(PRIOR_ROWS))
        for c, (w, prior) in enumerate(((n * (1 - post), PRIOR_BAD), (n * post, PRIOR_GOOD))):
            rate[c] = (w @ (v == BAD) + prior[0]) / (w @ (v != ABSTAIN) + sum(prior))
        swapped = rate[1] > rate[0]
        rate[:, swapped] = rate[:, swapped].mean(axis=0)
        log = [np.log(p) + (v == BAD) @ np.log(rate[c]) + (v == GOOD) @ np.log(1 - rate[c])
               for c, p in enumerate((1 - share, share))]
        new = 1 / (1 + np.exp(np.clip(log[0] - log[1], -500, 500)))
        done = np.abs(new - post).max() < 1e-9
        post = new
        if done:
            break
    return dict(zip(pats.tolist(), post.tolist())), rate


def pattern_counts(df: DataFrame, votes: list[Column]) -> dict[int, int]:
    """How often each vote pattern occurs: at most 3 ** m rows reach the driver."""
    if len(votes) > MAX_LABELLERS:
        raise ValueError(f"at most {MAX_LABELLERS} labellers")
    return {r[0]: r[1] for r in df.select(pattern(votes).alias("_pattern")).groupBy("_pattern").count().collect()}


def attach_posterior(df: DataFrame, votes: list[Column], post: Mapping[int, float], name: str = "posterior") -> DataFrame:
    """Add the posterior probability of good to every row (a broadcast of at
    most 3 ** m rows). A pattern that the fit has not seen gets 0.5."""
    table = df.sparkSession.createDataFrame(sorted(post.items()), f"_pattern int, {name} double")
    return (df.withColumn("_pattern", pattern(votes)).join(F.broadcast(table), "_pattern", "left")
            .withColumn(name, F.coalesce(name, F.lit(0.5))).drop("_pattern"))
