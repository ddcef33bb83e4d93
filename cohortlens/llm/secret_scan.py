"""Secret scans with DataFrame functions only.

Fixed patterns give the base spans. The method adds candidate strings whose
Shannon entropy, in a sliding window whose character counts are updated as
it moves, reaches the bound of their character class. What an allow-list
pattern explains is cut out first, and the pieces left are judged.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import text_of

ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{32,}"  # the runs of [0-9a-f]+ that are long enough
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"

WINDOW = 20
# Bits per character that a window must reach, by the class of the candidate's
# characters; the first class that matches counts. Infinity: never a secret.
# ODD lists the bounds of letters that are not like words.
CLASSES: tuple[tuple[str, str, float], ...] = (
    ("digits", r"^[0-9]+$", math.inf),
    ("hex", r"^([0-9a-f]+|[0-9A-F]+)$", 3.0),
    ("one_case", r"^([a-z_-]+|[A-Z_-]+)$", math.inf),
    ("letters", r"^[A-Za-z_/-]+$", 4.1),
    ("mixed", r"^.*$", 3.7),
)
# Five consonants in a row are common in random letters and rare in names: 463 of 28 519
# identifiers of 20 or more letters in Python's library have them and a window of 3.5 bits.
UNLIKE_WORDS = r"(?i)[bcdfghjklmnpqrstvwxz]{5}"
ODD = {"one_case": 3.5, "letters": 3.8}
# Signs before a candidate that say nothing about what follows; those behind it may be padding.
LEAD = r"^[=_/+-]+"
# Harmless strings that look random. Their matches are cut out of a candidate:
# words and fillers with up to WINDOW characters beside them as far as the next
# = or /, paths of names with the short parts that follow. A space is a cut.
ALLOW = (
    r"^[=_/+-]*[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
    r"(?i)(/[a-z]+){3}([^ =/]{0,19}(?=[ =/]|$))?(/[^ =/]{0,19}(?=[ =/]|$))*",
    r"(?i)[^ =/]{0,20}(example|sample|placeholder|your[_-]|changeme|x{6}|0{8}|1234567)[^ =/]{0,20}",
    r"(?i)^(https?|www|ftp)[^ =/]{0,20}",
    r"[=_/+-]{5,}",
)


def regex_spans(text: Column, regex: str, group: int = 0, min_len: int = 0, gate: Column | None = None) -> Column:
    """array<struct<start, end, value>> of the leftmost non-overlapping matches
    whose ``group`` has ``min_len`` characters; code points, end exclusive.
    The pieces between the matches give the positions. ``gate`` is a cheap
    condition without which there can be no match."""
    found = F.regexp_extract_all(text, F.lit(regex), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(regex), F.lit(group)) if group else found
    zipped = F.arrays_zip(found.alias("m"), value.alias("v"), F.slice(F.split(text, regex, -1), F.lit(1), F.size(found)).alias("p"))
    kind = "array<struct<start:int,end:int,value:string>>"

    def step(acc: Column, x: Column) -> Column:
        s = acc["pos"] + F.length(x["p"])
        e = s + F.length(x["m"])
        item = F.struct(s.alias("start"), e.alias("end"), x["v"].alias("value"))
        return F.struct(e.alias("pos"), F.when(F.length(x["v"]) >= min_len, F.array_append(acc["out"], item))
                        .otherwise(acc["out"]).alias("out"))

    spans = F.aggregate(zipped, F.struct(F.lit(0).alias("pos"), F.array().cast(kind).alias("out")), step, lambda acc: acc["out"])
    return F.when(text.rlike(regex) if gate is None else gate, spans).otherwise(F.array().cast(kind))


def window_entropy(s: Column, window: int = WINDOW) -> Column:
    """The largest entropy, in bits per character, of ``window`` characters of
    ``s`` in a row. Counts per distinct character and the sum of c * log2(c)
    are carried along: each step adds the entering character and takes the
    leaving one off. A shorter string is one window."""
    table = F.array(*[F.lit(0.0 if c < 2 else c * math.log2(c)) for c in range(window + 2)])
    f = lambda c: F.element_at(table, c + 1)
    chars = F.split(s, "")
    w = F.least(F.lit(window), F.length(s))
    alphabet = F.array_distinct(chars)
    ids = F.transform(chars, lambda c: F.array_position(alphabet, c).cast("int"))

    def step(acc: Column, i: Column) -> Column:
        x = F.element_at(acc["ids"], i)
        y = F.when(i > w, F.element_at(acc["ids"], F.greatest(i - w, F.lit(1)))).otherwise(F.lit(0))
        cx, cy = F.element_at(acc["n"], x), F.element_at(acc["n"], F.greatest(y, F.lit(1)))
        change = F.when(x == y, F.lit(0.0)).otherwise(
            f(cx + 1) - f(cx) + F.when(y > 0, f(F.greatest(cy - 1, F.lit(0))) - f(cy)).otherwise(F.lit(0.0)))
        total = acc["sum"] + change
        n = F.transform(acc["n"], lambda c, j: c + F.when(j + 1 == x, 1).otherwise(0) - F.when(j + 1 == y, 1).otherwise(0))
        bits = F.log2(w.cast("double")) - total / w
        return F.struct(acc["ids"].alias("ids"), n.alias("n"), total.alias("sum"),
                        F.when(i >= w, F.greatest(acc["best"], bits)).otherwise(acc["best"]).alias("best"))

    init = F.struct(ids.alias("ids"), F.transform(alphabet, lambda c: F.lit(0)).alias("n"), F.lit(0.0).alias("sum"),
                    F.lit(0.0).alias("best"))
    return F.aggregate(F.sequence(F.lit(1), F.length(s)), init, step, lambda acc: acc["best"])


def scan_secrets(docs: DataFrame, classes: Sequence[tuple[str, str, float]] = CLASSES, allow: Sequence[str] = ALLOW,
                 bounds: Mapping[str, float] | None = None) -> DataFrame:
    """Per row of ``docs``: doc_id, n_assign, n_access, n_hex, n_entropy (long),
    base_spans and all_spans (arrays of struct<start, rank, kind, end>, by
    start, then kind in the order assign, access, hex, entropy).

    Kinds are matched independently, so base spans of different kinds may
    overlap; entropy spans that touch a base span are left out. ``bounds``
    overrides the entropy bound of classes by name. A candidate of which one
piece is random is reported whole. A null or empty text has
    no spans; equal rows give equal results; no other column is read.
    """
    odd = {name: limit for name, limit in ODD.items() if name not in (bounds or {})}
    bound = {name: (bounds or {}).get(name, limit) for name, _, limit in classes}
    t = F.col("_text")
    label = lambda spans, rank, kind: F.transform(
        spans, lambda x: F.struct(x["start"].alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), x["end"].alias("end")))
    d = docs.select("doc_id", text_of().alias("_text"))
    # Every long hex run is inside a candidate, so one regex scan gates both.
    d = d.select("doc_id", "_text", t.rlike(CANDIDATE).alias("_long"), F.lower(t).alias("_lower"))
    named = F.lit(False)
    for word in KEYWORDS:
        named = named | F.contains("_lower", F.lit(word))
    d = d.select("doc_id",
                 label(regex_spans(t, ASSIGN, 2, 8, named), 0, "assign").alias("_assign"),
                 label(regex_spans(t, ACCESS, 0, 16, F.contains(t, F.lit("AKIA"))), 1, "access").alias("_access"),
                 label(regex_spans(t, HEX, 0, 32, F.col("_long")), 2, "hex").alias("_hex"),
                 regex_spans(t, CANDIDATE, 0, WINDOW, F.col("_long")).alias("_cand"))
    d = d.withColumn("base_spans", F.array_sort(F.concat("_assign", "_access", "_hex")))

    def secret(x: Column) -> Column:
        free = ~F.exists("base_spans", lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"]))
        rest = x["value"]
        for regex in allow:
            rest = F.regexp_replace(rest, regex, " ")
        return F.when(free, F.exists(F.split(rest, " "), random)).otherwise(F.lit(False))

    def random(piece: Column) -> Column:
        v = F.regexp_replace(piece, LEAD, "")
        limit = F.lit(math.inf)
        for name, regex, _ in reversed(list(classes)):
            least = F.lit(bound[name])
            if name in odd:
                least = F.when(v.rlike(UNLIKE_WORDS), F.lit(odd[name])).otherwise(least)
            limit = F.when(v.rlike(regex), least).otherwise(limit)
        judged = (F.length(piece) >= WINDOW) & (limit < F.lit(math.inf))
        return F.when(judged, window_entropy(piece) >= limit).otherwise(F.lit(False))

    d = d.withColumn("_entropy", F.when(F.size("_cand") > 0, label(F.filter("_cand", secret), 3, "entropy"))
                     .otherwise(F.slice("base_spans", 1, 0)))
    n = lambda c: F.size(c).cast("long")
    return d.select("doc_id", n("_assign").alias("n_assign"), n("_access").alias("n_access"), n("_hex").alias("n_hex"),
                    n("_entropy").alias("n_entropy"), "base_spans",
                    F.array_sort(F.concat("base_spans", "_entropy")).alias("all_spans"))


def joined(spans: str) -> Column:
    """kind:start:end of the spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
