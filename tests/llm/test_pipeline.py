"""The pipeline, stage by stage, against brute force on the smallest tables."""

import base64
import collections

import numpy as np
import public_tokenizers as P
import tiktoken

import corpus_pipeline
from cohortlens.llm import packing
from cohortlens.llm.common import documents
from cohortlens.llm.quality_rules import quality_rules
from tests.conftest import SF_SMALL
from tests.llm.helpers import WORD
from tests.llm.test_operators import brute_components


def test_stages_against_brute_force(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_duplicates", "decontamination", "source_mixing", "token_packing"]
    stage = dict(corpus_pipeline.STAGES)
    docs = documents(spark, SF_SMALL).cache()
    rows = {r.doc_id: r for r in docs.collect()}
    columns = docs.columns

    good = stage["quality_rules"](spark, docs, SF_SMALL).cache()
    assert good.columns == columns
    kept = {r.doc_id for r in quality_rules(docs).collect() if r.kept}
    assert {r.doc_id: r for r in good.collect()} == {i: rows[i] for i in kept}

    unique = stage["near_duplicates"](spark, good, SF_SMALL).cache()
    assert unique.columns == columns
    comps = brute_components([(i, rows[i].text) for i in sorted(kept)], 5, 80)
    firsts = {c for _, _, c in comps}
    assert {r.doc_id: r for r in unique.collect()} == {i: rows[i] for i in firsts} and len(firsts) < len(kept)

    clean = stage["decontamination"](spark, unique, SF_SMALL).cache()
    assert clean.columns == columns
    items = [r.text for r in documents(spark, SF_SMALL, "benchmark").collect()]
    leaks = {i for i in firsts if any(x.lower() in rows[i].text.lower() for x in items)}
    assert leaks and {r.doc_id: r for r in clean.collect()} == {i: rows[i] for i in firsts - leaks}

    mixed = stage["source_mixing"](spark, clean, SF_SMALL).cache()
    assert mixed.columns == columns
    copies = collections.Counter(r.doc_id for r in mixed.collect())
    assert set(copies) <= firsts - leaks and max(copies.values()) <= 3
    size = collections.Counter()
    taken = collections.Counter()
    for i in firsts - leaks:
        n = len(WORD.findall(rows[i].text))
        size[rows[i].source] += n
        taken[rows[i].source] += n * copies[i]
    assert abs(sum(taken.values()) - sum(size.values())) <= 0.2 * sum(size.values())

    packs = stage["token_packing"](spark, mixed, SF_SMALL)
    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as f:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    enc = tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=table, special_tokens={})
    want = collections.Counter()
    for i, k in copies.items():
        ids = enc.encode_ordinary(rows[i].text)
        for p in range(0, len(ids), packing.LENGTH):
            want[(i, p // packing.LENGTH, tuple(ids[p:p + packing.LENGTH]))] += k
    got = collections.Counter((r.doc_id, r.part, tuple(np.frombuffer(r.ids, "<u2").tolist())) for r in packing.segments(packs).collect())
    assert got == want

    again = corpus_pipeline.run(spark, SF_SMALL)
    assert sorted(map(tuple, again.drop("input_ids", "position_ids").collect())) == \
        sorted(map(tuple, packs.drop("input_ids", "position_ids").collect()))
