"""Every operator on nulls, empty and very long texts, repeated rows, clashing
columns and an empty table."""

import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from cohortlens.llm.decontaminate import find_leaks, remove_leaks
from cohortlens.llm.jaccard_join import jaccard_join, keep_one
from cohortlens.llm.mixing import apply_mix, mix_sources
from cohortlens.llm.packing import pack_documents
from cohortlens.llm.quality_classifier import classify_quality
from cohortlens.llm.quality_rules import apply_quality_rules, quality_rules
from cohortlens.llm.secret_scan import scan_secrets
from cohortlens.llm.sharding import reshard
from cohortlens.llm.suffix_dedup import suffix_dedup
from cohortlens.llm.token_counts import token_counts
from tests.llm.helpers import docs_df, edge_rows


def bench(spark):
    return spark.createDataFrame([(1, "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11 w12 w13 w14"), (2, None), (3, "")], "item_id long, text string")


OPS = {
    "op1": lambda s, d: classify_quality(d),
    "op2": lambda s, d: scan_secrets(d),
    "op4": lambda s, d: suffix_dedup(d),
    "op5": lambda s, d: quality_rules(d),
    "op6": lambda s, d: token_counts(d, P.path("word_bpe_49k.json")),
    "op7": lambda s, d: mix_sources(d),
    "op8": lambda s, d: jaccard_join(d),
    "op9": lambda s, d: reshard(d, F.lit(0)),
}


@pytest.mark.parametrize("op", OPS)
def test_one_row_per_row(spark, op):
    rows = edge_rows()
    out = OPS[op](spark, docs_df(spark, rows, clash=True)).collect()
    assert sorted(str(r.doc_id) for r in out) == sorted(str(r[0]) for r in rows)


@pytest.mark.parametrize("op", OPS)
def test_empty_table(spark, op):
    assert OPS[op](spark, docs_df(spark, [])).collect() == []


def test_stages_keep_columns(spark):
    d = docs_df(spark, edge_rows(), clash=True)
    b = bench(spark)
    for stage in (apply_quality_rules, keep_one, apply_mix, lambda x: remove_leaks(x, b)):
        assert stage(d).columns == d.columns
        assert stage(d.limit(0)).collect() == []
    ids = sorted(str(r.doc_id) for r in keep_one(d).collect())
    assert ids == ["1", "2", "3", "4", "5", "7", "8"]


def test_leaks_edges(spark):
    d = docs_df(spark, edge_rows() + [(20, "so W1 w2, w3 w4 w5 zz w7 w8 w9 w10 w11 w12 w13 w14 end")], clash=True)
    got = find_leaks(d, bench(spark)).collect()
    assert [(r.doc_id, r.item_id, r.matched, r.position) for r in got] == [(20, 1, 13, 1)]
    assert find_leaks(d.limit(0), bench(spark)).collect() == []
    assert find_leaks(d, bench(spark).limit(0)).collect() == []


def test_leaking_rows_only(spark):
    leak = "so w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11 w12 w13 w14 end"
    rows = [(None, leak), (None, "clean"), (None, None), (1, leak), (1, "clean too"), (2, "third"), (2, "third"), (3, leak), (3, leak)]
    got = [(r.doc_id, r.text) for r in remove_leaks(docs_df(spark, rows, clash=True), bench(spark)).collect()]
    assert sorted(got, key=str) == sorted([r for r in rows if r[1] != leak], key=str)


def test_packing_edges(spark):
    d = docs_df(spark, edge_rows(), clash=True)
    out = pack_documents(d, P.path("byte_bpe_50k.tiktoken"), P.PATTERN, length=512).collect()
    assert {x for r in out for x in r.doc_ids} == {3, 4, 5, 6, 7, 8, None}
    assert pack_documents(d.limit(0), P.path("byte_bpe_50k.tiktoken"), P.PATTERN).collect() == []
