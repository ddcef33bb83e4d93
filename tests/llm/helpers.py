import re

from pyspark.sql import types as T

WORD = re.compile(r"[^\x20\x09-\x0D]+")

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])

# Columns that clash with names the operators use inside or return.
CLASHING = ("n_words", "size", "copies", "kept", "cid", "row_key", "posterior", "shard", "seed", "part")


def docs_df(spark, rows, clash=False):
    """rows: (doc_id, text[, source])."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "src0", len(r[1] or "")) for r in rows]
    df = spark.createDataFrame(full, DOCS)
    if clash:
        from pyspark.sql import functions as F
        for c in CLASHING:
            df = df.withColumn(c, F.lit("x"))
    return df


def sample(spark, n=220, sf="/root/testdata/sf0.01"):
    """The first documents of the shared test table, for brute-force checks."""
    df = spark.read.parquet(f"{sf}/documents.parquet").where(f"doc_id < {n}")
    return df.repartition(3)


def edge_rows():
    long = " ".join(f"word{i % 977}x{i}" for i in range(12_000))
    return [(1, None, None), (2, "", "a"), (3, " \t\n ", "a"), (4, "one", "b"), (4, "one", "b"), (5, long, "b"), (6, long, None),
            (7, "é ü ß 漢字 naïve", "c"), (None, "a row without an id " * 20, "c"), (8, "a row without an id " * 20, "c")]
