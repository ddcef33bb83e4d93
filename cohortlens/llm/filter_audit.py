"""What each filter removes, alone, after others, and in all orders.

The documents run through a stream in available-now micro-batches. Every row
is counted under the mask of the filters that its own text fails. The
duplicate filter depends on other rows: the state, keyed by text and stored
in buckets of a few thousand texts, holds the smallest doc_id of each and
what was counted for it. A larger id fails; when a smaller id arrives later,
what was counted before is retracted from its mask and counted again with
the duplicate bit. The counters of a part, one a
mask, then give every order of the filters without touching the texts again.
"""

from __future__ import annotations

import math
import os
import uuid
import zlib
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from cohortlens.llm.common import materialize, text_of
from cohortlens.session import checkpoint_dir, delete_on_exit

FILTERS = "ABCDE"
REPEATED = 16  # the bit of E
BATCHES = 8  # micro-batches over the files there are
CHUNK_ROWS = 200_000  # rows (a few dozen bytes each) that a task collapses at a time
BUCKET_TEXTS = 4096  # texts whose state is kept together, about
LEAST_BUCKETS = 64
NO_ID = (1 << 63) - 1  # a null doc_id: after all others


def text_mask(text) -> F.Column:
    """Bits of the filters A to D that a text fails."""
    # One space for the other blanks first: splitting by a plain character is much cheaper.
    words = F.array_remove(F.split(F.regexp_replace(text, r"[\x09-\x0D]", " "), " "), "")
    capitals = F.regexp_count(text, F.lit("[A-Z]"))
    n = F.size(words)
    fails = (n < 50, 100 * F.size(F.array_distinct(words)) < 65 * n, 100 * capitals.cast("long") > 5 * F.length(text).cast("long"),
             text.rlike(r"[#$%&*|]"))
    return sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(fails)), F.lit(0)).cast("int")


def label_flags(labels: DataFrame) -> DataFrame:
    """(id, flags): 1 for quality = 1, 2 for toxic = 1 in any row of the doc_id."""
    return (labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("id"))
            .agg((F.max(F.when(F.col("quality") == 1, 1).otherwise(0)) + F.max(F.when(F.col("toxic") == 1, 2).otherwise(0))).cast("int").alias("flags")))


_ROW = "bucket long, key string, id long, part string, flags int, mask int, n long"
_NAMES = ["bucket", "key", "id", "part", "flags", "mask", "n"]
_DELTA = "part string, mask int, flags int, n long"


def _smallest(rows: pd.DataFrame) -> np.ndarray:
    """For each row the smallest id of its text."""
    text = pd.factorize(rows["key"])[0]
    first = np.full(int(text.max(initial=-1)) + 1, NO_ID)
    np.minimum.at(first, text, rows["id"].to_numpy(np.int64))
    return first[text]


def _collapse(buckets: int):
    """Counters of all rows by part, flags and mask (without a key), and per
    text only what its smallest id of the stretch has: the rows of larger ids
    are repeats already."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0

        def flush() -> pa.RecordBatch:
            df = pd.concat(held, ignore_index=True)
            first = _smallest(df)
            by = ["part", "flags", "mask"]
            own = df[df["id"] == first].groupby(["bucket", "key", "id", *by], as_index=False).size().rename(columns={"size": "n"})
            counts = df.assign(mask=np.where(df["id"] > first, df["mask"] | REPEATED, df["mask"])).groupby(by, as_index=False).size()
            counts = counts.rename(columns={"size": "n"}).assign(key=None, id=NO_ID)
            counts["bucket"] = [zlib.crc32(p.encode()) % buckets for p in counts["part"]]
            out = pd.concat([own[_NAMES], counts[_NAMES].astype({"key": own["key"].dtype})], ignore_index=True)
            return pa.RecordBatch.from_pandas(out, schema=_SCHEMA, preserve_index=False)

        for b in batches:
            if b.num_rows:
                held.append(b.to_pandas())
                rows += b.num_rows
            if rows > CHUNK_ROWS:
                yield flush()
                held, rows = [], 0
        if held:
            yield flush()
    return run


_SCHEMA = pa.schema([("bucket", pa.int64()), ("key", pa.string()), ("id", pa.int64()), ("part", pa.string()), ("flags", pa.int32()),
                     ("mask", pa.int32()), ("n", pa.int64())])


def _first_ids(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """The state of a bucket of texts: per text its smallest id, and the rows
    that were counted for it without the duplicate bit."""
    import zstandard

    new = pd.concat(list(frames), ignore_index=True)
    names = ["part", "mask", "flags", "n"]
    out = [new.loc[new["key"].isna(), names]]
    rows = new[new["key"].notna()]
    if state.exists:
        with pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(state.get[0])) as held:
            rows = pd.concat([held.read_pandas(), rows], ignore_index=True)
    first = _smallest(rows)
    late = rows.loc[rows["id"] > first, names]  # held ones among them are retracted: a smaller id has come
    out += [late.assign(n=-late["n"]), late.assign(mask=late["mask"] | REPEATED)]
    own = rows[rows["id"] == first]
    if own.duplicated(_NAMES[:-1]).any():
        own = own.groupby(_NAMES[:-1], as_index=False)["n"].sum()
    held = pa.Table.from_pandas(own, schema=_SCHEMA, preserve_index=False)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, held.schema) as w:
        w.write_table(held)
    state.update((zstandard.ZstdCompressor(level=1).compress(sink.getvalue()),))
    yield pd.concat(out).groupby(names[:-1], as_index=False)["n"].sum()[names]


def stream_counters(spark: SparkSession, path: str, labels: DataFrame, run_dir: str, batches: int = BATCHES) -> DataFrame:
    """(part, mask, flags, n) over all files at ``path``. A later call with the
    same ``run_dir`` takes in only files that are new, and a run that was
    interrupted goes on where it stopped: offsets, state and the counter
    changes are all kept under ``run_dir``."""
    table = spark.read.parquet(path)
    files = len(table.inputFiles())
    # The number of buckets is fixed when a run begins.
    layout = os.path.join(run_dir, "layout")
    spark.range(1).select(F.lit(max(LEAST_BUCKETS, table.count() // BUCKET_TEXTS)).cast("long").alias("buckets")).write.mode("ignore").parquet(layout)
    buckets = spark.read.parquet(layout).first().buckets
    # A single file is named by a pattern, since the source wants a folder or one.
    src = path.rstrip("/")
    docs = (spark.readStream.schema(table.schema).option("basePath", os.path.dirname(src))
            .option("maxFilesPerTrigger", max(1, math.ceil(files / batches))).parquet(f"{src[:-1]}[{src[-1]}]"))
    text = text_of()
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
                       F.md5(text.cast("binary")).alias("key"), text_mask(text).alias("mask"), F.col("_metadata.row_index").alias("at"))
    # Rows without an id have no label; a key from their place spreads them.
    rows = rows.withColumn("known", F.col("id").isNotNull()).withColumn(
        "label_id", F.coalesce("id", F.xxhash64("key", "at")))
    flags = label_flags(labels).withColumn("known", F.lit(True)).withColumnRenamed("id", "label_id")
    rows = rows.join(materialize(flags, "fa_labels"), ["label_id", "known"], "left")
    rows = rows.select(F.pmod(F.xxhash64("key"), F.lit(buckets)).alias("bucket"), "key", F.coalesce("id", F.lit(NO_ID)).alias("id"), "part", F.coalesce("flags", F.lit(0)).alias("flags"), "mask")
    deltas = rows.mapInArrow(_collapse(buckets), _ROW).groupBy("bucket").applyInPandasWithState(
        _first_ids, _DELTA, "held binary", "append", GroupStateTimeout.NoTimeout)
    sink = os.path.join(run_dir, "deltas")
    q = (deltas.writeStream.format("parquet").outputMode("append").option("checkpointLocation", os.path.join(run_dir, "checkpoint"))
         .option("path", sink).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema(_DELTA).parquet(sink).groupBy("part", "mask", "flags").agg(F.sum("n").alias("n")).where("n <> 0")


def orders(spark: SparkSession) -> DataFrame:
    """(filter_order, step, before, bit) of the 120 orders: 600 rows."""
    rows = []
    for p in permutations(FILTERS):
        before = 0
        for step, f in enumerate(p, 1):
            bit = 1 << FILTERS.index(f)
            rows.append(("".join(p), step, before, bit))
            before |= bit
    return spark.createDataFrame(rows, "filter_order string, step int, before int, bit int")


def interactions(counters: DataFrame) -> DataFrame:
    """The audit of counters (part, mask, flags, n). What a step does depends
    on its filter and the set of filters before it, 80 cases a part."""
    spark = counters.sparkSession
    cases = [(before, 1 << i) for i in range(len(FILTERS)) for before in range(1 << len(FILTERS)) if not before >> i & 1]
    case = F.explode(F.array(*[F.struct(F.lit(b).alias("before"), F.lit(f).alias("bit")) for b, f in cases]))
    c = counters.select("*", case.alias("c")).select("part", "mask", "flags", "n", "c.before", "c.bit")
    fails, earlier = F.expr("mask & bit <> 0"), F.expr("mask & before <> 0")
    total = lambda cond, v=F.col("n"): F.sum(F.when(cond, v).otherwise(F.lit(0).cast("long"))).cast("long")
    here = fails & ~earlier
    c = c.groupBy("part", "before", "bit").agg(
        total(~fails & ~earlier).alias("kept"), total(here).alias("removed"), total(fails & earlier).alias("redundant"),
        total(F.col("mask") == F.col("bit")).alias("unique_fails"), total(here & F.expr("flags & 1 <> 0")).alias("good_lost"),
        total(here & F.expr("flags & 2 <> 0")).alias("toxic_lost"),
        # Of the filters that a row fails each is first in an equal share of the orders.
        total(fails, F.expr("n * (120 div greatest(bit_count(mask), 1))")).alias("shapley"))
    return c.join(F.broadcast(orders(spark)), ["before", "bit"]).select(  # 600 rows
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def audit_filters(spark: SparkSession, path: str, labels: DataFrame, run_dir: str | None = None, batches: int = BATCHES) -> DataFrame:
    """The filters A to E over the documents table at ``path``: per part,
    filter_order and step the counts kept, removed, redundant, unique_fails,
    good_lost, toxic_lost and shapley.

    A null text is empty and a null source the empty string. A null doc_id
    counts as larger than all others: such rows repeat any row with an id,
    but not each other. Rows that share a doc_id do not repeat each other,
    and have the labels of that id; of several label rows any 1 counts, null
    is 0. Other columns are not read. An empty table gives no rows. Texts are
    told apart by their md5. The state grows with the distinct texts; on a
    cluster the session should name RocksDB as its state store."""
    if run_dir is None:
        run_dir = os.path.join(checkpoint_dir(spark), "filter_audit", uuid.uuid4().hex)
        delete_on_exit(spark.sparkContext, run_dir)
    return interactions(materialize(stream_counters(spark, path, labels, run_dir, batches), "fa_counters"))
