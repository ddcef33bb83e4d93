"""Landing that knows what it has (U02, B42): a batch adds the rows whose key
the table does not hold, without reading the table to find out.

Beside the landing table lies its membership index (``operators.membership``),
stored and published with it. A batch probes the index first. Keys that it
calls absent are new; only the others are compared exactly, with the key
columns of the key ranges they fall into. The rows that are new and the
index with their keys become the next version together, so a batch that is
landed again, whole or in part, adds nothing.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.functions.text import clean_name
from cohortlens.operators import membership as mb
from cohortlens.operators.materialize import materialize
from cohortlens.session import checkpoint_dir, delete_on_exit
from cohortlens.sources.bindings import Gold
from cohortlens.sources.snapshots import Snapshot, SnapshotStore, ddl

RANGES = 64
KEYS_PER_RANGE = 1 << 16  # of a new index; it is built anew with more blocks when it is full


@dataclass(frozen=True)
class Landed:
    """What a batch did."""

    snapshot: Snapshot
    rows: int            # in the batch
    added: int
    maybe: int           # rows whose key the index could not rule out
    base_rows_read: int  # rows of the table that were compared with them
    base_rows: int       # in the table before


class IndexedLanding:
    def __init__(self, store: SnapshotStore, keys: Sequence[str], ranges: int = RANGES, keys_per_range: int = KEYS_PER_RANGE):
        """``ranges`` and ``keys_per_range`` are of a store's first batch; later
        ones go by what it was made with."""
        self.store, self.keys, self.ranges, self.keys_per_range = store, list(keys), ranges, keys_per_range

    def land(self, batch: DataFrame) -> Landed:
        """Add the rows of ``batch`` whose key (nulls equal nulls) the table does
        not hold. Rows of the batch that share a new key are all added."""
        s = self.store.latest()
        rows = materialize(batch.withColumn("__h", mb.key_hash(self.keys)), "batch")
        if s is None:
            return self._first(rows)
        m = s.table("index_meta").first()
        ranges, blocks = m.ranges, m.blocks
        rows = materialize(mb.probe(rows, s.table("index"), ranges, blocks), "probed")
        asked = rows.where("maybe")
        where = [r[0] for r in asked.select(mb.range_of("__h", ranges)).distinct().collect()]  # at most ``ranges``
        known = s.table("landing", where).select(*self.keys)
        here = known.select(*[F.col(k).alias(f"__b{i}") for i, k in enumerate(self.keys)]).distinct()
        same = [F.col(k).eqNullSafe(F.col(f"__b{i}")) for i, k in enumerate(self.keys)]
        new = materialize(rows.where("NOT maybe").unionByName(asked.join(here, same, "left_anti")).drop("maybe"), "new")
        added, maybe, n = new.count(), asked.count(), rows.count()
        read = known.count() if where else 0
        if not added:
            return Landed(s, n, 0, maybe, read, m.rows)
        folders = {p: list(f) for p, f in s.tables["landing"]["folders"].items()}
        for p, f in self._write(new, ranges).items():
            folders.setdefault(p, []).extend(f)
        distinct = m.keys + new.select("__h").distinct().count()
        if distinct > ranges * m.keys_per_range:  # full: twice the blocks, from the table's key columns
            per = m.keys_per_range
            while distinct > ranges * per:
                per *= 2
            blocks = mb.blocks_for(per)
            all_keys = s.table("landing").select(mb.key_hash(self.keys)).union(new.select("__h"))
            index = mb.build_index(all_keys, ranges, blocks)
        else:
            per, index = m.keys_per_range, mb.merge_index(s.table("index"), mb.build_index(new.select("__h"), ranges, blocks))
        snap = self.store.publish({"index": index, "index_meta": self._meta(ranges, blocks, per, distinct, m.rows + added)},
                                  {"landing": (folders, s.tables["landing"]["schema"])}, onto=s)
        return Landed(snap, n, added, maybe, read, m.rows)

    def _first(self, rows: DataFrame) -> Landed:
        n, distinct, per = rows.count(), rows.select("__h").distinct().count(), self.keys_per_range
        while distinct > self.ranges * per:
            per *= 2
        blocks = mb.blocks_for(per)
        snap = self.store.publish(
            {"index": mb.build_index(rows.select("__h"), self.ranges, blocks), "index_meta": self._meta(self.ranges, blocks, per, distinct, n)},
            {"landing": (self._write(rows, self.ranges), ddl(rows.drop("__h")))})
        return Landed(snap, n, n, 0, 0, 0)

    def _write(self, rows: DataFrame, ranges: int) -> dict:
        """In folders by key range, which AQE splits between tasks if large."""
        df = rows.withColumn("__range", mb.range_of("__h", ranges)).drop("__h").hint("rebalance", "__range")
        return self.store.write_parts(df, "landing", "__range")

    def _meta(self, ranges: int, blocks: int, per: int, keys: int, rows: int) -> DataFrame:
        return self.store.spark.createDataFrame([(ranges, blocks, per, keys, rows)], "ranges int, blocks int, keys_per_range long, keys long, rows long")


def merged_by_index(g: Gold, cutoff: str = "1998-01-01") -> DataFrame:
    """U02 on the bound data through the index: the sheets loaded before
    ``cutoff`` are landed, then the later ones."""
    b = g.bronze_lms.withColumn("name_norm", clean_name(F.col("User Name")))
    b = materialize(b, "bronze_lms")
    base = os.path.join(checkpoint_dir(g.spark), "indexed_landing", uuid.uuid4().hex)
    delete_on_exit(g.spark.sparkContext, base)
    landing = IndexedLanding(SnapshotStore(g.spark, base), ["Course Name", "name_norm"])
    cut = F.lit(cutoff).cast("date")
    landing.land(b.where(F.col("ingest_date") < cut))
    return landing.land(b.where(F.col("ingest_date") >= cut)).snapshot.table("landing")
