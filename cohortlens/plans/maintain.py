"""Gold kept current by changes instead of rebuilds.

The stored facts lie in folders by a hash of the intern. A batch of changes
(rows inserted, replaced or deleted, by row id) names the interns it affects:
those of the new rows and those whose old rows go. Only their folders are
read and written again, and in them only their totals are computed anew; all
other folders are carried into the next version by name. The version is
published by one manifest, so readers see all tables before the change or all
after it.

The risk score also depends on the last date of the whole cohort, so the store
keeps what the score is made of (totals per intern, hours per intern and day)
and the score itself is computed when it is read, from those small tables.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.operators.materialize import materialize
from cohortlens.plans.common import hours_sum
from cohortlens.plans.risk import activity_windows, lms_totals, risk_scores
from cohortlens.session import checkpoint_dir, delete_on_exit
from cohortlens.sources.bindings import Gold
from cohortlens.sources.snapshots import Snapshot, SnapshotStore, ddl

FOLDERS = 64  # per table; a parameter of a new store
# Fact -> (row id, the table of totals made from it).
FACTS = {"fact_lms": ("lms_row_id", "lms_totals"), "fact_activity": ("row_id", "daily_hours")}


def daily_totals(fact_activity: DataFrame) -> DataFrame:
    """Hours per intern and day; rows without a date are a day of their own."""
    return fact_activity.groupBy("intern_id", "date").agg(hours_sum().alias("hours"))


_TOTALS = {"fact_lms": lms_totals, "fact_activity": daily_totals}


def _in_folders(df: DataFrame, folders: int) -> DataFrame:
    """With the column ``folder``; AQE splits a large folder between tasks."""
    return df.withColumn("folder", F.pmod(F.xxhash64("intern_id"), F.lit(folders)).cast("int")).hint("rebalance", "folder")


def _write(store: SnapshotStore, df: DataFrame, name: str, folders: int) -> dict:
    return store.write_parts(_in_folders(df, folders), name, "folder")


def create(store: SnapshotStore, fact_lms: DataFrame, fact_activity: DataFrame, dim_intern: DataFrame, folders: int = FOLDERS) -> Snapshot:
    """The first version of a store: the facts (with their row ids), their
    totals and the intern dimension."""
    named = {}
    for fact, df in (("fact_lms", fact_lms), ("fact_activity", fact_activity)):
        named[fact] = (_write(store, df, fact, folders), ddl(df))
        stored = store.spark.read.schema(ddl(df)).parquet(*[f for fs in named[fact][0].values() for f in fs]) if named[fact][0] else df
        totals = _TOTALS[fact](stored)
        named[FACTS[fact][1]] = (_write(store, totals, FACTS[fact][1], folders), ddl(totals))
    layout = store.spark.range(1).select(F.lit(folders).alias("folders"))
    return store.publish({"dim_intern": dim_intern, "layout": layout}, named)


def apply_changes(store: SnapshotStore, changes: dict[str, DataFrame]) -> Snapshot:
    """The next version after ``changes``: fact -> rows of the fact's columns
    and ``op``. 'upsert' replaces the row of that id, or adds it; 'insert'
    promises that the id is new, so the facts are not searched for it;
    'delete' needs only the id. One id comes once in a batch. Equal to a
    rebuild from the changed facts."""
    old = store.latest()
    folders = old.table("layout").first().folders
    named = {}
    for fact, df in changes.items():
        row_id, total = FACTS[fact]
        columns = old.table(fact).columns
        ch = materialize(df.select("op", *columns), "changes")
        # Whose rows change: the new rows' interns, and those of the rows that
        # are replaced or deleted, found by id in two columns of the fact.
        ids = ch.where("op <> 'insert'").select(row_id)
        owners = ch.where("op <> 'delete'").select("intern_id")
        gone = old.table(fact).select(row_id, "intern_id").join(ids, row_id, "left_semi").select("intern_id")
        who = materialize(owners.union(gone).distinct(), "affected")
        touched = [r[0] for r in _in_folders(who, folders).select("folder").distinct().collect()]  # at most ``folders``
        if not touched:
            continue
        rows = old.table(fact, touched).join(ids, row_id, "left_anti")
        rows = rows.unionByName(ch.where("op <> 'delete'").select(*columns))
        new = _write(store, rows, fact, folders)
        named[fact] = _next(old, fact, new, touched)
        # Totals: carried for the other interns of the folders, made anew for these.
        schema = old.tables[fact]["schema"]
        stored = store.spark.read.schema(schema).parquet(*[f for fs in new.values() for f in fs]) if new else old.table(fact, [])
        fresh = _TOTALS[fact](_members(stored, who))
        kept = _members(old.table(total, touched), who, "left_anti")
        named[total] = _next(old, total, _write(store, kept.unionByName(fresh), total, folders), touched)
    return store.publish(folders=named, onto=old)


def _members(df: DataFrame, who: DataFrame, how: str = "left_semi") -> DataFrame:
    w = who.withColumnRenamed("intern_id", "__who")
    return df.join(w, F.col("intern_id").eqNullSafe(F.col("__who")), how)


def _next(old: Snapshot, name: str, new: dict, touched: list) -> tuple[dict, str]:
    gone = {str(t) for t in touched}
    return {**{p: f for p, f in old.tables[name]["folders"].items() if p not in gone}, **new}, old.tables[name]["schema"]


def maintained_risk(s: Snapshot) -> DataFrame:
    """B04 from the stored totals of a version."""
    return risk_scores(s.table("lms_totals"), activity_windows(s.table("daily_hours")), s.table("dim_intern"))


def risk_after_changes(g: Gold, cutoff: str = "2024-01-20") -> DataFrame:
    """B01/B04 on the bound data: a store built from an early state of it (events
    before ``cutoff``; rows with other hours and progress; rows that will be
    deleted) takes in two batches that make it the whole data."""
    spark = g.spark
    base = os.path.join(checkpoint_dir(spark), "maintained", uuid.uuid4().hex)
    delete_on_exit(spark.sparkContext, base)
    store = SnapshotStore(spark, base)
    e = g.table("events")
    act = materialize(g.fact_activity.withColumn("row_id", F.lit(None).cast("long")).limit(0).unionByName(
        e.select(F.col("event_id").alias("row_id"), F.col("user_id").alias("intern_id"), F.to_date("ts").alias("date"),
                 F.col("event_type").alias("activity"), F.col("value").alias("hours"))), "activity")
    lms = materialize(g.fact_lms, "lms")
    late = F.coalesce(F.col("date") >= F.lit(cutoff).cast("date"), F.lit(True))
    week = F.col("date").between(F.date_sub(F.lit(cutoff).cast("date"), 3), F.lit(cutoff).cast("date"))
    wrong = act.where(~late).withColumn("hours", F.when(week, F.col("hours") + 1).otherwise(F.col("hours")))
    extra = act.where(~late & week).withColumn("row_id", -1 - F.col("row_id"))
    done = F.col("overall_status") == "Completed"
    early = lms.withColumn("progress", F.when(done, F.col("progress") / 2).otherwise(F.col("progress")))
    create(store, early, wrong.unionByName(extra), g.dim_intern)
    op = lambda df, o: df.withColumn("op", F.lit(o))
    apply_changes(store, {"fact_activity": op(act.where(late), "insert").unionByName(op(extra, "delete"))})
    last = apply_changes(store, {"fact_activity": op(act.where(~late & week), "upsert"), "fact_lms": op(lms.where(done), "upsert")})
    return maintained_risk(last)
