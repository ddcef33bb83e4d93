"""Warehouse reload views and set checks."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.functions.text import clean_name, full_name, mentor_list
from cohortlens.operators.relational import keep_last, scoped_view
from cohortlens.plans.activity import daily_hours
from cohortlens.plans.common import STATUS_VALUES, Params, hours_sum
from cohortlens.session import checkpoint_dir, delete_on_exit
from cohortlens.sources.bindings import Gold
from cohortlens.sources.clustered import read_clustered, write_clustered


def latest_lms_rows(g: Gold) -> DataFrame:
    """The latest LMS row (highest row id) per (intern, course)."""
    return keep_last(g.fact_lms_light, ["intern_id", "course_id"], "lms_row_id")


def dim_mentor_from_facts(g: Gold) -> DataFrame:
    """The mentor dimension rebuilt from the facts' mentor strings."""
    return g.fact_lms_mentor.select(F.explode(mentor_list("mentor_name")).alias("mentor_name")).distinct()


def outlier_count(g: Gold, limit: float = 12.0) -> DataFrame:
    """Number of (intern, day) totals above ``limit`` hours."""
    d = g.fact_activity.where(F.col("date").isNotNull()).groupBy("intern_id", "date").agg(hours_sum().alias("h"))
    return d.agg(F.count_if(F.col("h") > limit).alias("outlier_days"))


def unknown_statuses(g: Gold) -> DataFrame:
    """Status values of the raw sheet outside the known spellings (set
    difference as a left-anti join against the valid set)."""
    valid = g.spark.createDataFrame([(s,) for s in STATUS_VALUES], "status string")
    seen = g.bronze_lms.select(F.col("Overall Status").alias("status")).where(F.col("status").isNotNull()).distinct()
    return seen.join(F.broadcast(valid), "status", "left_anti")


def name_union(g: Gold) -> DataFrame:
    """Size of the union of person names across the LMS and EOD sheets."""
    lms = g.bronze_lms.select(clean_name(F.col("User Name")).alias("name"))
    eod = g.bronze_eod.select(full_name(F.col("First Name"), F.col("Last Name")).alias("name"))
    return lms.union(eod).where(F.col("name").isNotNull()).distinct().agg(F.count(F.lit(1)).alias("n_names"))


def signed_in_mentor_dim(g: Gold, name: str) -> DataFrame:
    """the mentor dimension restricted to the signed-in mentor, or the
    whole dimension when the name is not found."""
    return scoped_view(g.dim_mentor, "mentor_name", name)


def persist_gold(g: Gold) -> Gold:
    """Keep the gold tables in executor memory (spilling to disk) for a
    run of many queries; ``release_gold`` frees them. No time-to-live: the
    caller decides when the data is stale."""
    for name in ("fact_lms", "fact_activity", "dim_intern", "dim_course", "bridge"):
        getattr(g, name).persist()
    return g


def release_gold(g: Gold) -> None:
    for name in ("fact_lms", "fact_activity", "dim_intern", "dim_course", "bridge"):
        getattr(g, name).unpersist()


def clustered_daily_hours(g: Gold, p: Params) -> DataFrame:
    """The activity fact written clustered by intern and date, and the
    daily hours of a date range out of the files that the range needs."""
    path = os.path.join(checkpoint_dir(g.spark), "tables", f"clustered-{uuid.uuid4().hex}")
    write_clustered(g.fact_activity, path, files=int(g.spark.conf.get("spark.sql.shuffle.partitions")))
    delete_on_exit(g.spark.sparkContext, path)
    rows = read_clustered(g.spark, path, dates=(p.start, p.end))
    return daily_hours(Gold.from_frames(g.spark, fact_activity=rows))
