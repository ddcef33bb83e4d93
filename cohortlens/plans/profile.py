"""Cohort profiles and data summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.functions.numeric import fraction_part, parse_percent, round_half_even, zero_to_one
from cohortlens.functions.text import full_name
from cohortlens.operators.materialize import materialize
from cohortlens.operators.ranking import exact_quantiles
from cohortlens.operators.relational import share_of_total
from cohortlens.operators.scalar import attach_row
from cohortlens.plans.common import course_dim
from cohortlens.sources.bindings import Gold

SAMPLE_ROWS = 15
SAMPLE_SEED = 42
TOP_N = 3


def _moments(c) -> list[Column]:
    """n, mean, population and sample sd (Spark's running-moment aggregates,
    which neither overflow nor cancel), to six decimals. NaN counts as null."""
    v = F.nanvl(F.col(c).cast("double") if isinstance(c, str) else c.cast("double"), F.lit(None).cast("double"))
    return [F.count(v).alias("n"), round_half_even(F.avg(v), 6).alias("mean"),
            round_half_even(F.stddev_pop(v), 6).alias("std_pop"),
            round_half_even(F.stddev_samp(v), 6).alias("std_samp")]


def lms_view(g: Gold) -> DataFrame:
    """The joined LMS frame the cohort profile describes (fact x intern x course)."""
    return g.fact_lms_light.join(g.dim_intern, "intern_id", "left").join(course_dim(g), "course_id", "left")


def cohort_summary(g: Gold, approx: bool = False) -> DataFrame:
    """One row: the column names, rows, distinct courses, distinct interns,
    mean progress (the course names themselves: ``course_list``). ``approx`` counts distinct values with HyperLogLog++
    (``approx_count_distinct``) instead of an exact distinct."""
    v = lms_view(g)
    distinct = F.approx_count_distinct if approx else F.count_distinct
    return v.agg(F.lit(len(v.columns)).alias("n_columns"), F.lit(", ".join(v.columns)).alias("columns"), F.count(F.lit(1)).alias("total_rows"),
                 distinct("course_name").alias("unique_courses"),
                 distinct("intern_name").alias("unique_interns"),
                 F.avg("progress").alias("avg_progress"))


def course_list(g: Gold) -> DataFrame:
    """The distinct course names of the profile, as rows."""
    seen = g.fact_lms_light.select("course_id").distinct()
    return seen.join(course_dim(g), "course_id", "left").select("course_name").distinct()


def top_bottom_interns(g: Gold, n: int = TOP_N) -> DataFrame:
    """The n best and n worst interns by mean progress (name breaks ties).
    Each side is a distributed top-n (TakeOrderedAndProject), not a global sort."""
    per = lms_view(g).where(F.col("intern_name").isNotNull()).groupBy("intern_name").agg(
        F.avg("progress").alias("avg_progress"))
    top = per.orderBy(F.desc("avg_progress"), F.asc("intern_name")).limit(n).withColumn("side", F.lit("top"))
    bottom = per.orderBy(F.asc("avg_progress"), F.asc("intern_name")).limit(n).withColumn("side", F.lit("bottom"))
    return top.unionByName(bottom)


def sample_rows(g: Gold, n: int = SAMPLE_ROWS, seed: int = SAMPLE_SEED) -> DataFrame:
    """A seeded random sample of n LMS rows. Sampling is the feature; the
    order key is a digest of the row id and the seed, so the sample does not
    depend on partitioning. The rows are chosen before names are joined to them."""
    order = F.md5(F.concat_ws(":", F.col("lms_row_id").cast("string"), F.lit(str(seed))))
    chosen = materialize(g.fact_lms_light.orderBy(order, "lms_row_id").limit(n), "sample")
    interns = g.dim_intern.join(F.broadcast(chosen), "intern_id", "left_semi")  # n rows
    courses = g.dim_course.join(F.broadcast(chosen), "course_id", "left_semi")
    return chosen.join(interns, "intern_id", "left").join(courses, "course_id", "left")


def summary_json(g: Gold) -> DataFrame:
    """The cohort summary as one JSON document, the mean to six decimals."""
    s = cohort_summary(g)
    mean = F.format_string("%.6f", round_half_even(F.col("avg_progress"), 6)).alias("avg_progress")
    return s.select(F.to_json(F.struct("n_columns", "total_rows", "unique_courses", "unique_interns", mean)).alias("summary"))


# ---- B39: distribution profile of the raw sheets ----------------------------

def progress_per_course(g: Gold) -> DataFrame:
    """Per course: n, mean, population sd of the parsed progress values."""
    b = g.bronze_lms.select(F.col("Course Name").alias("course_name"),
                            parse_percent(F.col("Progress (%)")).alias("p"))
    return b.groupBy("course_name").agg(*_moments("p")[:3])


def status_shares(g: Gold) -> DataFrame:
    """Normalised frequency of each status (null read as 'Not Started')."""
    b = g.bronze_lms.select(F.coalesce(F.col("Overall Status"), F.lit("Not Started")).alias("status"))
    c = b.groupBy("status").agg(F.count(F.lit(1)).alias("n"))
    return share_of_total(c, "n", (), "share")


def ratio_profile(g: Gold) -> DataFrame:
    """Mean and population sd of the assignment, review, KC and test ratios,
    stacked long (one row per metric)."""
    b = g.bronze_lms
    rta, rs = F.col("Reviewed / Total Assignments"), F.col("Reviewed / Submitted")
    kc, te = F.col("Overall Knowledge Check"), F.col("Overall Test")
    ratios = {
        "assg_ratio": fraction_part(rta, 0, 0.0) / zero_to_one(fraction_part(rta, 1, 1.0)),
        "rev_sub_ratio": fraction_part(rs, 0, 0.0) / zero_to_one(fraction_part(rs, 1, 0.0)),
        "kc_ratio": fraction_part(kc, 0, 0.0) / zero_to_one(fraction_part(kc, 1, 1.0)),
        "test_ratio": fraction_part(te, 0, 0.0) / zero_to_one(fraction_part(te, 1, 1.0)),
    }
    long = b.select(F.explode(F.array(*[F.struct(F.lit(k).alias("metric"), v.alias("v"))
                                        for k, v in ratios.items()])).alias("x")).select("x.*")
    return long.groupBy("metric").agg(*_moments("v")[:3])


def mentors_per_course(g: Gold) -> DataFrame:
    """The distinct mentor strings seen per course, as rows (a list
    per course would gather an unbounded group into one value)."""
    b = g.bronze_lms.where(F.col("Mentor Name").isNotNull())
    return b.select(F.col("Course Name").alias("course_name"), F.col("Mentor Name").alias("mentor")).distinct()


def completed_assignment_values(g: Gold) -> DataFrame:
    """The distinct completed-assignment texts of the sheets, as rows."""
    return g.bronze_lms.where(F.col("Completed Assignment").isNotNull()).select(F.col("Completed Assignment").alias("value")).distinct()


def total_values(g: Gold) -> DataFrame:
    """The distinct denominators of the assignment, KC and test
    fractions, as (metric, value) rows."""
    b = g.bronze_lms
    long = b.select(F.explode(F.array(
        F.struct(F.lit("assg_total").alias("metric"),
                 fraction_part(F.col("Reviewed / Total Assignments"), 1, 1.0).alias("value")),
        F.struct(F.lit("kc_total").alias("metric"), fraction_part(F.col("Overall Knowledge Check"), 1, 1.0).alias("value")),
        F.struct(F.lit("test_total").alias("metric"), fraction_part(F.col("Overall Test"), 1, 1.0).alias("value")),
    )).alias("x")).select("x.*")
    return long.distinct()


def activity_shares(g: Gold) -> DataFrame:
    c = g.bronze_eod.groupBy(F.col("Activity").alias("activity")).agg(F.count(F.lit(1)).alias("n"))
    return share_of_total(c, "n", (), "share")


def eod_profile(g: Gold) -> DataFrame:
    """One row: hours mean / population sd / min / max, records per person
    (mean, sample sd, min, max) and the date range."""
    from cohortlens.functions.dates import parse_date
    e = g.bronze_eod
    hours = e.agg(*_moments("Hours")[1:3],
                  F.min("Hours").alias("hours_min"), F.max("Hours").alias("hours_max"))
    hours = hours.withColumnRenamed("mean", "hours_mean").withColumnRenamed("std_pop", "hours_std")
    per = e.groupBy(full_name(F.col("First Name"), F.col("Last Name")).alias("name")).agg(
        F.count(F.lit(1)).alias("r"))
    rec = per.agg(*_moments("r")[1:4:2], F.min("r").alias("records_min"), F.max("r").alias("records_max"))
    rec = rec.withColumnRenamed("mean", "records_mean").withColumnRenamed("std_samp", "records_std")
    d = e.select(parse_date(F.col("Date")).alias("d")).agg(F.min("d").alias("date_start"), F.max("d").alias("date_end"))
    return attach_row(attach_row(hours, rec), d)


# ---- B41: generation summary --------------------------------------------------

def status_mix(g: Gold) -> DataFrame:
    """Status counts with their percentage of all LMS rows (one decimal)."""
    c = g.bronze_lms.groupBy(F.col("Overall Status").alias("status")).agg(F.count(F.lit(1)).alias("n"))
    s = share_of_total(c, "n", (), "share")
    return s.select("status", "n", round_half_even(F.col("share") * 100, 1).alias("pct"))


def generation_summary(g: Gold) -> DataFrame:
    """One row: progress mean / median / sample sd and EOD hours mean / sample sd / min / max."""
    p = materialize(g.bronze_lms.select(parse_percent(F.col("Progress (%)")).alias("p")), "progress")
    pm = p.agg(*_moments("p"))
    pm = pm.select(F.col("mean").alias("progress_mean"), F.col("std_samp").alias("progress_std"))
    med = exact_quantiles(p, "p", [0.5], ["progress_median"])
    h = g.bronze_eod.agg(*_moments("Hours"), F.min("Hours").alias("hours_min"),
                         F.max("Hours").alias("hours_max"))
    h = h.select(F.col("mean").alias("hours_mean"), F.col("std_samp").alias("hours_std"), "hours_min", "hours_max")
    return attach_row(attach_row(pm, med), h)
