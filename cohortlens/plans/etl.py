"""Bronze -> silver -> gold: cleaning, star schema, quality reports
(C01-C09, B01-B03, B40, U02-U04, R06, W04, W05).

Cleaning is pure column expressions (no UDF). Hash surrogate keys are a
deterministic function of the cleaned name, so facts compute their key in
place instead of joining the intern dimension; only membership tests
(EOD names must exist in LMS) need a join.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.functions.dates import parse_date
from cohortlens.functions.numeric import exact_sum, fraction_part, parse_percent, unsummable, zero_to_one
from cohortlens.functions.text import clean_name, full_name, mentor_list
from cohortlens.operators.ranking import rank_rows
from cohortlens.operators.relational import null_safe_join
from cohortlens.operators.scalar import attach_row
from cohortlens.plans.common import STATUS_VALUES, small_side
from cohortlens.operators.materialize import materialize
from cohortlens.sources.bindings import Gold

# The sheet layouts.
LMS_COLUMNS = ["User Name", "Course Name", "Start Date", "End Date", "Mentor Name", "Progress (%)",
               "Completed Assignment", "Reviewed / Submitted", "Overall Knowledge Check", "Overall Test",
               "Reviewed / Total Assignments", "Overall Status"]
EOD_COLUMNS = ["Date", "First Name", "Last Name", "Activity", "Hours"]
CODE_HEX_CHARS = 8


def intern_key(name):
    """md5(name) in full, the key of all joins: 32 bits of it would give
    two names one key from some 65 000 names on."""
    return F.md5(name)


def intern_code(name):
    """The sheet's short code, the first eight hex digits, for display."""
    return F.substring(F.md5(name), 1, CODE_HEX_CHARS)


def silver_lms(bronze: DataFrame) -> DataFrame:
    """C01-C08 on the LMS sheet."""
    st = F.coalesce(F.col("Overall Status"), F.lit("Not Started"))
    st = F.when(st == "-", F.lit("Not Started")).otherwise(st)
    prog = F.coalesce(F.col("Progress (%)"), F.lit("0%"))
    rta, rs = F.col("Reviewed / Total Assignments"), F.col("Reviewed / Submitted")
    kc, te = F.col("Overall Knowledge Check"), F.col("Overall Test")
    extra = [c for c in ("row_id", "ingest_date", "unparsed") if c in bronze.columns]
    return bronze.select(
        *extra,
        clean_name(F.col("User Name")).alias("intern_name"),
        F.col("Course Name").alias("course_name"),
        parse_date(F.col("Start Date")).alias("start_date"),
        parse_date(F.col("End Date")).alias("end_date"),
        F.col("Mentor Name").alias("mentor_name"),
        parse_percent(prog).alias("progress"),
        fraction_part(rta, 0, 0, as_int=True).alias("reviewed"),
        fraction_part(rta, 1, 1, as_int=True).alias("total_assg"),
        fraction_part(rs, 0, 0, as_int=True).alias("rev_submitted"),
        fraction_part(rs, 1, 0, as_int=True).alias("submitted"),
        st.alias("overall_status"),
        fraction_part(kc, 0, 0.0).alias("kc_scored"), zero_to_one(fraction_part(kc, 1, 1.0)).alias("kc_total"),
        fraction_part(te, 0, 0.0).alias("test_scored"), zero_to_one(fraction_part(te, 1, 1.0)).alias("test_total"),
    )


def silver_eod(bronze: DataFrame) -> DataFrame:
    """C04 / C09 on the EOD sheet: full name, day-first date."""
    extra = [c for c in ("row_id", "unparsed") if c in bronze.columns]
    return bronze.select(*extra, parse_date(F.col("Date")).alias("date"),
                         full_name(F.col("First Name"), F.col("Last Name")).alias("full_name"),
                         F.col("Activity").alias("activity"), F.col("Hours").cast("double").alias("hours"))


def dim_intern(lms: DataFrame) -> DataFrame:
    """SCD-1 intern dimension: distinct cleaned names with the hash key.
    Rows without a name are quarantined, not named 'Nan'."""
    return lms.where(F.col("intern_name").isNotNull()).select("intern_name").distinct() \
              .select("intern_name", intern_key(F.col("intern_name")).alias("intern_id"),
                      intern_code(F.col("intern_name")).alias("intern_code"))


def dim_course(lms: DataFrame, first_id: int = 0, fmt: str | None = "CRS-%03d") -> DataFrame:
    """Distinct (course, start, end) numbered by key order (Spark has no
    row order, so 'first appearance' is defined by the key)."""
    d = lms.select("course_name", "start_date", "end_date").distinct()
    r = rank_rows(d, [F.asc_nulls_first("course_name"), F.asc_nulls_first("start_date"),
                      F.asc_nulls_first("end_date")], name="__r")
    key = F.col("__r") - 1 + first_id
    return r.select("course_name", "start_date", "end_date",
                    (F.format_string(fmt, key) if fmt else key).alias("course_id"))


def dim_mentor(lms: DataFrame) -> DataFrame:
    """Split the 'A, B' mentor lists, explode, distinct."""
    return lms.select(F.explode(mentor_list("mentor_name")).alias("mentor_name")).distinct()


class Star:
    """The gold star schema built from the raw sheets, one lazy table
    per attribute. With ``materialized`` the silver tables are written once
    (shared checkpoint folder) before several tables read them."""

    def __init__(self, g: Gold, materialized: bool = False):
        self.g, self.materialized = g, materialized

    def __getitem__(self, name: str) -> DataFrame:
        return getattr(self, name)

    @cached_property
    def silver_lms(self) -> DataFrame:
        df = silver_lms(self.g.bronze_lms)
        return materialize(df, "silver_lms") if self.materialized else df

    @cached_property
    def silver_eod(self) -> DataFrame:
        df = silver_eod(self.g.bronze_eod)
        return materialize(df, "silver_eod") if self.materialized else df

    @cached_property
    def dim_intern(self) -> DataFrame:
        return dim_intern(self.silver_lms)

    @cached_property
    def dim_course(self) -> DataFrame:
        d = dim_course(self.silver_lms)
        return small_side(d, "dim_course") if self.materialized else d

    @cached_property
    def dim_mentor(self) -> DataFrame:
        return dim_mentor(self.silver_lms)

    @cached_property
    def fact_lms(self) -> DataFrame:
        named = self.silver_lms.where(F.col("intern_name").isNotNull())
        return null_safe_join(named, self.dim_course, ["course_name", "start_date", "end_date"]).select(
            "row_id", intern_key(F.col("intern_name")).alias("intern_id"), "course_id", "progress", "reviewed",
            "total_assg", "rev_submitted", "submitted", "overall_status", "mentor_name",
            "kc_scored", "kc_total", "test_scored", "test_total")

    @cached_property
    def fact_activity(self) -> DataFrame:
        # EOD rows count only for names known to the LMS sheet (inner-join semantics).
        known = self.silver_eod.join(self.dim_intern.select(F.col("intern_name").alias("full_name")),
                                     "full_name", "left_semi")
        return known.select("row_id", "date", intern_key(F.col("full_name")).alias("intern_id"), "activity", "hours")


def star_schema(g: Gold, materialized: bool = False) -> Star:
    return Star(g, materialized)


class SequentialStar:
    """Integer surrogate keys from 1001 (interns) and 501 (courses), one
    lazy table per attribute: a table reads only what it is made of."""

    def __init__(self, g: Gold):
        self.g = g

    def __getitem__(self, name: str) -> DataFrame:
        return getattr(self, name)

    @cached_property
    def silver_lms(self) -> DataFrame:
        return silver_lms(self.g.bronze_lms)

    @cached_property
    def dim_intern(self) -> DataFrame:
        names = self.silver_lms.where(F.col("intern_name").isNotNull()).select("intern_name").distinct()
        return rank_rows(names, [F.asc("intern_name")], name="__r").select(
            "intern_name", (F.col("__r") + 1000).alias("intern_id"))

    @cached_property
    def dim_course(self) -> DataFrame:
        return dim_course(self.silver_lms, first_id=501, fmt=None)

    @cached_property
    def fact_progress(self) -> DataFrame:
        # The sheet is read three times here, once for each key and once for the rows.
        once = SequentialStar(self.g)
        once.silver_lms = materialize(self.silver_lms, "silver_lms")
        courses = small_side(once.dim_course, "dim_course")
        return null_safe_join(once.silver_lms.join(once.dim_intern, "intern_name"), courses, ["course_name", "start_date", "end_date"]) \
            .select("row_id", "intern_id", "course_id", "progress", "reviewed", "total_assg", "overall_status")

    @cached_property
    def fact_effort(self) -> DataFrame:
        return silver_eod(self.g.bronze_eod).join(self.dim_intern.withColumnRenamed("intern_name", "full_name"), "full_name") \
            .select("row_id", "date", "intern_id", "activity", "hours")


def star_schema_sequential(g: Gold) -> SequentialStar:
    return SequentialStar(g)


def key_collisions(g: Gold) -> DataFrame:
    """Display codes shared by more than one name (the keys themselves are whole
    digests)."""
    di = star_schema(g)["dim_intern"]
    return di.groupBy("intern_code").agg(F.count(F.lit(1)).alias("n_names")).where(F.col("n_names") > 1)


def quality_report(g: Gold, outlier_hours: float = 12.0) -> DataFrame:
    """The profiling counters as one row (the sheet's ten, the count of
    progress texts that do not parse and of hours that cannot be summed).

    Each sheet is cleaned and written once; the LMS counters then need one
    plain aggregate and one per key, the EOD ones a single (name, day)
    aggregate joined to the known names."""
    raw = g.bronze_lms
    flag = F.col("Progress (%)").isNotNull() & parse_percent(F.col("Progress (%)")).isNull()
    lms = materialize(silver_lms(raw.withColumn("unparsed", flag)), "silver_lms")
    named = F.col("intern_name").isNotNull()
    plain = lms.agg(F.count_if(named).alias("fact_lms_rows"), F.count_if(named & (F.col("progress") > 100)).alias("invalid_progress"),
                    F.count_if("unparsed").alias("unparsed_progress"))
    # Duplicates beyond the first per (name, course); null keys group together.
    per_name = materialize(lms.groupBy("intern_name", "course_name").agg(F.count(F.lit(1)).alias("n"))
                           .groupBy("intern_name").agg(F.sum(F.col("n") - 1).alias("extra")), "names")
    people = per_name.agg(F.count("intern_name").alias("unique_interns"), F.coalesce(F.sum("extra"), F.lit(0)).alias("duplicates"))
    courses = lms.select("course_name", "start_date", "end_date").distinct().agg(F.count(F.lit(1)).alias("courses"))
    mentors = dim_mentor(lms.select("mentor_name").distinct()).agg(F.count(F.lit(1)).alias("mentors"))
    daily = silver_eod(g.bronze_eod).groupBy("full_name", "date").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("hours") < 0).alias("negative"), exact_sum("hours").alias("h"),
        unsummable("hours").alias("bad"))
    known = per_name.where(named).select(F.col("intern_name").alias("full_name"), F.lit(True).alias("known"))
    is_known = F.col("known").isNotNull()
    total = lambda c, cond: F.coalesce(F.sum(F.when(cond, F.col(c))), F.lit(0))
    effort = daily.join(known, "full_name", "left").agg(
        total("n", is_known).alias("fact_activity_rows"), total("negative", is_known).alias("invalid_hours"),
        total("n", ~is_known).alias("orphan_records"), total("bad", is_known).alias("unsummable_hours"),
        F.count_if(is_known & F.col("date").isNotNull() & (F.col("h") > outlier_hours)).alias("outlier_days"))
    out = people
    for one_row in (courses, mentors, plain, effort):
        out = attach_row(out, one_row)
    return out.select("unique_interns", "courses", "mentors", "fact_lms_rows", "fact_activity_rows", "duplicates", "invalid_hours",
                      "invalid_progress", "orphan_records", "outlier_days", "unparsed_progress", "unsummable_hours")


def merge_new(base: DataFrame, new: DataFrame, keys=("course_name", "name_norm")) -> DataFrame:
    """Base plus the rows of ``new`` whose key is absent from base
    (left-anti join, null-safe), unioned by name."""
    keys = list(keys)
    bk = base.select(*keys).distinct()
    cond = [new[k].eqNullSafe(bk[k]) for k in keys]
    add = new.join(bk, cond, "left_anti")
    return base.unionByName(add, allowMissingColumns=True)


def merged_lms(g: Gold, cutoff: str = "1998-01-01") -> DataFrame:
    """U02 on the bound data: sheets loaded before ``cutoff`` are the base,
    later ones the new batch; a new row is added only if its person is not
    in the base sheet of the same course."""
    b = materialize(g.bronze_lms.withColumn("name_norm", clean_name(F.col("User Name"))), "bronze_lms")
    base = b.where(F.col("ingest_date") < F.lit(cutoff).cast("date"))
    new = b.where(F.col("ingest_date") >= F.lit(cutoff).cast("date"))
    return merge_new(base, new, ["Course Name", "name_norm"])


def validate_output(g: Gold, expected_interns: int | None = None) -> DataFrame:
    """The nine sheet checks as rows (check, scope, passed, detail).

    The names of the LMS sheets must be as many as the cohort has interns;
    every sheet has a row for each of them and every one logs effort.
    ``expected_interns`` defaults to the size of the intern dimension. A null
    progress or null hours is outside any range, so its check fails."""
    lms = materialize(g.bronze_lms.select(*LMS_COLUMNS) if set(LMS_COLUMNS) <= set(g.bronze_lms.columns) else g.bronze_lms, "bronze_lms")
    eod = g.bronze_eod
    own = ("row_id", "ingest_date")  # lineage that the binding adds, not part of a sheet
    lms_ok = [c for c in g.bronze_lms.columns if c not in own] == LMS_COLUMNS
    eod_ok = [c for c in eod.columns if c not in own] == EOD_COLUMNS
    # Cohort-wide counts, one row, computed once and broadcast.
    n_names = lms.select(F.col("User Name").alias("n")).distinct().agg(F.count(F.lit(1)).alias("n_names"))
    expected = (g.spark.range(1).select(F.lit(expected_interns).cast("long").alias("n_interns")) if expected_interns is not None
                else g.dim_intern.agg(F.count_distinct("intern_id").alias("n_interns")))
    in_range = F.coalesce(F.col("Hours").between(0.0, 10.0), F.lit(False))
    eod_stats = eod.agg(F.coalesce(F.bool_and(in_range), F.lit(True)).alias("hours_ok"))
    # A missing part makes the whole name missing, which counts as one name.
    eod_names = eod.select(F.concat("First Name", F.lit(" "), "Last Name").alias("n")).distinct() \
                   .agg(F.count(F.lit(1)).alias("eod_names"))
    stats = attach_row(attach_row(attach_row(n_names, expected), eod_stats), eod_names)
    prog = parse_percent(F.col("Progress (%)"))
    per_course = lms.groupBy(F.col("Course Name").alias("scope")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.bool_and(F.coalesce(prog.between(0, 100), F.lit(False))).alias("prog_ok"),
        F.bool_and(F.coalesce(F.col("Overall Status").isin(*STATUS_VALUES), F.lit(False))).alias("status_ok"),
        F.min(F.when(F.col("Overall Status") == "Completed", prog)).alias("min_done_prog"))
    per_course = attach_row(per_course, stats)
    checks = per_course.select(F.explode(F.array(
        F.struct(F.lit("lms_schema").alias("check"), "scope", F.lit(lms_ok).alias("passed"),
                 F.lit("12 columns in order").alias("detail")),
        F.struct(F.lit("row_count").alias("check"), "scope", (F.col("rows") == F.col("n_interns")).alias("passed"),
                 F.format_string("%d rows", F.col("rows")).alias("detail")),
        F.struct(F.lit("progress_range").alias("check"), "scope", F.col("prog_ok").alias("passed"),
                 F.lit("0..100").alias("detail")),
        F.struct(F.lit("status_values").alias("check"), "scope", F.col("status_ok").alias("passed"),
                 F.lit("known spellings").alias("detail")),
        F.struct(F.lit("completed_progress").alias("check"), "scope",
                 F.coalesce(F.col("min_done_prog") >= 30, F.lit(True)).alias("passed"),
                 F.lit("completed => progress >= 30").alias("detail")))).alias("x")).select("x.*")
    glob = stats.select(F.explode(F.array(
        F.struct(F.lit("eod_schema").alias("check"), F.lit("eod").alias("scope"), F.lit(eod_ok).alias("passed"),
                 F.lit("5 columns in order").alias("detail")),
        F.struct(F.lit("unique_names").alias("check"), F.lit("lms").alias("scope"), (F.col("n_names") == F.col("n_interns")).alias("passed"),
                 F.format_string("%d names", F.col("n_names")).alias("detail")),
        F.struct(F.lit("hours_range").alias("check"), F.lit("eod").alias("scope"), F.col("hours_ok").alias("passed"),
                 F.lit("0..10").alias("detail")),
        F.struct(F.lit("eod_coverage").alias("check"), F.lit("eod").alias("scope"),
                 (F.col("eod_names") == F.col("n_interns")).alias("passed"),
                 F.format_string("%d names", F.col("eod_names")).alias("detail")),
    )).alias("x")).select("x.*")
    return checks.unionByName(glob)
