"""Role bindings: the shared TPC-H-like tables playing the cohort data model.

=================  =========================================================
gold role          derived from
=================  =========================================================
fact_activity      events: intern = user_id, date = UTC day of ts,
                   activity = event_type, hours = value
dim_intern         customer: intern_id = c_custkey, intern_name = c_name
fact_lms           orders (one LMS row per order) left-joined to per-order
                   lineitem counts: course = o_orderpriority,
                   progress = floor(o_totalprice / 5000),
                   status by o_orderstatus, assignments / scores from lines
dim_course         distinct o_orderpriority, CRS-%03d from its leading digit
bridge / mentors   nation and region name of the intern's customer row
=================  =========================================================

A bronze layer of raw strings (progress '50%', fractions 'a/b', day-first
dates, untrimmed lower-case names) is also derived, so that the cleaning
and star-schema build run on the same data. Every frame is lazy; nothing
is collected.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.functions.dates import utc_date
from cohortlens.sources.tables import read_table

# Fixed values of the binding.
PROGRESS_UNIT = 5000.0        # o_totalprice per progress point
KC_POINTS_PER_LINE = 50.0     # knowledge-check maximum per line item
TEST_POINTS_PER_LINE = 10.0   # test maximum per line item
STATUS_BY_ORDERSTATUS = {"F": "Completed", "O": "In Progress", "P": "Not Started"}
COURSE_START = "2024-01-01"   # bronze course calendar: course k starts k-1 weeks later
COURSE_WEEKS = 8


def _status(c):
    e = F.when(c == "F", STATUS_BY_ORDERSTATUS["F"]).when(c == "O", STATUS_BY_ORDERSTATUS["O"])
    return e.otherwise(STATUS_BY_ORDERSTATUS["P"])


def _course_no(priority):
    return F.split_part(priority, F.lit("-"), F.lit(1)).try_cast("int")


@dataclass
class Gold:
    """Gold star schema bound to the shared tables of one scale-factor folder."""

    spark: SparkSession
    sf_dir: str

    @classmethod
    def from_frames(cls, spark: SparkSession, **frames: DataFrame) -> "Gold":
        """Bind given frames to the roles (tests, or gold tables already on disk).

        Any role not given is derived as usual; ``fact_lms`` also serves
        as ``fact_lms_light``.
        """
        g = cls(spark, "<frames>")
        for name, df in frames.items():
            setattr(g, name, df)  # cached_property: the instance value wins
        if "fact_lms" in frames and "fact_lms_light" not in frames:
            g.fact_lms_light = frames["fact_lms"]
        return g

    def table(self, name: str) -> DataFrame:
        cache = self.__dict__.setdefault("_tables", {})
        if name not in cache:
            cache[name] = read_table(self.spark, self.sf_dir, name)
        return cache[name]

    # ---- per-order line counts (one aggregate, partial/final) ------------
    @cached_property
    def line_counts(self) -> DataFrame:
        li = self.table("lineitem")
        return li.groupBy("l_orderkey").agg(
            F.count(F.lit(1)).alias("n_lines"),
            F.count_if(F.col("l_linestatus") == "F").alias("n_done"),
            F.count_if(F.col("l_returnflag") != "N").alias("n_sub"),
            F.count_if(F.col("l_returnflag") == "R").alias("n_rev"),
            # Exact sums as integer hundredths (fast bigint aggregation).
            (F.sum(F.rint(F.col("l_quantity") * 100).cast("bigint")) / F.lit(100.0)).alias("qty"),
            F.sum(F.rint(F.col("l_discount") * 100).cast("bigint")).cast("double").alias("disc_pct_points"),
        )

    # ---- facts -----------------------------------------------------------
    @cached_property
    def fact_activity(self) -> DataFrame:
        e = self.table("events")
        return e.select(
            F.col("user_id").alias("intern_id"),
            utc_date("ts").alias("date"),
            F.col("event_type").alias("activity"),
            F.col("value").alias("hours"),
        )

    def _orders_lms(self, with_lines: bool = True) -> DataFrame:
        o = self.table("orders")
        cols = [
            F.col("o_orderkey").alias("lms_row_id"),
            F.col("o_custkey").alias("intern_id"),
            F.format_string("CRS-%03d", _course_no(F.col("o_orderpriority")) - 1).alias("course_id"),
            F.floor(F.col("o_totalprice") / PROGRESS_UNIT).cast("double").alias("progress"),
        ]
        if not with_lines:
            return o.select(*cols, _status(F.col("o_orderstatus")).alias("overall_status"))
        j = o.join(self.line_counts, o.o_orderkey == F.col("l_orderkey"), "left")
        n = F.col("n_lines")
        return j.select(
            *cols,
            F.coalesce(F.col("n_done"), F.lit(0)).cast("int").alias("reviewed"),
            F.coalesce(n, F.lit(1)).cast("int").alias("total_assg"),
            F.coalesce(F.col("n_rev"), F.lit(0)).cast("int").alias("rev_submitted"),
            F.coalesce(F.col("n_sub"), F.lit(0)).cast("int").alias("submitted"),
            _status(F.col("o_orderstatus")).alias("overall_status"),
            F.coalesce(F.col("qty").cast("double"), F.lit(0.0)).alias("kc_scored"),
            F.coalesce((n * KC_POINTS_PER_LINE).cast("double"), F.lit(1.0)).alias("kc_total"),
            F.coalesce(F.col("disc_pct_points"), F.lit(0.0)).alias("test_scored"),
            F.coalesce((n * TEST_POINTS_PER_LINE).cast("double"), F.lit(1.0)).alias("test_total"),
        )

    @cached_property
    def fact_lms(self) -> DataFrame:
        """One row per order: intern_id, course_id, progress, reviewed, total_assg,
        rev_submitted, submitted, overall_status, kc_*/test_* scores."""
        return self._orders_lms(True)

    @cached_property
    def fact_lms_light(self) -> DataFrame:
        """fact_lms without the line-item columns (no lineitem scan)."""
        return self._orders_lms(False)

    @cached_property
    def fact_lms_mentor(self) -> DataFrame:
        """fact_lms with the raw 'A, B' mentor string, as the LMS sheet has it."""
        return self.fact_lms.join(
            self.intern_mentors.select("intern_id", "mentor_string"), "intern_id", "left"
        ).withColumnRenamed("mentor_string", "mentor_name")

    # ---- dimensions ------------------------------------------------------
    @cached_property
    def dim_intern(self) -> DataFrame:
        return self.table("customer").select(
            F.col("c_custkey").alias("intern_id"), F.col("c_name").alias("intern_name"))

    @cached_property
    def dim_course(self) -> DataFrame:
        o = self.table("orders").select("o_orderpriority").distinct()
        return o.select(
            F.format_string("CRS-%03d", _course_no(F.col("o_orderpriority")) - 1).alias("course_id"),
            F.col("o_orderpriority").alias("course_name"))

    @cached_property
    def customer_profile(self) -> DataFrame:
        """intern_id, c_name, mentor_string ('NATION, REGION'): one pass over
        customer. nation and region have a fixed size by the data's spec
        (25 / 5 rows), so they are broadcast."""
        c = self.table("customer").select("c_custkey", "c_name", "c_nationkey")
        n = self.table("nation").select("n_nationkey", "n_name", "n_regionkey")
        r = self.table("region").select("r_regionkey", "r_name")
        nr = n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey).select(
            "n_nationkey", F.concat_ws(", ", "n_name", "r_name").alias("mentor_string"))
        return c.join(F.broadcast(nr), c.c_nationkey == nr.n_nationkey).select(
            F.col("c_custkey").alias("intern_id"), "c_name", "mentor_string")

    @cached_property
    def intern_mentors(self) -> DataFrame:
        """intern_id, mentor_string."""
        return self.customer_profile.select("intern_id", "mentor_string")

    @cached_property
    def bridge(self) -> DataFrame:
        """bridge_mentor_intern(mentor_name, intern_id): one row per pair."""
        from cohortlens.functions.text import mentor_list
        return self.intern_mentors.select(
            F.explode(mentor_list("mentor_string")).alias("mentor_name"), "intern_id")

    @cached_property
    def dim_mentor(self) -> DataFrame:
        return self.bridge.select("mentor_name").distinct()

    # ---- bronze (raw strings) ---------------------------------------------
    @cached_property
    def bronze_lms(self) -> DataFrame:
        """LMS sheet rows as raw strings, one per order."""
        o = self.table("orders")
        lc = self.line_counts
        j = o.join(lc, o.o_orderkey == lc.l_orderkey, "left") \
             .join(self.customer_profile, o.o_custkey == F.col("intern_id"), "left")
        n = F.col("n_lines")
        k = _course_no(F.col("o_orderpriority"))
        start = F.date_add(F.lit(COURSE_START).cast("date"), (k - 1) * 7)
        end = F.date_add(start, COURSE_WEEKS * 7 - 1)
        dated = k < 5
        no_lines = n.isNull()
        def txt(c, decimals=None):
            # Plain-notation text without java.util.Formatter (slow per row):
            # a decimal cast prints like '%.nf' for these exact values.
            return (c.cast(f"decimal(20,{decimals})") if decimals is not None else c).cast("string")

        def frac(a, b, sep="/", da=None, db=None):
            return F.concat(txt(a, da), F.lit(sep), txt(b, db))

        return j.select(
            F.col("o_orderkey").alias("row_id"),
            F.to_date("o_orderdate").alias("ingest_date"),
            F.concat(F.lit("  "), F.lower(F.replace(F.col("c_name"), F.lit("#"), F.lit(" "))), F.lit(" ")).alias("User Name"),
            F.col("o_orderpriority").alias("Course Name"),
            F.when(dated, F.date_format(start, "dd MMM yyyy")).alias("Start Date"),
            F.when(dated, F.date_format(end, "dd MMM yyyy")).alias("End Date"),
            F.col("mentor_string").alias("Mentor Name"),
            F.when(F.col("o_totalprice") >= PROGRESS_UNIT,
                   F.concat(txt(F.floor(F.col("o_totalprice") / PROGRESS_UNIT)), F.lit("%"))).alias("Progress (%)"),
            F.when(~no_lines, frac(F.col("n_done"), n)).alias("Completed Assignment"),
            F.when(~no_lines, frac(F.col("n_rev"), F.col("n_sub"))).alias("Reviewed / Submitted"),
            F.when(no_lines, F.lit("0 / 0")).otherwise(
                frac(F.col("qty"), n * KC_POINTS_PER_LINE, " / ", 1, 1)).alias("Overall Knowledge Check"),
            F.when(no_lines, F.lit("0 / 0")).otherwise(
                frac(F.col("disc_pct_points"), n * TEST_POINTS_PER_LINE, " / ", 2, 1)).alias("Overall Test"),
            F.when(no_lines, F.lit("-")).otherwise(frac(F.col("n_done"), n)).alias("Reviewed / Total Assignments"),
            F.when(F.col("o_orderstatus") == "F", "Completed").when(F.col("o_orderstatus") == "O", "In Progress")
             .otherwise(F.lit("-")).alias("Overall Status"),
        )

    @cached_property
    def bronze_eod(self) -> DataFrame:
        """EOD sheet rows as raw strings, one per event."""
        e = self.table("events")
        c = self.table("customer").select("c_custkey", "c_name")
        j = e.join(c, e.user_id == c.c_custkey, "left")
        return j.select(
            F.col("event_id").alias("row_id"),
            F.date_format(utc_date("ts"), "dd/MM/yyyy").alias("Date"),
            F.split_part(F.col("c_name"), F.lit("#"), F.lit(1)).alias("First Name"),
            F.concat(F.split_part(F.col("c_name"), F.lit("#"), F.lit(2)), F.lit(" ")).alias("Last Name"),
            F.col("event_type").alias("Activity"),
            F.col("value").alias("Hours"),
        )


def gold(spark: SparkSession, sf_dir: str) -> Gold:
    return Gold(spark, sf_dir)
