import datetime as dt

from pyspark.sql import types as T

LMS_SCHEMA = T.StructType([
    T.StructField("lms_row_id", T.LongType()), T.StructField("intern_id", T.LongType()),
    T.StructField("course_id", T.StringType()), T.StructField("progress", T.DoubleType()),
    T.StructField("reviewed", T.IntegerType()), T.StructField("total_assg", T.IntegerType()),
    T.StructField("rev_submitted", T.IntegerType()), T.StructField("submitted", T.IntegerType()),
    T.StructField("overall_status", T.StringType()),
    T.StructField("kc_scored", T.DoubleType()), T.StructField("kc_total", T.DoubleType()),
    T.StructField("test_scored", T.DoubleType()), T.StructField("test_total", T.DoubleType())])
ACT_SCHEMA = T.StructType([
    T.StructField("intern_id", T.LongType()), T.StructField("date", T.DateType()),
    T.StructField("activity", T.StringType()), T.StructField("hours", T.DoubleType())])


def lms_rows(spark, rows):
    """rows: (intern_id, course_id, progress, reviewed, total, status[, kc_s, kc_t, te_s, te_t])"""
    out = []
    for i, r in enumerate(rows):
        iid, cid, p, rv, tot, st = r[:6]
        kc_s, kc_t, te_s, te_t = (r[6:10] if len(r) >= 10 else (0.0, 1.0, 0.0, 1.0))
        out.append((i + 1, iid, cid, p, rv, tot, 0, 0, st, kc_s, kc_t, te_s, te_t))
    return spark.createDataFrame(out, LMS_SCHEMA)


def act_rows(spark, rows):
    return spark.createDataFrame([(i, d, a, float(h)) for i, d, a, h in rows], ACT_SCHEMA)


def names(spark, ids):
    return spark.createDataFrame([(i, f"Intern {i}") for i in ids], "intern_id long, intern_name string")


def courses(spark, ids):
    return spark.createDataFrame([(c, f"Course {c}") for c in ids], "course_id string, course_name string")


def mentors(spark, pairs):
    return spark.createDataFrame(pairs, "intern_id long, mentor_string string")


D = dt.date
