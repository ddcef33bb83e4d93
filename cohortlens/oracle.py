"""DuckDB twins of the registered queries (the correctness oracle).

Each statement recreates the role bindings from the raw tables as CTEs
(``GOLD``) and then computes the same result as the Spark plan with plain
SQL. Conventions shared with the Spark side: hour sums are taken as
DECIMAL(38,7); decimal half-even rounding goes through DECIMAL(38,9).
"""

from __future__ import annotations

# Texts as the sheets show them, written out here so that a wrong text in a plan does not pass.
BANNER_BELOW_MEDIAN = "📈 **Almost There!** You're **%.1f hrs** below the cohort median. A little extra daily effort will move your rank significantly!"
BANNER_NOT_STARTED = "⚡ **Heads Up!** You haven't started **%d course(s)** yet. Every day counts — time to dive in!"
BANNER_ON_TRACK = "✅ **On Track!** You've logged **%.0f hrs** and your effort is above the cohort median. Consistency is your superpower!"
BANNER_TOP = "🚀 **Top Tier Alert!** Your average progress is **%.0f%%** — you're outpacing most of your cohort. Keep crushing it!"
CARD_BACKLOG = ('📝 Review Backlog', '**%d assignments** are awaiting your review across %d intern-course combinations.')
CARD_CLEAR = ('✅ All Clear!', 'No urgent action items. Your cohort is performing well!')
CARD_MEDIUM = ('⚡ Medium Risk Watch', '%d interns are trending downward in effort. Consider a group check-in.')
CARD_URGENT = ('🚨 Urgent: At-Risk Interns', '%d intern(s) need immediate check-in')
PLAN_HIGH = '%s needs help now: mean progress %s after %s of logged effort. Meet today, agree on one small next step per open course, and find a study partner in the cohort.'
PLAN_MEDIUM = '%s is slowing down: mean progress %s after %s of logged effort. Ask in writing what is blocking, suggest the assignment closest to done, and look again in three days.'
PLAN_LOW = '%s is doing fine: mean progress %s after %s of logged effort. Say so, and offer a task that lets others learn from it.'


def lit(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("'", "''") + "'"


def rhe(expr: str, digits: int = 1) -> str:
    """Half-even rounding matching ``functions.round_half_even``."""
    return f"CAST(round_even(CAST(({expr}) AS DECIMAL(38,9)), {digits}) AS DOUBLE)"


def hsum(expr: str = "hours") -> str:
    return f"CAST(sum(CAST(({expr}) AS DECIMAL(38,7))) AS DOUBLE)"


COURSE_ID = "printf('CRS-%03d', CAST(split_part(o_orderpriority, '-', 1) AS INTEGER) - 1)"
STATUS = ("CASE o_orderstatus WHEN 'F' THEN 'Completed' WHEN 'O' THEN 'In Progress' "
          "ELSE 'Not Started' END")

GOLD = f"""
line_counts AS (
  SELECT l_orderkey, count(*) AS n_lines, count_if(l_linestatus = 'F') AS n_done,
         count_if(l_returnflag <> 'N') AS n_sub, count_if(l_returnflag = 'R') AS n_rev,
         sum(CAST(l_quantity AS DECIMAL(18,2))) AS qty, sum(CAST(l_discount AS DECIMAL(18,2))) AS disc
  FROM lineitem GROUP BY l_orderkey),
fact_lms AS (
  SELECT o_orderkey AS lms_row_id, o_custkey AS intern_id, {COURSE_ID} AS course_id,
         CAST(floor(o_totalprice / 5000.0) AS DOUBLE) AS progress,
         CAST(coalesce(n_done, 0) AS INTEGER) AS reviewed, CAST(coalesce(n_lines, 1) AS INTEGER) AS total_assg,
         CAST(coalesce(n_rev, 0) AS INTEGER) AS rev_submitted, CAST(coalesce(n_sub, 0) AS INTEGER) AS submitted,
         {STATUS} AS overall_status,
         coalesce(CAST(qty AS DOUBLE), 0.0::DOUBLE) AS kc_scored,
         coalesce(CAST(n_lines * 50 AS DOUBLE), 1.0) AS kc_total,
         coalesce(CAST(disc * 100 AS DOUBLE), 0.0) AS test_scored,
         coalesce(CAST(n_lines * 10 AS DOUBLE), 1.0) AS test_total
  FROM orders LEFT JOIN line_counts ON o_orderkey = l_orderkey),
fact_activity AS (
  SELECT user_id AS intern_id, CAST(ts AS DATE) AS date, event_type AS activity, value AS hours FROM events),
dim_intern AS (SELECT c_custkey AS intern_id, c_name AS intern_name FROM customer),
dim_course AS (SELECT DISTINCT {COURSE_ID} AS course_id, o_orderpriority AS course_name FROM orders),
intern_mentors AS (
  SELECT c_custkey AS intern_id, n_name || ', ' || r_name AS mentor_string
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
bridge AS (SELECT unnest(string_split(mentor_string, ', ')) AS mentor_name, intern_id FROM intern_mentors)
"""


def _bigint_counts(sql: str) -> str:
    """DuckDB's count_if returns HUGEINT; Spark's returns BIGINT."""
    out, i = [], 0
    while True:
        j = sql.find("count_if(", i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        depth, k = 0, j + len("count_if")
        while True:
            if sql[k] == "(":
                depth += 1
            elif sql[k] == ")":
                depth -= 1
                if depth == 0:
                    break
            k += 1
        out.append(sql[i:j] + "CAST(" + sql[j:k + 1] + " AS BIGINT)")
        i = k + 1


def with_gold(body: str, extra_ctes: str = "") -> str:
    ctes = GOLD.strip()
    if extra_ctes.strip():
        ctes += ",\n" + extra_ctes.strip()
    return _bigint_counts(f"WITH {ctes}\n{body.strip()}\n")


RISK_CTES = f"""
mx AS (SELECT max(date) AS max_date FROM fact_activity),
act AS (
  SELECT intern_id,
         coalesce({hsum("CASE WHEN date >= max_date - 14 THEN hours END")}, 0.0::DOUBLE) AS recent_hours,
         coalesce({hsum("CASE WHEN date >= max_date - 28 AND date < max_date - 14 THEN hours END")}, 0.0::DOUBLE) AS prev_hours,
         max(date) AS last_date, CAST(date_diff('day', max(date), any_value(max_date)) AS INTEGER) AS days_since,
         {hsum()} AS total_hours
  FROM fact_activity CROSS JOIN mx GROUP BY intern_id),
lms AS (
  SELECT intern_id, avg(progress) AS avg_progress_raw, sum(reviewed) AS sum_reviewed,
         sum(total_assg) AS sum_total_assg, count(*) AS n_courses
  FROM fact_lms GROUP BY intern_id),
risk_parts AS (
  SELECT l.intern_id, coalesce(d.intern_name, 'Unknown') AS intern_name,
         coalesce(avg_progress_raw, 0.0::DOUBLE) AS avg_p,
         greatest((50.0::DOUBLE - coalesce(avg_progress_raw, 0.0::DOUBLE)) / 50.0::DOUBLE, 0.0::DOUBLE) * 40 AS prog,
         CASE WHEN coalesce(prev_hours, 0) > 0
              THEN greatest(0.0::DOUBLE, -(coalesce(recent_hours, 0.0::DOUBLE) - prev_hours) / prev_hours) * 30
              WHEN coalesce(recent_hours, 0) > 0 THEN 15.0::DOUBLE ELSE 30.0::DOUBLE END AS effort,
         greatest(1.0::DOUBLE - sum_reviewed / greatest(sum_total_assg, 1), 0.0::DOUBLE) * 20 AS assg,
         CASE WHEN days_since IS NULL THEN 10.0::DOUBLE
              ELSE least(days_since * 1.5::DOUBLE, 10.0::DOUBLE) END AS recency,
         recent_hours, prev_hours, last_date, total_hours, sum_reviewed, sum_total_assg
  FROM lms l LEFT JOIN act a ON l.intern_id = a.intern_id
       LEFT JOIN dim_intern d ON l.intern_id = d.intern_id),
risk AS (
  SELECT intern_id, intern_name, {rhe("avg_p")} AS avg_progress, {rhe("prog")} AS prog_risk,
         {rhe("effort")} AS effort_risk, {rhe("assg")} AS assg_lag, {rhe("recency")} AS recency_risk,
         {rhe("prog + effort + assg + recency")} AS risk_score,
         CASE WHEN {rhe("prog + effort + assg + recency")} >= 50 THEN 'High'
              WHEN {rhe("prog + effort + assg + recency")} >= 25 THEN 'Medium' ELSE 'Low' END AS risk_level,
         recent_hours, prev_hours, last_date, total_hours, sum_reviewed, sum_total_assg
  FROM risk_parts)
"""

RISK_COLS = ("intern_id, intern_name, avg_progress, prog_risk, effort_risk, assg_lag, recency_risk, "
             "risk_score, risk_level")

SQL: dict[str, str] = {}

SQL["b04_dropout_risk"] = with_gold(f"SELECT {RISK_COLS} FROM risk", RISK_CTES)

# ---------------------------------------------------------------------------
# Shared fragments
# ---------------------------------------------------------------------------

def pct_sql(scored: str, total: str) -> str:
    return rhe(f"{scored} / (CASE WHEN {total} = 0 THEN 1 ELSE {total} END) * 100", 1)


def fmt0(x: str, suffix: str = "%%") -> str:
    return f"CASE WHEN ({x}) IS NOT NULL THEN printf('%.0f{suffix}', {rhe(x, 0)}) END"


def dash0(x: str) -> str:
    return f"CASE WHEN ({x}) IS NULL OR ({x}) <= 0 THEN '—' ELSE printf('%.0f%%', {rhe(x, 0)}) END"


SHORT = ("CASE course_name WHEN 'Basic Python Programming' THEN 'Python' WHEN 'Basic SQL' THEN 'SQL' "
         "WHEN 'Data Processing using NumPy & Pandas' THEN 'NumPy/Pandas' "
         "WHEN 'Data Processing using Pyspark' THEN 'PySpark' ELSE course_name END")

WEEKS = range(1, 54)

TH = f"th AS (SELECT intern_id, {hsum()} AS total_hours FROM fact_activity GROUP BY intern_id)"
DAILY = f"daily AS (SELECT intern_id, date, {hsum()} AS hours FROM fact_activity WHERE date IS NOT NULL GROUP BY intern_id, date)"
WK = "fa_wk AS (SELECT *, CAST(weekofyear(date) AS INTEGER) AS week FROM fact_activity WHERE date IS NOT NULL)"
SCORES = f"""lms_s AS (SELECT *, {pct_sql('kc_scored', 'kc_total')} AS kc_pct,
                  {pct_sql('test_scored', 'test_total')} AS test_pct FROM fact_lms)"""
QUANT = f"""qs AS (SELECT quantile_cont(total_hours, 0.5) AS median_hours,
                   quantile_cont(total_hours, 0.25) AS p25_hours FROM th)"""
ILMS = """ilms AS (
  SELECT intern_id, avg(progress) AS avg_progress, sum(reviewed) AS sum_reviewed,
         sum(total_assg) AS sum_total_assg, count(*) AS n_courses,
         count_if(overall_status = 'Completed') AS n_completed,
         count_if(overall_status IN ('Not started', 'Not Started')) AS n_not_started,
         coalesce(bool_and(coalesce(progress >= 70, false)), true) AS all_above_70
  FROM fact_lms GROUP BY intern_id)"""
A01 = "a01 AS (SELECT course_name, avg(progress) AS avg_progress FROM fact_lms JOIN dim_course USING (course_id) GROUP BY course_name)"
RANK = f"""rk AS (
  SELECT intern_id, total_hours, row_number() OVER (ORDER BY total_hours DESC, intern_id) AS rank,
         count(*) OVER () AS n_ranked FROM th)"""

# ---------------------------------------------------------------------------
# Activity
# ---------------------------------------------------------------------------
RANGE_FROM = "FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-08' AND DATE '2024-01-21')"


def in_range(sql: str) -> str:
    """A statement over the activity of the chosen dates only."""
    out = sql.replace("value AS hours FROM events)", "value AS hours " + RANGE_FROM)
    assert out != sql
    return out


SQL["f05_dropout_risk_range"] = in_range(SQL["b04_dropout_risk"])
SQL["f05_daily_hours_range"] = in_range(with_gold("SELECT intern_id, date, hours FROM daily", DAILY))
SQL["f05_weekly_hours_range"] = in_range(with_gold(f"SELECT intern_id, week, {hsum()} AS hours FROM fa_wk GROUP BY ALL", WK))
SQL["c10_range_summary"] = in_range(with_gold(f"""
SELECT intern_id, {hsum()} AS total_hours, count(DISTINCT date) AS logged_days, min(date) AS first_date, max(date) AS last_date,
       CAST(date_diff('day', min(date), max(date)) + 1 AS INTEGER) AS own_span_days, 14 AS range_days, {hsum()} / 14 AS hours_per_day
FROM fact_activity GROUP BY intern_id"""))
SQL["a07_weekly_hours_by_year"] = with_gold(f"""
SELECT intern_id, CAST(isoyear(date) AS INTEGER) AS iso_year, week, {hsum()} AS hours FROM fa_wk GROUP BY ALL""", WK)
SQL["a02_total_hours"] = with_gold("SELECT intern_id, total_hours FROM th", TH)
SQL["a03_daily_outliers"] = with_gold("SELECT intern_id, date, hours, hours > 12.0 AS is_outlier FROM daily", DAILY)
SQL["a04_daily_stats"] = with_gold(f"""
SELECT intern_id, count(*) AS logged_days, count_if(hours > 0) AS active_days,
       {hsum()} / count(*) AS mean_daily_hours, max(hours) AS max_daily_hours,
       first(date ORDER BY hours DESC, date) AS best_day
FROM daily GROUP BY intern_id""", DAILY)
SQL["a05_activity_share"] = with_gold(f"""
SELECT intern_id, activity, h AS hours, h / CAST(sum(CAST(h AS DECIMAL(38,2))) OVER (PARTITION BY intern_id) AS DOUBLE) AS share
FROM (SELECT intern_id, activity, {hsum()} AS h FROM fact_activity GROUP BY intern_id, activity)""")
SQL["a05_cohort_activity_share"] = with_gold(f"""
SELECT activity, h AS hours, h / CAST(sum(CAST(h AS DECIMAL(38,2))) OVER () AS DOUBLE) AS share
FROM (SELECT activity, {hsum()} AS h FROM fact_activity GROUP BY activity)""")
SQL["a06_date_activity_hours"] = with_gold(f"""
SELECT intern_id, date, activity, {hsum()} AS hours FROM fact_activity WHERE date IS NOT NULL GROUP BY ALL""")
SQL["a07_weekly_hours"] = with_gold(f"SELECT intern_id, week, {hsum()} AS hours FROM fa_wk GROUP BY ALL", WK)
SQL["a07_cohort_weekly_hours"] = with_gold(f"SELECT week, {hsum()} AS hours FROM fa_wk GROUP BY ALL", WK)
SQL["a19_cohort_activity_mean"] = with_gold(f"""
SELECT activity, {hsum()} / (SELECT count(DISTINCT intern_id) FROM fact_activity) AS cohort_avg_hours
FROM fact_activity GROUP BY activity""")
SQL["b05_weekly_trend"] = with_gold("SELECT intern_id, " + ", ".join(
    f"coalesce({hsum(f'CASE WHEN week = {w} THEN hours END')}, 0.0::DOUBLE) AS w{w}" for w in WEEKS)
    + " FROM fa_wk GROUP BY intern_id", WK)
SQL["b10_weekly_with_cohort"] = with_gold(f"""
SELECT p.intern_id, p.week, p.hours, c.cohort_hours, d.intern_name
FROM (SELECT intern_id, week, {hsum()} AS hours FROM fa_wk GROUP BY ALL) p
JOIN (SELECT week, {hsum()} AS cohort_hours FROM fa_wk GROUP BY ALL) c USING (week)
LEFT JOIN dim_intern d ON p.intern_id = d.intern_id""", WK)
SQL["b12_activity_by_mentor"] = with_gold(f"""
SELECT mentor_name, activity, hours,
       hours / CAST(sum(CAST(hours AS DECIMAL(38,7))) OVER (PARTITION BY mentor_name) AS DOUBLE) AS share
FROM (SELECT b.mentor_name, p.activity, {hsum('p.h')} AS hours
      FROM (SELECT intern_id, activity, {hsum()} AS h FROM fact_activity GROUP BY ALL) p
      JOIN bridge b USING (intern_id) GROUP BY ALL)""")
SQL["b15_cohort_weekly_band"] = with_gold(f"""
SELECT week, hours, m AS avg_hours, m * 0.9::DOUBLE AS band_low, m * 1.1::DOUBLE AS band_high
FROM wk CROSS JOIN (SELECT {hsum()} / count(*) AS m FROM wk)""",
    WK + f", wk AS (SELECT week, {hsum()} AS hours FROM fa_wk GROUP BY week)")
SQL["b27_top_activity_week"] = with_gold(f"""
SELECT intern_id, activity AS top_activity, {rhe('hours', 1)} AS top_hours FROM (
  SELECT intern_id, activity, hours,
         row_number() OVER (PARTITION BY intern_id ORDER BY hours DESC, activity) AS rn
  FROM (SELECT a.intern_id, a.activity, {hsum('a.hours')} AS hours
        FROM a JOIN (SELECT intern_id, max(date) AS last FROM a GROUP BY intern_id) l USING (intern_id)
        WHERE a.date >= l.last - 7 GROUP BY ALL))
WHERE rn = 1""", f"a AS (SELECT intern_id, date, activity, {hsum()} AS hours FROM fact_activity WHERE date IS NOT NULL GROUP BY ALL)")
SQL["b31_daily_activity_pivot"] = with_gold(f"""
SELECT intern_id, date, activity, hours, CAST(sum(CAST(hours AS DECIMAL(38,7))) OVER (PARTITION BY intern_id, date) AS DOUBLE) AS day_hours
FROM (SELECT intern_id, date, activity, {hsum()} AS hours FROM fact_activity WHERE date IS NOT NULL GROUP BY ALL)""")
SQL["w02_streak_stats"] = with_gold(f"""
SELECT s.intern_id, s.active_days, s.best_day_hours, s.daily_avg_hours, s.first_date, s.last_date,
       CAST(coalesce(l.longest_streak, 0) AS BIGINT) AS longest_streak
FROM (SELECT intern_id, count_if(hours > 0) AS active_days, max(hours) AS best_day_hours,
             {hsum()} / count(*) AS daily_avg_hours, min(date) AS first_date, max(date) AS last_date
      FROM daily GROUP BY intern_id) s
LEFT JOIN (SELECT intern_id, max(run) AS longest_streak FROM (
             SELECT intern_id, island, count(*) AS run FROM (
               SELECT intern_id, date - CAST(row_number() OVER (PARTITION BY intern_id ORDER BY date) AS INTEGER) AS island
               FROM daily WHERE hours > 0) GROUP BY ALL) GROUP BY intern_id) l
ON s.intern_id = l.intern_id""", DAILY)
SQL["r05_streak_calendar"] = with_gold("""
SELECT sp.intern_id, CAST(isoyear(sp.date) AS INTEGER) AS iso_year, CAST(weekofyear(sp.date) AS INTEGER) AS week,
       CAST(isodow(sp.date) - 1 AS INTEGER) AS dow, sp.date, coalesce(d.hours, 0.0::DOUBLE) AS hours
FROM (SELECT intern_id, CAST(unnest(generate_series(CAST(date_trunc('week', lo) AS TIMESTAMP),
                                                     CAST(date_trunc('week', hi) AS TIMESTAMP) + INTERVAL 6 DAY,
                                                     INTERVAL 1 DAY)) AS DATE) AS date
      FROM (SELECT intern_id, min(date) AS lo, max(date) AS hi FROM daily GROUP BY intern_id)) sp
LEFT JOIN daily d ON sp.intern_id = d.intern_id AND sp.date = d.date""", DAILY)

# ---------------------------------------------------------------------------
# LMS
# ---------------------------------------------------------------------------
SQL["a01_course_avg_progress"] = with_gold("SELECT course_name, avg_progress FROM a01", A01)
SQL["b06_pending_reviews"] = with_gold(f"""
SELECT lms_row_id, f.intern_id, intern_name, f.course_id, {SHORT} AS course_short, reviewed, total_assg,
       total_assg - reviewed AS pending
FROM fact_lms f JOIN dim_intern USING (intern_id) JOIN dim_course USING (course_id)
WHERE reviewed < total_assg""")
SQL["b07_score_summary"] = with_gold(f"""
SELECT lms_row_id, intern_id, course_name, kc_pct, test_pct, {dash0('kc_pct')} AS kc_display,
       {dash0('test_pct')} AS test_display
FROM lms_s JOIN dim_course USING (course_id)""", SCORES)
SQL["b08_progress_heatmap"] = with_gold(f"""
SELECT intern_id, {SHORT} AS course, progress FROM (
  SELECT intern_id, course_id, avg(progress) AS progress FROM fact_lms GROUP BY ALL) JOIN dim_course USING (course_id)""")
SQL["b11_score_distribution"] = with_gold(f"""
SELECT metric, count(*) AS n, {rhe('s1 / n', 6)} AS mean,
       {rhe('sqrt(greatest((s2 - s1 * s1 / n) / n, 0.0::DOUBLE))', 6)} AS sd, min(v) AS min,
       {rhe('quantile_cont(v, 0.25)', 6)} AS q1, {rhe('quantile_cont(v, 0.5)', 6)} AS median,
       {rhe('quantile_cont(v, 0.75)', 6)} AS q3, max(v) AS max
FROM (SELECT *, CAST(sum(CAST(v AS DECIMAL(38,1))) OVER (PARTITION BY metric) AS DOUBLE) AS s1,
             CAST(sum(CAST(v AS DECIMAL(38,1)) * CAST(v AS DECIMAL(38,1))) OVER (PARTITION BY metric) AS DOUBLE) AS s2,
             count(*) OVER (PARTITION BY metric) AS n
      FROM (SELECT 'kc_pct' AS metric, kc_pct AS v FROM lms_s UNION ALL
            SELECT 'test_pct' AS metric, test_pct AS v FROM lms_s) WHERE v > 0)
GROUP BY metric, s1, s2, n""", SCORES)
SQL["b13_progress_by_course"] = with_gold(f"""
SELECT lms_row_id, intern_id, intern_name, split_part(trim(intern_name), ' ', 1) AS first_name,
       array_to_string(list_transform(regexp_split_to_array(trim(intern_name), '\\s+')[1:2],
                                      lambda w: upper(left(w, 1))), '') AS initials,
       {SHORT} AS course_short, progress,
       CASE WHEN progress >= 70 THEN 'good' WHEN progress >= 40 THEN 'fair' ELSE 'low' END AS progress_band
FROM fact_lms JOIN dim_intern USING (intern_id) JOIN dim_course USING (course_id)""")
SQL["b16_course_detail"] = with_gold(f"""
SELECT lms_row_id, intern_name, course_name, reviewed, total_assg, total_assg - reviewed AS pending, overall_status,
       CAST({rhe('reviewed / (CASE WHEN total_assg = 0 THEN 1 ELSE total_assg END) * 100', 0)} AS INTEGER) AS completion_pct,
       {fmt0('progress')} AS progress_display, {dash0('kc_pct')} AS kc_display, {dash0('test_pct')} AS test_display
FROM lms_s JOIN dim_intern USING (intern_id) JOIN dim_course USING (course_id)""", SCORES)
SQL["b16_course_kpis"] = with_gold(f"""
SELECT mentor_name, course_id, course_name, n_rows, {rhe('sp / n_rows', 6)} AS avg_progress, completed, in_progress,
       not_started, total_reviewed, total_assg,
       CASE WHEN kcn > 0 THEN {rhe('kcs / kcn', 6)} ELSE 0.0::DOUBLE END AS avg_kc,
       CASE WHEN ten > 0 THEN {rhe('tes / ten', 6)} ELSE 0.0::DOUBLE END AS avg_test
FROM (SELECT b.mentor_name, p.course_id, CAST(sum(n) AS BIGINT) AS n_rows, sum(sp) AS sp,
             CAST(sum(c) AS BIGINT) AS completed, CAST(sum(ip) AS BIGINT) AS in_progress,
             CAST(sum(ns) AS BIGINT) AS not_started, CAST(sum(r) AS BIGINT) AS total_reviewed,
             CAST(sum(t) AS BIGINT) AS total_assg, CAST(sum(kcs) AS DOUBLE) AS kcs, CAST(sum(kcn) AS BIGINT) AS kcn,
             CAST(sum(tes) AS DOUBLE) AS tes, CAST(sum(ten) AS BIGINT) AS ten
      FROM (SELECT intern_id, course_id, count(*) AS n, sum(progress) AS sp,
                   count_if(overall_status = 'Completed') AS c,
                   count_if(overall_status IN ('In Progress', 'In progress')) AS ip,
                   count_if(overall_status IN ('Not started', 'Not Started')) AS ns,
                   sum(reviewed) AS r, sum(total_assg) AS t,
                   sum(CASE WHEN kc_pct > 0 THEN CAST(kc_pct AS DECIMAL(38,1)) END) AS kcs, count_if(kc_pct > 0) AS kcn,
                   sum(CASE WHEN test_pct > 0 THEN CAST(test_pct AS DECIMAL(38,1)) END) AS tes, count_if(test_pct > 0) AS ten
            FROM lms_s GROUP BY intern_id, course_id) p
      JOIN bridge b USING (intern_id) GROUP BY b.mentor_name, p.course_id) x
JOIN dim_course USING (course_id)""", SCORES)
SQL["b21_status_by_course"] = with_gold("""
SELECT course_name, overall_status, count(*) AS n FROM fact_lms JOIN dim_course USING (course_id) GROUP BY ALL""")
SQL["r04_status_pivot"] = with_gold("""
SELECT course_name, count_if(overall_status = 'Completed') AS completed, count_if(overall_status = 'In Progress') AS in_progress,
       count_if(overall_status = 'In progress') AS in_progress_2, count_if(overall_status = 'Not started') AS not_started_2,
       count_if(overall_status = 'Not Started') AS not_started,
       count_if(overall_status IS NULL OR overall_status NOT IN
                ('Completed', 'In Progress', 'In progress', 'Not started', 'Not Started')) AS other
FROM fact_lms JOIN dim_course USING (course_id) GROUP BY course_name""")
SQL["b34_course_scoreboard"] = with_gold("""
SELECT lms_row_id, intern_id, course_name,
       replace(replace(course_name, 'Data Processing using ', ''), ' & Pandas', '/Pandas') AS course_label,
       progress, overall_status,
       CASE WHEN overall_status = 'Completed' THEN 'done'
            WHEN overall_status IN ('In Progress', 'In progress') THEN 'active' ELSE 'waiting' END AS status_style,
       printf('%d/%d', reviewed, total_assg) AS assignments
FROM fact_lms JOIN dim_course USING (course_id)""")
SQL["b35_course_vs_cohort"] = with_gold(f"""
SELECT lms_row_id, intern_id, replace(course_name, 'Data Processing using ', '') AS course,
       {fmt0('progress')} AS my_progress, {fmt0('coalesce(a01.avg_progress, 0.0::DOUBLE)')} AS cohort_avg,
       (CASE WHEN progress - coalesce(a01.avg_progress, 0.0::DOUBLE) >= 0 THEN '🟢 +' ELSE '🔴 ' END)
         || printf('%.1f%%', {rhe('abs(progress - coalesce(a01.avg_progress, 0.0::DOUBLE))', 1)}) AS gap,
       overall_status
FROM fact_lms JOIN dim_course USING (course_id) LEFT JOIN a01 USING (course_name)""", A01)

# ---------------------------------------------------------------------------
# Intern
# ---------------------------------------------------------------------------
SQL["a16_cohort_hour_quantiles"] = with_gold("SELECT median_hours, p25_hours FROM qs", TH + ",\n" + QUANT)
SQL["w01_hours_rank"] = with_gold("""
SELECT intern_id, total_hours, rank, n_ranked, printf('#%d of %d', rank, n_ranked) AS rank_label FROM rk""",
    TH + ",\n" + RANK)
SQL["w01_mentor_hours_rank"] = with_gold("""
SELECT intern_id, total_hours, mentor_name,
       row_number() OVER (PARTITION BY mentor_name ORDER BY total_hours DESC, intern_id) AS rank
FROM th JOIN bridge USING (intern_id)""", TH)
SQL["w07_masked_leaderboard"] = with_gold(f"""
SELECT printf('#%d', rank) AS rank_label,
       CASE WHEN rk.intern_id = (SELECT min(intern_id) FROM fact_activity) THEN '⭐ ' || intern_name || ' (You)'
            ELSE printf('Intern #%d', rank) END AS name,
       printf('%.0f hrs', {rhe('total_hours', 0)}) AS hours_label, total_hours AS bar,
       rk.intern_id = (SELECT min(intern_id) FROM fact_activity) AS is_viewer
FROM rk LEFT JOIN dim_intern d ON rk.intern_id = d.intern_id""", TH + ",\n" + RANK)
SQL["b14_effort_vs_progress"] = with_gold("""
SELECT th.intern_id, total_hours AS hours, progress, intern_name
FROM th JOIN (SELECT intern_id, avg(progress) AS progress FROM fact_lms GROUP BY intern_id) p USING (intern_id)
LEFT JOIN dim_intern d ON th.intern_id = d.intern_id""", TH)
SQL["b14_trend_line"] = with_gold(f"""
SELECT i, {rhe('lo + i * (hi - lo) / 49', 6)} AS hours, {rhe('slope * (lo + i * (hi - lo) / 49) + intercept', 6)} AS progress
FROM (SELECT regr_slope(progress, total_hours) AS slope, regr_intercept(progress, total_hours) AS intercept,
             count(*) AS n, min(total_hours) AS lo, max(total_hours) AS hi
      FROM th JOIN (SELECT intern_id, avg(progress) AS progress FROM fact_lms GROUP BY intern_id) p USING (intern_id))
CROSS JOIN (SELECT CAST(unnest(range(0, 50)) AS INTEGER) AS i)
WHERE n > 2""", TH)
SQL["b17_intern_range_panel"] = with_gold(f"""
SELECT l.intern_id, coalesce(a.total_hours, 0.0::DOUBLE) AS total_hours, coalesce(a.active_days, 0) AS active_days,
       printf('%.0f hrs', {rhe('coalesce(a.total_hours, 0.0::DOUBLE)', 0)}) AS hours_label,
       {fmt0('avg_progress')} AS progress_label, printf('%d/%d courses', c, n) AS completed_label,
       printf('%d/%d', r, t) AS assignments_label,
       CASE WHEN kc IS NULL THEN 'N/A' ELSE {fmt0('kc')} END AS kc_label,
       CASE WHEN te IS NULL THEN 'N/A' ELSE {fmt0('te')} END AS test_label
FROM (SELECT intern_id, avg(progress) AS avg_progress, sum(reviewed) AS r, sum(total_assg) AS t,
             count_if(overall_status = 'Completed') AS c, count(*) AS n,
             CAST(sum(CASE WHEN kc_pct > 0 THEN CAST(kc_pct AS DECIMAL(38,1)) END) AS DOUBLE) / count_if(kc_pct > 0) AS kc,
             CAST(sum(CASE WHEN test_pct > 0 THEN CAST(test_pct AS DECIMAL(38,1)) END) AS DOUBLE) / count_if(test_pct > 0) AS te
      FROM lms_s GROUP BY intern_id) l
LEFT JOIN (SELECT intern_id, {hsum()} AS total_hours, count(DISTINCT date) AS active_days
           FROM fact_activity GROUP BY intern_id) a ON l.intern_id = a.intern_id""", SCORES)
SQL["b17_intern_range_panel_range"] = in_range(SQL["b17_intern_range_panel"])
SQL["b18_deep_dive"] = with_gold(f"""
SELECT ilms.intern_id, {fmt0('avg_progress')} AS progress_label,
       CASE WHEN total_hours IS NULL THEN 'N/A' ELSE printf('%.0f hrs', {rhe('total_hours', 0)}) END AS hours_label,
       printf('%d/%d', sum_reviewed, sum_total_assg) AS assignments_label,
       printf('%d/%d courses', n_completed, n_courses) AS completed_label,
       CASE WHEN avg_progress < 40 THEN 'High' WHEN avg_progress > 70 THEN 'Low' ELSE 'Medium' END AS risk_tier
FROM ilms LEFT JOIN th ON ilms.intern_id = th.intern_id""", ILMS + ",\n" + TH)
SKILL = f"""
  (avg_progress / 100 * 0.5::DOUBLE)
  + (least(hours / (CASE WHEN median_hours IS NULL OR median_hours = 0 THEN 1.0::DOUBLE ELSE median_hours END), 1.5::DOUBLE) / 1.5::DOUBLE * 0.3::DOUBLE)
  + (sum_reviewed / greatest(sum_total_assg, 1) * 0.2::DOUBLE)"""
SQL["b25_skill_intensity"] = with_gold(f"""
SELECT intern_id, hours AS total_hours, {rhe('(' + SKILL + ') * 100', 1)} AS skill_score
FROM (SELECT ilms.*, coalesce(th.total_hours, 0.0::DOUBLE) AS hours FROM ilms LEFT JOIN th USING (intern_id)) CROSS JOIN qs""",
    ILMS + ",\n" + TH + ",\n" + QUANT)
SQL["b26_cohort_skill_intensity"] = with_gold(f"""
SELECT coalesce({rhe('CAST(sum(CAST((' + SKILL + ') AS DECIMAL(38,9))) AS DOUBLE) / count(*) * 100', 1)}, 50.0::DOUBLE)
       AS cohort_skill_score
FROM (SELECT ilms.*, th.total_hours AS hours FROM ilms JOIN th USING (intern_id)) CROSS JOIN qs""",
    ILMS + ",\n" + TH + ",\n" + QUANT)
SQL["b28_outlook_badge"] = with_gold("""
SELECT intern_id,
  CASE WHEN all_above_70 AND h >= median_hours THEN '🎯 On track to complete all courses!'
       WHEN n_completed = n_courses THEN '🏆 All courses completed! Star intern!'
       WHEN h < p25_hours THEN '⚠️ Low effort detected — time to push harder!'
       ELSE '📈 Progressing steadily. Keep the momentum!' END AS badge_text,
  CASE WHEN all_above_70 AND h >= median_hours THEN 'success' WHEN n_completed = n_courses THEN 'success'
       WHEN h < p25_hours THEN 'error' ELSE 'info' END AS badge_type
FROM (SELECT ilms.*, coalesce(th.total_hours, 0.0::DOUBLE) AS h FROM ilms LEFT JOIN th USING (intern_id)) CROSS JOIN qs""",
    ILMS + ",\n" + TH + ",\n" + QUANT)
SQL["b29_banner"] = with_gold(f"""
SELECT intern_id,
  CASE WHEN avg_progress >= 80 THEN 'success' WHEN n_not_started > 0 THEN 'warning'
       WHEN h < median_hours THEN 'warning' ELSE 'info' END AS banner_type,
  CASE WHEN avg_progress >= 80 THEN printf({lit(BANNER_TOP)}, {rhe('avg_progress', 0)})
       WHEN n_not_started > 0 THEN printf({lit(BANNER_NOT_STARTED)}, n_not_started)
       WHEN h < median_hours THEN printf({lit(BANNER_BELOW_MEDIAN)}, {rhe('median_hours - h', 1)})
       ELSE printf({lit(BANNER_ON_TRACK)}, {rhe('h', 0)}) END AS banner_text
FROM (SELECT ilms.*, coalesce(th.total_hours, 0.0::DOUBLE) AS h FROM ilms LEFT JOIN th USING (intern_id)) CROSS JOIN qs""",
    ILMS + ",\n" + TH + ",\n" + QUANT)
SQL["b30_radar_profile"] = with_gold("""
SELECT intern_id, course_name, arg_min(progress, lms_row_id) AS own_progress, any_value(avg_progress) AS cohort_progress
FROM fact_lms JOIN dim_course USING (course_id) JOIN a01 USING (course_name) GROUP BY intern_id, course_name""", A01)
SQL["b33_activity_benchmark"] = with_gold(f"""
SELECT m.activity, m.intern_id, m.my_hours, c.cohort_avg_hours,
       CAST(row_number() OVER (PARTITION BY m.intern_id ORDER BY m.my_hours DESC, m.activity) AS INTEGER) AS own_rank
FROM (SELECT intern_id, activity, {hsum()} AS my_hours FROM fact_activity GROUP BY ALL) m
LEFT JOIN (SELECT activity, {hsum()} / (SELECT count(DISTINCT intern_id) FROM fact_activity) AS cohort_avg_hours
           FROM fact_activity GROUP BY activity) c ON m.activity = c.activity""")
SQL["b36_kpi_strip"] = with_gold(f"""
SELECT ilms.intern_id, printf('%.0f hrs', {rhe('coalesce(rk.total_hours, 0.0::DOUBLE)', 0)}) AS hours_label,
       printf('%d/%d', n_completed, n_courses) AS completed_label,
       printf('%d/%d', sum_reviewed, sum_total_assg) AS assignments_label,
       coalesce(printf('#%d of %d', rank, n_ranked), 'N/A') AS rank_label,
       {fmt0('avg_progress')} AS progress_label,
       printf('%+.1f', {rhe('avg_progress - (SELECT avg(avg_progress) FROM a01)', 1)}) || '% vs cohort' AS delta_label
FROM ilms LEFT JOIN rk ON ilms.intern_id = rk.intern_id""", ILMS + ",\n" + TH + ",\n" + RANK + ",\n" + A01)

# ---------------------------------------------------------------------------
# Mentor
# ---------------------------------------------------------------------------
SQL["f04_regex_cohort"] = with_gold("""
SELECT DISTINCT f.intern_id FROM fact_lms f JOIN intern_mentors m ON f.intern_id = m.intern_id
WHERE regexp_matches(m.mentor_string, 'NATION_1')""")
SQL["a15_mentor_courses"] = with_gold("""
SELECT mentor_name, course_name FROM (
  SELECT DISTINCT b.mentor_name, p.course_id FROM (SELECT DISTINCT intern_id, course_id FROM fact_lms) p
  JOIN bridge b USING (intern_id)) JOIN dim_course USING (course_id)""")
SQL["b09_risk_register"] = with_gold(f"""
SELECT b.mentor_name, r.intern_id, intern_name, risk_score, risk_level,
       (CASE risk_level WHEN 'High' THEN '🔴' WHEN 'Medium' THEN '🟡' WHEN 'Low' THEN '🟢' END) || ' ' || risk_level AS risk_label,
       printf('%.1f/100', {rhe('risk_score', 1)}) AS score_label, {fmt0('avg_progress')} AS progress_label
FROM risk r JOIN bridge b ON r.intern_id = b.intern_id""", RISK_CTES)
SQL["t02_top_risk"] = with_gold("""
SELECT intern_id, intern_name, risk_score, prog_risk, effort_risk, assg_lag, recency_risk
FROM risk ORDER BY risk_score DESC, intern_id LIMIT 12""", RISK_CTES)
SQL["b19_action_items"] = with_gold(f"""
SELECT mentor_name, ord, card, title, text FROM (
  SELECT mentor_name, 1 AS ord, 'urgent' AS card, {lit(CARD_URGENT[0])} AS title, printf({lit(CARD_URGENT[1])}, n_high) AS text
  FROM m WHERE n_high > 0
  UNION ALL
  SELECT mentor_name, 2, 'backlog', {lit(CARD_BACKLOG[0])}, printf({lit(CARD_BACKLOG[1])},
         coalesce(total_pending, 0), coalesce(pairs, 0)) FROM m WHERE coalesce(total_pending, 0) > 5
  UNION ALL
  SELECT mentor_name, 3, 'medium_watch', {lit(CARD_MEDIUM[0])}, printf({lit(CARD_MEDIUM[1])}, n_medium)
  FROM m WHERE n_medium > 2
  UNION ALL
  SELECT mentor_name, 4, 'all_clear', {lit(CARD_CLEAR[0])}, {lit(CARD_CLEAR[1])} FROM m
  WHERE NOT (n_high > 0 OR coalesce(total_pending, 0) > 5 OR n_medium > 2))""", RISK_CTES + """,
m AS (
  SELECT r.mentor_name, n_high, n_medium, total_pending, pairs FROM (
    SELECT b.mentor_name, count_if(risk_level = 'High') AS n_high, count_if(risk_level = 'Medium') AS n_medium
    FROM risk JOIN bridge b USING (intern_id) GROUP BY b.mentor_name) r
  LEFT JOIN (
    SELECT b.mentor_name, sum(pending) AS total_pending, sum(pairs) AS pairs
    FROM (SELECT intern_id, sum(total_assg - reviewed) AS pending, count(*) AS pairs
          FROM fact_lms WHERE reviewed < total_assg GROUP BY intern_id) p
    JOIN bridge b USING (intern_id) GROUP BY b.mentor_name) q ON r.mentor_name = q.mentor_name)""")
SQL["b19_urgent_names"] = with_gold("""
SELECT b.mentor_name, r.intern_id, split_part(trim(intern_name), ' ', 1) AS first_name, risk_score
FROM risk r JOIN bridge b ON r.intern_id = b.intern_id WHERE risk_level = 'High'""", RISK_CTES)
SQL["b20_mentor_kpis"] = with_gold(f"""
SELECT b.mentor_name, count(*) AS n_interns, CAST(sum(c) AS BIGINT) AS completed, CAST(sum(ip) AS BIGINT) AS in_progress,
       CAST(sum(ns) AS BIGINT) AS not_started, {rhe('sum(sp) / sum(n)', 6)} AS avg_progress,
       coalesce({hsum('th.total_hours')}, 0.0::DOUBLE) AS total_hours, CAST(sum(hi) AS BIGINT) AS high_risk,
       CAST(sum(pending) AS BIGINT) AS total_pending
FROM (SELECT intern_id, count_if(overall_status = 'Completed') AS c, count_if(overall_status = 'In Progress') AS ip,
             count_if(overall_status IN ('Not started', 'Not Started')) AS ns, sum(progress) AS sp, count(*) AS n,
             sum(greatest(total_assg - reviewed, 0)) AS pending
      FROM fact_lms GROUP BY intern_id) l
LEFT JOIN th ON l.intern_id = th.intern_id
LEFT JOIN (SELECT intern_id, CAST(risk_level = 'High' AS INTEGER) AS hi FROM risk) r ON l.intern_id = r.intern_id
JOIN bridge b ON l.intern_id = b.intern_id
GROUP BY b.mentor_name""", RISK_CTES + ",\n" + TH)
SQL["b23_mentor_calendar"] = with_gold(f"""
SELECT b.mentor_name, w.intern_id, week, hours
FROM (SELECT intern_id, week, {hsum()} AS hours FROM fa_wk GROUP BY ALL) w JOIN bridge b USING (intern_id)""", WK)
SQL["b24_profile_list"] = with_gold(f"""
SELECT b.mentor_name, b.intern_id, intern_name, coalesce(risk_level, 'Low') AS risk_level, coalesce(risk_score, 0.0::DOUBLE) AS risk_score,
       coalesce({fmt0('avg_progress')}, '—') AS progress_label,
       printf('%.0f hrs', {rhe('coalesce(th.total_hours, 0.0::DOUBLE)', 0)}) AS hours_label
FROM bridge b LEFT JOIN risk r ON b.intern_id = r.intern_id LEFT JOIN th ON b.intern_id = th.intern_id""",
    RISK_CTES + ",\n" + TH)
SQL["b38_intervention_plan"] = with_gold(f"""
SELECT intern_id, tier AS risk_level,
  CASE tier WHEN 'High' THEN printf({lit(PLAN_HIGH)}, nm, prog, hrs)
            WHEN 'Medium' THEN printf({lit(PLAN_MEDIUM)}, nm, prog, hrs)
            ELSE printf({lit(PLAN_LOW)}, nm, prog, hrs) END AS plan_text
FROM (SELECT l.intern_id, coalesce(d.intern_name, 'Unknown') AS nm,
             CASE WHEN avg_progress < 40 THEN 'High' WHEN avg_progress > 70 THEN 'Low' ELSE 'Medium' END AS tier,
             coalesce({fmt0('avg_progress')}, 'nan%') AS prog,
             printf('%.0f hrs', {rhe('coalesce(th.total_hours, 0.0::DOUBLE)', 0)}) AS hrs
      FROM (SELECT intern_id, avg(progress) AS avg_progress FROM fact_lms GROUP BY intern_id) l
      LEFT JOIN th ON l.intern_id = th.intern_id LEFT JOIN dim_intern d ON l.intern_id = d.intern_id)""", TH)

# ---------------------------------------------------------------------------
# Bronze -> silver -> gold
# ---------------------------------------------------------------------------

def title_sql(x: str) -> str:
    return (f"array_to_string(list_transform(regexp_extract_all(lower({x}), '(\\p{{L}}+|[^\\p{{L}}]+)'), "
            f"lambda t: upper(t[1]) || lower(t[2:])), '')")


def clean_name_sql(x: str) -> str:
    return f"CASE WHEN trim({x}) = '' THEN NULL ELSE {title_sql(f'trim({x})')} END"


def to_double_sql(x: str) -> str:
    v = f"TRY_CAST(trim({x}) AS DOUBLE)"
    return f"(CASE WHEN isnan({v}) THEN NULL ELSE {v} END)"


def frac_sql(x: str, idx: int, default: str, as_int: bool = False) -> str:
    v = f"coalesce({to_double_sql(f'string_split({x}, {chr(39)}/{chr(39)})[{idx + 1}]')}, {default})"
    return f"CAST(trunc({v}) AS INTEGER)" if as_int else v


def date_sql(x: str) -> str:
    s = f"trim({x})"
    return (f"CASE WHEN regexp_matches({s}, '^\\d{{1,2}}/\\d{{1,2}}/\\d{{4}}$') THEN CAST(try_strptime({s}, '%d/%m/%Y') AS DATE) "
            f"WHEN regexp_matches({s}, '^\\d{{4}}-\\d{{1,2}}-\\d{{1,2}}') THEN CAST(try_strptime(substr({s}, 1, 10), '%Y-%m-%d') AS DATE) "
            f"WHEN regexp_matches({s}, '^\\d{{1,2}} [A-Za-z]{{3}} \\d{{4}}$') THEN CAST(try_strptime({s}, '%d %b %Y') AS DATE) END")


def nz_sql(x: str) -> str:
    return f"(CASE WHEN {x} = 0 THEN 1 ELSE {x} END)"


STATUS_RAW = "CASE o_orderstatus WHEN 'F' THEN 'Completed' WHEN 'O' THEN 'In Progress' ELSE '-' END"
STAT = "coalesce(\"Overall Status\", 'Not Started')"

BRONZE = f"""
bronze_lms AS (
  SELECT o_orderkey AS row_id, CAST(o_orderdate AS DATE) AS ingest_date,
    '  ' || lower(replace(c_name, '#', ' ')) || ' ' AS "User Name",
    o_orderpriority AS "Course Name",
    CASE WHEN k < 5 THEN strftime(DATE '2024-01-01' + (k - 1) * 7, '%d %b %Y') END AS "Start Date",
    CASE WHEN k < 5 THEN strftime(DATE '2024-01-01' + (k - 1) * 7 + 55, '%d %b %Y') END AS "End Date",
    im.mentor_string AS "Mentor Name",
    CASE WHEN o_totalprice >= 5000 THEN printf('%d%%', CAST(floor(o_totalprice / 5000.0) AS BIGINT)) END AS "Progress (%)",
    CASE WHEN n_lines IS NOT NULL THEN printf('%d/%d', n_done, n_lines) END AS "Completed Assignment",
    CASE WHEN n_lines IS NOT NULL THEN printf('%d/%d', n_rev, n_sub) END AS "Reviewed / Submitted",
    CASE WHEN n_lines IS NULL THEN '0 / 0'
         ELSE printf('%.1f / %.1f', CAST(qty AS DOUBLE), CAST(n_lines * 50 AS DOUBLE)) END AS "Overall Knowledge Check",
    CASE WHEN n_lines IS NULL THEN '0 / 0'
         ELSE printf('%.2f / %.1f', CAST(disc * 100 AS DOUBLE), CAST(n_lines * 10 AS DOUBLE)) END AS "Overall Test",
    CASE WHEN n_lines IS NULL THEN '-' ELSE printf('%d/%d', n_done, n_lines) END AS "Reviewed / Total Assignments",
    {STATUS_RAW} AS "Overall Status"
  FROM (SELECT *, CAST(split_part(o_orderpriority, '-', 1) AS INTEGER) AS k FROM orders) o
  LEFT JOIN line_counts ON o_orderkey = l_orderkey
  LEFT JOIN customer ON o_custkey = c_custkey
  LEFT JOIN intern_mentors im ON o_custkey = im.intern_id),
bronze_eod AS (
  SELECT event_id AS row_id, strftime(CAST(ts AS DATE), '%d/%m/%Y') AS "Date",
         split_part(c_name, '#', 1) AS "First Name", split_part(c_name, '#', 2) || ' ' AS "Last Name",
         event_type AS "Activity", value AS "Hours"
  FROM events LEFT JOIN customer ON user_id = c_custkey),
silver_lms AS (
  SELECT row_id, ingest_date, {clean_name_sql('"User Name"')} AS intern_name, "Course Name" AS course_name,
    {date_sql('"Start Date"')} AS start_date, {date_sql('"End Date"')} AS end_date,
    "Mentor Name" AS mentor_name,
    {to_double_sql("regexp_replace(trim(coalesce(" + '"Progress (%)"' + ", '0%')), '%+$', '')")} AS progress,
    {frac_sql('"Reviewed / Total Assignments"', 0, '0.0', True)} AS reviewed,
    {frac_sql('"Reviewed / Total Assignments"', 1, '1.0', True)} AS total_assg,
    {frac_sql('"Reviewed / Submitted"', 0, '0.0', True)} AS rev_submitted,
    {frac_sql('"Reviewed / Submitted"', 1, '0.0', True)} AS submitted,
    CASE WHEN {STAT} = '-' THEN 'Not Started' ELSE {STAT} END AS overall_status,
    {frac_sql('"Overall Knowledge Check"', 0, '0.0')} AS kc_scored,
    {nz_sql(frac_sql('"Overall Knowledge Check"', 1, '1.0'))} AS kc_total,
    {frac_sql('"Overall Test"', 0, '0.0')} AS test_scored,
    {nz_sql(frac_sql('"Overall Test"', 1, '1.0'))} AS test_total
  FROM bronze_lms),
silver_eod AS (
  SELECT row_id, {date_sql('"Date"')} AS date,
         CASE WHEN "First Name" IS NULL AND "Last Name" IS NULL THEN NULL
              ELSE {title_sql("concat_ws(' ', trim(" + '"First Name"' + "), trim(" + '"Last Name"' + "))")} END AS full_name,
         "Activity" AS activity, CAST("Hours" AS DOUBLE) AS hours
  FROM bronze_eod),
g_dim_intern AS (
  SELECT DISTINCT intern_name, md5(intern_name) AS intern_id, left(md5(intern_name), 8) AS intern_code FROM silver_lms WHERE intern_name IS NOT NULL),
g_dim_course AS (
  SELECT course_name, start_date, end_date,
         printf('CRS-%03d', row_number() OVER (ORDER BY course_name NULLS FIRST, start_date NULLS FIRST,
                                                      end_date NULLS FIRST) - 1) AS course_id
  FROM (SELECT DISTINCT course_name, start_date, end_date FROM silver_lms)),
g_fact_lms AS (
  SELECT row_id, md5(s.intern_name) AS intern_id, d.course_id, progress, reviewed, total_assg,
         rev_submitted, submitted, overall_status, mentor_name, kc_scored, kc_total, test_scored, test_total
  FROM silver_lms s JOIN g_dim_course d
    ON s.course_name IS NOT DISTINCT FROM d.course_name AND s.start_date IS NOT DISTINCT FROM d.start_date
   AND s.end_date IS NOT DISTINCT FROM d.end_date
  WHERE s.intern_name IS NOT NULL),
g_fact_activity AS (
  SELECT row_id, date, md5(full_name) AS intern_id, activity, hours
  FROM silver_eod WHERE full_name IN (SELECT intern_name FROM g_dim_intern))
"""

SQL["b01_dim_intern"] = with_gold("SELECT intern_name, intern_id, intern_code FROM g_dim_intern", BRONZE)
SQL["b01_dim_course"] = with_gold("SELECT course_name, start_date, end_date, course_id FROM g_dim_course", BRONZE)
SQL["b01_dim_mentor"] = with_gold("""
SELECT DISTINCT unnest(list_distinct(list_filter(list_transform(string_split(mentor_name, ', '), lambda x: trim(x)),
                                                 lambda x: x <> ''))) AS mentor_name FROM silver_lms""", BRONZE)
SQL["b01_fact_lms"] = with_gold("SELECT * FROM g_fact_lms", BRONZE)
SQL["b01_fact_activity"] = with_gold("SELECT * FROM g_fact_activity", BRONZE)
SQL["b01_key_collisions"] = with_gold("""
SELECT intern_code, count(*) AS n_names FROM g_dim_intern GROUP BY intern_code HAVING count(*) > 1""", BRONZE)
SEQ = """
seq_intern AS (SELECT intern_name, row_number() OVER (ORDER BY intern_name) + 1000 AS intern_id
               FROM (SELECT DISTINCT intern_name FROM silver_lms WHERE intern_name IS NOT NULL)),
seq_course AS (
  SELECT course_name, start_date, end_date,
         row_number() OVER (ORDER BY course_name NULLS FIRST, start_date NULLS FIRST, end_date NULLS FIRST) - 1 + 501 AS course_id
  FROM (SELECT DISTINCT course_name, start_date, end_date FROM silver_lms))"""
SQL["b02_dim_intern_seq"] = with_gold("SELECT intern_name, intern_id FROM seq_intern", BRONZE + "," + SEQ)
SQL["b02_fact_progress"] = with_gold("""
SELECT row_id, i.intern_id, d.course_id, progress, reviewed, total_assg, overall_status
FROM silver_lms s JOIN seq_intern i ON s.intern_name = i.intern_name
JOIN seq_course d ON s.course_name IS NOT DISTINCT FROM d.course_name AND s.start_date IS NOT DISTINCT FROM d.start_date
 AND s.end_date IS NOT DISTINCT FROM d.end_date""", BRONZE + "," + SEQ)
SQL["b02_dim_course_seq"] = with_gold("SELECT course_name, start_date, end_date, course_id FROM seq_course", BRONZE + "," + SEQ)
SQL["b02_fact_effort"] = with_gold("""
SELECT row_id, date, i.intern_id, activity, hours FROM silver_eod e JOIN seq_intern i ON e.full_name = i.intern_name""", BRONZE + "," + SEQ)
SQL["b03_quality_report"] = with_gold("""
SELECT (SELECT count(*) FROM g_dim_intern) AS unique_interns,
       (SELECT count(*) FROM g_dim_course) AS courses,
       (SELECT count(*) FROM (SELECT DISTINCT unnest(list_distinct(list_filter(list_transform(
            string_split(mentor_name, ', '), lambda x: trim(x)), lambda x: x <> ''))) FROM silver_lms)) AS mentors,
       (SELECT count(*) FROM g_fact_lms) AS fact_lms_rows,
       (SELECT count(*) FROM g_fact_activity) AS fact_activity_rows,
       (SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) FROM (SELECT count(*) AS n FROM silver_lms GROUP BY intern_name, course_name)) AS duplicates,
       (SELECT count_if(hours < 0) FROM g_fact_activity) AS invalid_hours,
       (SELECT count_if(progress > 100) FROM g_fact_lms) AS invalid_progress,
       (SELECT count(*) FROM silver_eod e WHERE NOT EXISTS (
           SELECT 1 FROM silver_lms s WHERE s.intern_name IS NOT NULL AND s.intern_name = e.full_name)) AS orphan_records,
       (SELECT count_if(h > 12.0) FROM (SELECT sum(CAST(hours AS DECIMAL(38,7))) AS h FROM g_fact_activity
                                    WHERE date IS NOT NULL GROUP BY intern_id, date)) AS outlier_days,
       (SELECT count_if("Progress (%)" IS NOT NULL AND """ + to_double_sql("regexp_replace(trim(" + '"Progress (%)"' + "), '%+$', '')")
    + """ IS NULL) FROM bronze_lms) AS unparsed_progress,
       (SELECT count_if(hours IS NOT NULL AND NOT abs(hours) <= 9e15) FROM g_fact_activity) AS unsummable_hours""", BRONZE)
SQL["u02_merge_new"] = with_gold(f"""
SELECT * FROM b WHERE ingest_date < DATE '1998-01-01'
UNION ALL
SELECT * FROM b n WHERE ingest_date >= DATE '1998-01-01' AND NOT EXISTS (
  SELECT 1 FROM b o WHERE o.ingest_date < DATE '1998-01-01'
    AND o."Course Name" IS NOT DISTINCT FROM n."Course Name" AND o.name_norm IS NOT DISTINCT FROM n.name_norm)""",
    BRONZE + f", b AS (SELECT *, {clean_name_sql(chr(34) + 'User Name' + chr(34))} AS name_norm FROM bronze_lms)")
SQL["b40_validate_output"] = with_gold(f"""
SELECT "check", scope, passed, detail FROM (
  SELECT 'lms_schema' AS "check", scope, true AS passed, '12 columns in order' AS detail FROM pc
  UNION ALL SELECT 'row_count', scope, rows = (SELECT n FROM want), printf('%d rows', rows) FROM pc
  UNION ALL SELECT 'progress_range', scope, bad_progress = 0, '0..100' FROM pc
  UNION ALL SELECT 'status_values', scope, bad_status = 0, 'known spellings' FROM pc
  UNION ALL SELECT 'completed_progress', scope, early_done = 0, 'completed => progress >= 30' FROM pc
  UNION ALL SELECT 'eod_schema', 'eod', true, '5 columns in order'
  UNION ALL SELECT 'unique_names', 'lms', (SELECT n FROM lms_names) = (SELECT n FROM want), printf('%d names', (SELECT n FROM lms_names))
  UNION ALL SELECT 'hours_range', 'eod', (SELECT count(*) FROM bronze_eod
                                          WHERE "Hours" IS NULL OR "Hours" < 0 OR "Hours" > 10) = 0, '0..10'
  UNION ALL SELECT 'eod_coverage', 'eod', (SELECT n FROM eod_names) = (SELECT n FROM want), printf('%d names', (SELECT n FROM eod_names)))""",
    BRONZE + f""",
want AS (SELECT count(DISTINCT intern_id) AS n FROM dim_intern),
lms_names AS (SELECT count(*) AS n FROM (SELECT DISTINCT "User Name" FROM bronze_lms)),
eod_names AS (SELECT count(*) AS n FROM (SELECT DISTINCT "First Name" || ' ' || "Last Name" FROM bronze_eod)),
pc AS (SELECT "Course Name" AS scope, count(*) AS rows,
              count(*) FILTER (WHERE p IS NULL OR p < 0 OR p > 100) AS bad_progress,
              count(*) FILTER (WHERE "Overall Status" IS NULL OR "Overall Status" NOT IN
                               ('Completed', 'In Progress', 'In progress', 'Not started', 'Not Started')) AS bad_status,
              count(*) FILTER (WHERE "Overall Status" = 'Completed' AND p < 30) AS early_done
       FROM (SELECT *, {to_double_sql("regexp_replace(trim(" + '"Progress (%)"' + "), '%+$', '')")} AS p FROM bronze_lms)
       GROUP BY "Course Name")""")

# ---------------------------------------------------------------------------
# Profiles
# ---------------------------------------------------------------------------

def moments_sql(v: str, which=("n", "mean", "std_pop", "std_samp")) -> str:
    parts = {
        "n": f"count({v}) AS n",
        "mean": f"{rhe(f'avg({v})', 6)} AS mean",
        "std_pop": f"{rhe(f'stddev_pop({v})', 6)} AS std_pop",
        "std_samp": f"{rhe(f'stddev_samp({v})', 6)} AS std_samp",
    }
    return ", ".join(parts[w] for w in which)


LMS_VIEW = ("lv AS (SELECT lms_row_id, intern_id, course_id, progress, overall_status, intern_name, course_name "
            "FROM fact_lms LEFT JOIN dim_intern USING (intern_id) LEFT JOIN dim_course USING (course_id))")
PCT_P = "regexp_replace(trim(\"Progress (%)\"), '%+$', '')"

SQL["b37_cohort_summary"] = with_gold("""
SELECT 7 AS n_columns, 'course_id, intern_id, lms_row_id, progress, overall_status, intern_name, course_name' AS columns, count(*) AS total_rows, count(DISTINCT course_name) AS unique_courses,
       count(DISTINCT intern_name) AS unique_interns, avg(progress) AS avg_progress FROM lv""", LMS_VIEW)
SQL["b37_course_list"] = with_gold("SELECT DISTINCT course_name FROM lv", LMS_VIEW)
SQL["t04_sample_rows"] = with_gold("""
SELECT course_id, intern_id, lms_row_id, progress, overall_status, intern_name, course_name FROM lv
ORDER BY md5(lms_row_id || ':42'), lms_row_id LIMIT 15""", LMS_VIEW)
SQL["c25_summary_json"] = with_gold(f"""
SELECT '{{"n_columns":7,"total_rows":' || count(*) || ',"unique_courses":' || count(DISTINCT course_name)
       || ',"unique_interns":' || count(DISTINCT intern_name) || ',"avg_progress":"'
       || printf('%.6f', {rhe('avg(progress)', 6)}) || '"}}' AS summary FROM lv""", LMS_VIEW)
SQL["t03_top_bottom_interns"] = with_gold("""
SELECT * FROM (SELECT intern_name, avg_progress, 'top' AS side FROM per ORDER BY avg_progress DESC, intern_name LIMIT 3)
UNION ALL
SELECT * FROM (SELECT intern_name, avg_progress, 'bottom' AS side FROM per ORDER BY avg_progress, intern_name LIMIT 3)""",
    LMS_VIEW + ", per AS (SELECT intern_name, avg(progress) AS avg_progress FROM lv WHERE intern_name IS NOT NULL GROUP BY intern_name)")
SQL["b39_progress_per_course"] = with_gold(f"""
SELECT "Course Name" AS course_name, {moments_sql('p', ('n', 'mean', 'std_pop'))}
FROM (SELECT *, {to_double_sql(PCT_P)} AS p FROM bronze_lms) GROUP BY "Course Name" """, BRONZE)
SQL["b39_status_shares"] = with_gold("""
SELECT status, n, n / CAST(sum(CAST(n AS DECIMAL(38,0))) OVER () AS DOUBLE) AS share
FROM (SELECT coalesce("Overall Status", 'Not Started') AS status, count(*) AS n FROM bronze_lms GROUP BY 1)""", BRONZE)
RATIOS = {
    "assg_ratio": (frac_sql('"Reviewed / Total Assignments"', 0, '0.0'), nz_sql(frac_sql('"Reviewed / Total Assignments"', 1, '1.0'))),
    "rev_sub_ratio": (frac_sql('"Reviewed / Submitted"', 0, '0.0'), nz_sql(frac_sql('"Reviewed / Submitted"', 1, '0.0'))),
    "kc_ratio": (frac_sql('"Overall Knowledge Check"', 0, '0.0'), nz_sql(frac_sql('"Overall Knowledge Check"', 1, '1.0'))),
    "test_ratio": (frac_sql('"Overall Test"', 0, '0.0'), nz_sql(frac_sql('"Overall Test"', 1, '1.0'))),
}
SQL["b39_ratio_profile"] = with_gold(f"""
SELECT metric, {moments_sql('v', ('n', 'mean', 'std_pop'))} FROM (
""" + "\nUNION ALL\n".join(f"SELECT '{k}' AS metric, {a} / {b} AS v FROM bronze_lms" for k, (a, b) in RATIOS.items())
    + ") GROUP BY metric", BRONZE)
SQL["b39_activity_shares"] = with_gold("""
SELECT activity, n, n / CAST(sum(CAST(n AS DECIMAL(38,0))) OVER () AS DOUBLE) AS share
FROM (SELECT "Activity" AS activity, count(*) AS n FROM bronze_eod GROUP BY 1)""", BRONZE)
SQL["b39_eod_profile"] = with_gold(f"""
SELECT h.mean AS hours_mean, h.std_pop AS hours_std, h.hours_min, h.hours_max,
       r.mean AS records_mean, r.std_samp AS records_std, r.records_min, r.records_max, d.date_start, d.date_end
FROM (SELECT {moments_sql('"Hours"', ('mean', 'std_pop'))}, min("Hours") AS hours_min, max("Hours") AS hours_max FROM bronze_eod) h
CROSS JOIN (SELECT {moments_sql('r', ('mean', 'std_samp'))}, min(r) AS records_min, max(r) AS records_max
            FROM (SELECT count(*) AS r FROM silver_eod GROUP BY full_name)) r
CROSS JOIN (SELECT min(date) AS date_start, max(date) AS date_end FROM silver_eod) d""", BRONZE)
SQL["b41_status_mix"] = with_gold(f"""
SELECT status, n, {rhe('n / CAST(sum(CAST(n AS DECIMAL(38,0))) OVER () AS DOUBLE) * 100', 1)} AS pct
FROM (SELECT "Overall Status" AS status, count(*) AS n FROM bronze_lms GROUP BY 1)""", BRONZE)
SQL["b41_generation_summary"] = with_gold(f"""
SELECT p.mean AS progress_mean, p.std_samp AS progress_std, q.progress_median,
       h.mean AS hours_mean, h.std_samp AS hours_std, h.hours_min, h.hours_max
FROM (SELECT {moments_sql('p', ('mean', 'std_samp'))} FROM pp) p
CROSS JOIN (SELECT quantile_cont(p, 0.5) AS progress_median FROM pp) q
CROSS JOIN (SELECT {moments_sql('"Hours"', ('mean', 'std_samp'))}, min("Hours") AS hours_min, max("Hours") AS hours_max
            FROM bronze_eod) h""", BRONZE + f", pp AS (SELECT {to_double_sql(PCT_P)} AS p FROM bronze_lms)")

# ---------------------------------------------------------------------------
# ML feature table (the models themselves are checked by invariants)
# ---------------------------------------------------------------------------
SQL["m01_features"] = with_gold(f"""
SELECT l.intern_id, progress, CAST(reviewed AS BIGINT) AS reviewed, CAST(total AS BIGINT) AS total_assg,
       reviewed / total AS assg_ratio, {rhe('kc', 6)} AS kc_pct, {rhe('te', 6)} AS test_pct,
       th.total_hours AS hours,
       CAST((progress < 40 OR (progress < 60 AND th.total_hours < (SELECT median(total_hours) FROM th) * 0.75::DOUBLE))
            AS INTEGER) AS is_at_risk
FROM (SELECT intern_id, avg(progress) AS progress, sum(reviewed) AS reviewed,
             CASE WHEN sum(total_assg) = 0 THEN 1 ELSE sum(total_assg) END AS total,
             CAST(sum(CAST(kc_pct AS DECIMAL(38,1))) AS DOUBLE) / count(kc_pct) AS kc,
             CAST(sum(CAST(test_pct AS DECIMAL(38,1))) AS DOUBLE) / count(test_pct) AS te
      FROM lms_s GROUP BY intern_id) l
JOIN th ON l.intern_id = th.intern_id""", SCORES + ",\n" + TH)

SQL["st1_incremental_landing"] = with_gold("SELECT row_id, date, full_name, activity, hours FROM silver_eod", BRONZE)

# ---------------------------------------------------------------------------
# Reload views and set checks
# ---------------------------------------------------------------------------
ICON = ("CASE activity WHEN 'PySpark Session' THEN '⚡' WHEN 'Data Engineering Course' THEN '🏗️' "
        "WHEN 'NumPy Practice' THEN '🔢' WHEN 'Advanced SQL Practice' THEN '🗄️' "
        "WHEN 'Power BI Dashboard Work' THEN '📊' WHEN 'PySpark LMS Learning' THEN '📚' "
        "WHEN 'Pandas Exam Preparation' THEN '🐼' WHEN 'PL/SQL Concepts' THEN '🔍' "
        "WHEN 'Project Research' THEN '🔬' WHEN 'Pandas Practice' THEN '🐼' "
        "WHEN 'Spark Architecture Study' THEN '🏛️' WHEN 'SQL Revision' THEN '🔄' ELSE '•' END")
LABEL = f"{ICON} || ' ' || substr(activity, 1, 18)"
for _k in ("a05_activity_share", "a05_cohort_activity_share"):
    SQL[_k] = SQL[_k].replace(" AS share\nFROM (", f" AS share, {LABEL} AS label\nFROM (", 1)
SQL["f05_activity_share_range"] = in_range(SQL["a05_activity_share"])

SQL["w05_latest_lms_rows"] = with_gold("""
SELECT intern_id, course_id, lms_row_id, progress, overall_status FROM (
  SELECT *, row_number() OVER (PARTITION BY intern_id, course_id ORDER BY lms_row_id DESC) AS rn FROM fact_lms)
WHERE rn = 1""")
SQL["b43_dim_mentor_from_facts"] = with_gold("""
SELECT DISTINCT unnest(list_distinct(list_filter(list_transform(string_split(mentor_string, ', '), lambda x: trim(x)),
                                                 lambda x: x <> ''))) AS mentor_name
FROM fact_lms f JOIN intern_mentors m ON f.intern_id = m.intern_id""")
SQL["b43_outlier_count"] = with_gold(f"SELECT count_if(h > 12.0) AS outlier_days FROM (SELECT {hsum()} AS h FROM fact_activity WHERE date IS NOT NULL GROUP BY intern_id, date)")
SQL["u03_unknown_statuses"] = with_gold("""
SELECT DISTINCT "Overall Status" AS status FROM bronze_lms
WHERE "Overall Status" IS NOT NULL
  AND "Overall Status" NOT IN ('Completed', 'In Progress', 'In progress', 'Not started', 'Not Started')""", BRONZE)
SQL["u04_name_union"] = with_gold("""
SELECT count(*) AS n_names FROM (
  SELECT intern_name AS name FROM silver_lms UNION SELECT full_name FROM silver_eod) WHERE name IS NOT NULL""", BRONZE)
SQL["f09_signed_in_mentor"] = with_gold("""
SELECT mentor_name FROM (SELECT DISTINCT mentor_name FROM bridge)
WHERE mentor_name = (SELECT min(mentor_name) FROM bridge)
   OR NOT EXISTS (SELECT 1 FROM bridge WHERE mentor_name = (SELECT min(mentor_name) FROM bridge))""")

SQL["b39_mentors_per_course"] = with_gold("""
SELECT DISTINCT "Course Name" AS course_name, "Mentor Name" AS mentor FROM bronze_lms WHERE "Mentor Name" IS NOT NULL""", BRONZE)
SQL["b39_completed_values"] = with_gold("""
SELECT DISTINCT "Completed Assignment" AS value FROM bronze_lms WHERE "Completed Assignment" IS NOT NULL""", BRONZE)
SQL["b39_total_values"] = with_gold(f"""
SELECT DISTINCT metric, value FROM (
  SELECT 'assg_total' AS metric, {frac_sql('"Reviewed / Total Assignments"', 1, '1.0')} AS value FROM bronze_lms
  UNION ALL SELECT 'kc_total', {frac_sql('"Overall Knowledge Check"', 1, '1.0')} FROM bronze_lms
  UNION ALL SELECT 'test_total', {frac_sql('"Overall Test"', 1, '1.0')} FROM bronze_lms)""", BRONZE)

SQL["b42_daily_landing_eod"] = with_gold("SELECT date, full_name, activity, hours FROM silver_eod", BRONZE)
SQL["b42_daily_landing_lms"] = with_gold("""
SELECT intern_name, course_name, start_date, end_date, mentor_name, progress, reviewed, total_assg, rev_submitted,
       submitted, overall_status, kc_scored, kc_total, test_scored, test_total FROM silver_lms""", BRONZE)

# The same results by other ways: from a stream's windows and state, from a store
# kept current by changes, through a stored membership index.
SQL["st1_daily_effort"] = SQL["a03_daily_outliers"]
SQL["st1_weekly_effort"] = SQL["a07_weekly_hours_by_year"]
SQL["b04_risk_after_changes"] = SQL["b04_dropout_risk"]
SQL["u02_merge_indexed"] = SQL["u02_merge_new"]
SQL["w02_streaks_rollup"] = SQL["w02_streak_stats"]
SQL["f05_streaks_range"] = in_range(SQL["w02_streak_stats"])
SQL["c10_range_rollup"] = SQL["c10_range_summary"]
SQL["s09_clustered_range"] = SQL["f05_daily_hours_range"]

# Distinct counts and quantiles over the chosen dates, straight from the facts.
SQL["a14_active_interns_range"] = in_range(with_gold("SELECT count(DISTINCT intern_id) AS active FROM fact_activity"))
SQL["a14_activity_interns_range"] = in_range(with_gold(
    "SELECT activity AS name, count(DISTINCT intern_id) AS active FROM fact_activity GROUP BY activity"))
SQL["b20_mentor_retention_range"] = with_gold("""
SELECT mentor_name AS name, count(*) FILTER (now) AS active, count(*) FILTER (past) AS before,
       count(*) FILTER (now AND past) AS retained, count(*) FILTER (now AND NOT past) AS new,
       count(*) FILTER (past AND NOT now) AS lost
FROM (SELECT mentor_name, intern_id, bool_or(date >= DATE '2024-01-08') AS now, bool_or(date < DATE '2024-01-08') AS past
      FROM fact_activity JOIN bridge USING (intern_id)
      WHERE date BETWEEN DATE '2023-12-25' AND DATE '2024-01-21' GROUP BY mentor_name, intern_id)
GROUP BY mentor_name""")
for key, q in (("a16_activity_median_range", 0.5), ("a16_activity_p90_range", 0.9)):
    SQL[key] = in_range(with_gold(f"""
SELECT activity, count(*) AS logs, {q}::DOUBLE AS q, quantile_cont(hours, {q}) AS hours FROM fact_activity
WHERE hours IS NOT NULL GROUP BY activity"""))

# Additive checks, counted on the sheets as they are.
_LMS_CHECKS = {
    "rows": "true", "unnamed": "intern_name IS NULL",
    "unparsed_progress": '"Progress (%)" IS NOT NULL AND ' + to_double_sql("regexp_replace(trim(" + '"Progress (%)"' + "), '%+$', '')") + " IS NULL",
    "unparsed_start": '"Start Date" IS NOT NULL AND start_date IS NULL', "unparsed_end": '"End Date" IS NOT NULL AND end_date IS NULL',
    "progress_above_100": "progress > 100", "progress_outside": "NOT coalesce(progress BETWEEN 0 AND 100, false)",
    "unknown_status": "overall_status NOT IN ('Completed', 'In Progress', 'In progress', 'Not started', 'Not Started')",
    "completed_below_30": "overall_status = 'Completed' AND progress < 30"}
_EOD_CHECKS = {
    "rows": "true", "unnamed": "full_name IS NULL", "undated": "s.date IS NULL", "unparsed_date": 'b."Date" IS NOT NULL AND s.date IS NULL',
    "negative_hours": "s.hours < 0", "hours_outside": "NOT coalesce(s.hours BETWEEN 0 AND 10, false)",
    "unsummable_hours": "s.hours IS NOT NULL AND NOT abs(s.hours) <= 9e15"}
SQL["b03_landing_checks"] = with_gold("\nUNION ALL\n".join(
    f"""SELECT '{sheet}' AS sheet, '{name}' AS "check", count(*) FILTER ({cond}) AS n, {batches}::BIGINT AS batches
FROM silver_{sheet} s JOIN bronze_{sheet} b ON s.row_id = b.row_id"""
    for sheet, batches, checks in (("lms", 2, _LMS_CHECKS), ("eod", 1, _EOD_CHECKS)) for name, cond in checks.items()), BRONZE)
