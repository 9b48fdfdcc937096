"""Exclusions, fills, first rows, accrual and checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import cohort, fill
from ..plans import accrual, staff
from .registry import query
from .standins import EVENTS, cte, table, view, visits, visits_cte


@query(
    "keyword_exclusion",
    """SELECT conv_id, turn, role FROM conversations WHERE conv_id NOT IN (
      SELECT conv_id FROM conversations WHERE text ILIKE '%test%' OR role ILIKE '%sys%')""",
)
def keyword_exclusion(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations")
    kept = cohort.exclude_flagged(turns, "conv_id", {"text": "test"}, {"role": "sys"})
    return kept.select("conv_id", "turn", "role")


@query(
    "flagged_records",
    "SELECT DISTINCT source FROM documents WHERE text ILIKE '%license%'",
)
def flagged_records(spark, sf_dir):
    return cohort.flagged_ids(table(spark, sf_dir, "documents"), "source", {"text": "license"})


def _gappy(spark, sf_dir):
    return view(spark, sf_dir, "answers").select(
        "record_id", "event_id", "ts",
        F.expr("CASE WHEN k % 4 = 0 THEN k END").cast("double").alias("a"),
        F.expr("CASE WHEN k % 10 = 3 THEN event_type END").alias("b"),
    )


_GAPPY = cte("answers") + """, gappy AS (SELECT record_id, event_id, ts,
  CAST(CASE WHEN k % 4 = 0 THEN k END AS DOUBLE) AS a,
  CASE WHEN k % 10 = 3 THEN event_type END AS b FROM answers)"""
_NEXT = "FIRST_VALUE({c} IGNORE NULLS) OVER (PARTITION BY record_id ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
_PREV = "LAST_VALUE({c} IGNORE NULLS) OVER (PARTITION BY record_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


def _filled(first, second=None):
    cells = [
        f"COALESCE({first.format(c=c)}, {(second or 'NULL').format(c=c)}) AS {c}" for c in ("a", "b")
    ]
    return f"WITH {_GAPPY} SELECT record_id, event_id, {', '.join(cells)} FROM gappy"


def _fill(direction, **options):
    def run(spark, sf_dir):
        # A participant may own any share of the events; long ones go hour by hour.
        hour = F.date_trunc("hour", "ts")
        out = fill.fill_within(
            _gappy(spark, sf_dir), ["record_id"], ["ts", "event_id"], ["a", "b"], direction, hour,
            **options,
        )
        return out.drop("ts")

    return run


query("fill_up_then_down", _filled(_NEXT, _PREV))(_fill("updown"))
query("fill_down_then_up", _filled(_PREV, _NEXT))(_fill("downup"))
query("fill_down", _filled(_PREV))(_fill("down"))
query("fill_up", _filled(_NEXT))(_fill("up"))
query("fill_by_chunks", _filled(_NEXT, _PREV))(_fill("updown"))


@query(
    "fill_over_visits",
    f"""WITH {visits_cte()} SELECT record_id, timepoint, COALESCE(
      FIRST_VALUE(answer IGNORE NULLS) OVER (PARTITION BY record_id ORDER BY timepoint
        ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING),
      LAST_VALUE(answer IGNORE NULLS) OVER (PARTITION BY record_id ORDER BY timepoint
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS answer FROM visits""",
)
def fill_over_visits(spark, sf_dir):
    rows = visits(spark, sf_dir).select("record_id", "timepoint", "answer")
    return fill.fill_within(rows, ["record_id"], ["timepoint"], ["answer"])


@query(
    "record_first_known_values",
    f"""WITH {visits_cte()} SELECT record_id,
      (LIST(answer ORDER BY timepoint) FILTER (answer IS NOT NULL))[1] AS answer,
      (LIST(status ORDER BY timepoint) FILTER (status IS NOT NULL))[1] AS status
    FROM visits GROUP BY record_id""",
)
def record_first_known_values(spark, sf_dir):
    return cohort.record_first(visits(spark, sf_dir), "record_id", ["timepoint"], ["answer", "status"])


@query(
    "first_row_per_record",
    """SELECT user_id, event_id, event_type, value FROM (SELECT *, ROW_NUMBER() OVER (
      PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events) WHERE rn = 1""",
)
def first_row_per_record(spark, sf_dir):
    return cohort.first_row(
        table(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"],
        ["event_id", "event_type", "value"],
    )


@query(
    "last_completed_visit",
    f"""WITH {visits_cte()} SELECT record_id, redcap_event_name AS last_event FROM (
      SELECT *, ROW_NUMBER() OVER (PARTITION BY record_id ORDER BY timepoint DESC) AS rn
      FROM visits WHERE status = 'Complete') WHERE rn = 1""",
)
def last_completed_visit(spark, sf_dir):
    return cohort.last_completed(
        visits(spark, sf_dir), "record_id", "timepoint", ["status"], "redcap_event_name"
    )


@query(
    "minimum_group_size",
    """SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (
      SELECT o_custkey FROM orders GROUP BY o_custkey HAVING COUNT(*) >= 12)""",
)
def minimum_group_size(spark, sf_dir):
    return cohort.large_groups(table(spark, sf_dir, "orders"), "o_custkey", 12).select(
        "o_orderkey", "o_custkey"
    )


@query(
    "date_capped_cohort",
    "SELECT o_orderkey, o_custkey FROM orders WHERE CAST(o_orderdate AS DATE) <= DATE '1997-02-28'",
)
def date_capped_cohort(spark, sf_dir):
    return cohort.until(table(spark, sf_dir, "orders"), "o_orderdate", "1997-02-28").select(
        "o_orderkey", "o_custkey"
    )


@query(
    "records_of_capped_cohort",
    """SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT o_custkey FROM orders
      WHERE CAST(o_orderdate AS DATE) <= DATE '1995-03-31')""",
)
def records_of_capped_cohort(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.col("o_custkey").alias("record_id"),
        F.col("o_orderdate").alias("patient_consent_form_timestamp"),
    )
    return accrual.capped(rows, "1995-03-31").select(
        "o_orderkey", F.col("record_id").alias("o_custkey")
    )


@query(
    "enrolment_funnel",
    f"""WITH {cte('staff')}, c AS (SELECT pcc_or_mdc, COUNT(*) AS n_records,
        COUNT(consent_name) AS n_consented,
        COUNT(*) FILTER (consent_name IS NOT NULL AND employee_survey_t1_complete = 'Complete')
          AS n_completed FROM staff GROUP BY pcc_or_mdc)
    SELECT *, n_consented / n_records AS rate_consented, n_completed / n_consented AS rate_completed
    FROM c""",
)
def enrolment_funnel(spark, sf_dir):
    return staff.rates(view(spark, sf_dir, "staff"), ["pcc_or_mdc"])


@query(
    "completed_cohort",
    f"""WITH {cte('staff')} SELECT pcc_or_mdc, COUNT(*) AS n FROM staff WHERE consent_name IS NOT NULL
      AND employee_survey_t1_complete = 'Complete' GROUP BY pcc_or_mdc""",
)
def completed_cohort(spark, sf_dir):
    return staff.completed(view(spark, sf_dir, "staff")).groupBy("pcc_or_mdc").agg(
        F.count(F.lit(1)).alias("n")
    )


AS_OF = "2024-02-10"


def _survey(spark, sf_dir):
    """The visits under the survey's own field names, spread over a year and more."""
    shift = F.make_dt_interval((F.col("record_id") * 37 % 400).cast("int"))
    return visits(spark, sf_dir).select(
        "record_id",
        "redcap_event_name",
        "timepoint",
        F.col("timepoint").alias("_event_order"),
        F.col("status").alias("healthrelated_social_needs_complete"),
        F.col("status").alias("experiences_with_care_complete"),
        (F.col("first_ts") - shift).alias("healthrelated_social_needs_timestamp"),
        F.expr("CASE WHEN n % 5 = 0 THEN 'Incomplete' ELSE 'Complete' END").alias(
            "pasc_symptoms_and_followup_questions_complete"
        ),
        F.expr("CASE WHEN record_id % 3 = 0 THEN 'PCC' ELSE 'MDC' END").alias("site_type"),
        F.expr("CASE WHEN timepoint = 2 THEN answer END").alias("enrollstatus"),
        F.expr("CASE WHEN timepoint = 1 AND record_id % 7 > 0 THEN 'Complete' END").alias(
            "patient_consent_form_complete"
        ),
        F.expr("CASE WHEN n % 2 = 0 THEN 'Yes' END").alias("participatingclinic"),
        F.expr("CASE WHEN n % 3 = 0 THEN redcap_event_name END").alias("pcc_or_mdc_name"),
    )


_STATES = visits_cte() + f""", first AS (SELECT record_id,
    DATE_DIFF('day', CAST(first_ts - TO_DAYS(CAST(record_id * 37 % 400 AS INT)) AS DATE), DATE '{AS_OF}') AS days,
    status AS t1, n % 5 = 0 AS blocked FROM visits WHERE timepoint = 1 AND record_id % 7 > 0),
  later AS (SELECT f.record_id, f.days, f.blocked, f.t1, k.k,
      'T' || k.k AS label, (k.k - 1) * 90 AS due, v.status AS s
    FROM first f CROSS JOIN (SELECT UNNEST([2, 3, 4, 5]) AS k) k
    LEFT JOIN visits v ON v.record_id = f.record_id AND v.timepoint = k.k),
  resolved AS (SELECT *, CASE WHEN blocked THEN 'Incomplete T1 PASC'
      WHEN s IS NULL AND days < due THEN 'Not due for ' || label
      WHEN s IS NULL AND days < due + 14 THEN 'Incomplete (within window)'
      WHEN (s IS NULL OR s = 'Incomplete') AND days >= due + 14 THEN 'Incomplete (past window)'
      ELSE s END AS state FROM later),
  states AS (SELECT record_id, ANY_VALUE(days) AS days_since_t1, MAX(t1) AS t1_status,
      MAX(state) FILTER (k = 2) AS t2_status, MAX(state) FILTER (k = 3) AS t3_status,
      MAX(state) FILTER (k = 4) AS t4_status, MAX(state) FILTER (k = 5) AS t5_status
    FROM resolved GROUP BY record_id)"""


def _states(spark, sf_dir):
    rows = _survey(spark, sf_dir)
    return rows, accrual.visit_states(rows, accrual.consented(accrual.record_table(rows)), AS_OF)


@query("visit_window_states", f"WITH {_STATES} SELECT * FROM states")
def visit_window_states(spark, sf_dir):
    return _states(spark, sf_dir)[1].withColumn("days_since_t1", F.col("days_since_t1").cast("bigint"))


@query(
    "completion_by_site_type",
    f"""WITH {_STATES}, long AS (
        SELECT CASE WHEN record_id % 3 = 0 THEN 'PCC' ELSE 'MDC' END AS "group", UNNEST(['t1_status',
          't2_status', 't3_status', 't4_status']) AS variable,
          UNNEST([t1_status, t2_status, t3_status, t4_status]) AS level FROM states),
      c AS (SELECT "group", variable, level, COUNT(*) AS n FROM long GROUP BY ALL)
    SELECT *, CAST(COALESCE(SUM(CASE WHEN level IS NOT NULL THEN n END) OVER (PARTITION BY "group", variable), 0)
        AS BIGINT) AS total,
      CASE WHEN level IS NOT NULL THEN ROUND(n * 100 / SUM(CASE WHEN level IS NOT NULL THEN n END)
        OVER (PARTITION BY "group", variable), 6) END AS percent FROM c""",
)
def completion_by_site_type(spark, sf_dir):
    rows, states = _states(spark, sf_dir)
    return accrual.completion_by_site(states, rows).withColumn("percent", F.round("percent", 6))


@query(
    "accrual_record_table",
    f"""WITH {visits_cte()}, f AS (SELECT *, CASE WHEN timepoint = 2 THEN answer END AS e,
        CASE WHEN timepoint = 1 AND record_id % 7 > 0 THEN 'Complete' END AS c,
        CASE WHEN n % 2 = 0 THEN 'Yes' END AS p,
        CASE WHEN n % 3 = 0 THEN redcap_event_name END AS m FROM visits)
    SELECT record_id, COALESCE(MAX(e), 'TBD') AS enrollstatus,
      COALESCE(MAX(c), 'Incomplete') AS patient_consent_form_complete,
      COALESCE((LIST(status ORDER BY timepoint) FILTER (status IS NOT NULL))[1], 'Unknown')
        AS healthrelated_social_needs_complete,
      MAX(p) AS participatingclinic,
      (LIST(m ORDER BY timepoint) FILTER (m IS NOT NULL))[1] AS pcc_or_mdc_name
    FROM f GROUP BY record_id""",
)
def accrual_record_table(spark, sf_dir):
    return accrual.record_table(_survey(spark, sf_dir))


@query(
    "event_presence",
    f"WITH {visits_cte()} SELECT record_id, "
    + ", ".join(
        f"CAST(MAX(CASE WHEN redcap_event_name = '{e}' THEN 1 ELSE 0 END) AS INT) AS {e}" for e in EVENTS
    )
    + " FROM visits GROUP BY record_id",
)
def event_presence(spark, sf_dir):
    return accrual.presence(visits(spark, sf_dir), EVENTS)


@query(
    "data_check_violations",
    f"""WITH {cte('staff')} SELECT 'complete without consent' AS "check", COUNT(*) AS n FROM staff
      WHERE consent_name IS NULL AND employee_survey_t1_complete = 'Complete'
    UNION ALL SELECT 'experience out of range', COUNT(*) FROM staff WHERE experience > 12""",
)
def data_check_violations(spark, sf_dir):
    found = cohort.violations(
        view(spark, sf_dir, "staff"),
        {
            "complete without consent": F.col("consent_name").isNull()
            & (F.col("employee_survey_t1_complete") == "Complete"),
            "experience out of range": F.col("experience") > 12,
        },
        ["record_id"],
    )
    return found.groupBy("check").agg(F.count(F.lit(1)).alias("n"))


@query(
    "repeated_names",
    "SELECT p_name, p_brand, COUNT(*) AS n FROM part GROUP BY ALL HAVING COUNT(*) > 1",
)
def repeated_names(spark, sf_dir):
    return cohort.repeated(table(spark, sf_dir, "part"), ["p_name", "p_brand"])
