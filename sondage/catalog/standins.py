"""Survey-shaped views of the given tables.

Each view is a list of column expressions that Spark and the checking engine both
accept, so a query and its check start from the same rows and share nothing else.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed_values as fixed

EVENTS = list(fixed.TIMEPOINTS)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(expr: str, values: list[str | None]) -> str:
    """Text chosen by a number 0, 1, ...; ``None`` is a missing answer."""
    cases = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values) if v is not None)
    return f"CASE {expr} {cases} END"


def _line(k: int) -> str:
    return f"(l_orderkey + l_suppkey * {2 * k + 1})"


def _order(k: int) -> str:
    return f"(o_orderkey + o_custkey * {2 * k + 1})"


def _rating(k: int) -> str:
    """1..5, missing on a pattern that gives rows with none, some and all missing."""
    missing = f"(l_partkey + l_suppkey * {k}) % 9 = 0"
    return f"CASE WHEN {missing} THEN NULL ELSE {_line(k)} % 5 + 1 END"


CLIMATE = ["expect_certain_number", "support_people", "get_help", "rewarded", "priority",
           "appreciation"]
CULTURE = {"improvement": ["after_change", "learn", "reflect"],
           "relations": ["trust", "listen", "environment"]}
_CULTURE = [i for items in CULTURE.values() for i in items]

# One line item is one answered staff form.
STAFF = {
    "record_id": "l_orderkey * 10 + l_linenumber",
    "pcc_or_mdc": "CASE WHEN l_linestatus = 'O' THEN 'practice' ELSE 'clinic' END",
    "site": "l_returnflag",
    "experience": "CASE WHEN l_linenumber = 7 THEN NULL ELSE l_quantity / 4 END",
    "consent_name": "CASE WHEN l_suppkey % 9 = 0 THEN NULL ELSE 'signed' END",
    "employee_survey_t1_complete": pick("l_partkey % 4", ["Incomplete", "Complete", "Complete"]),
    "burnout": pick(f"{_line(30)} % 4", ["none", "some", "strong"]),
    "help_manage": pick(f"{_line(31)} % 5", ["low", "medium", "high", None, "low"]),
    **{i: _rating(k) for k, i in enumerate(fixed.STIGMA_ITEMS)},
    **{i: _rating(k) for k, i in enumerate(CLIMATE, 10)},
    **{i: _rating(k) for k, i in enumerate(_CULTURE, 16)},
}
AGREE = [None, "SD (1)", "D (2)", "N (3)", "A (4)", "SA (5)"]
STAFF_TEXT = {
    "pcc_or_mdc": STAFF["pcc_or_mdc"],
    "site": STAFF["site"],
    "burnout": STAFF["burnout"],
    **{i: pick(f"{_line(k)} % 6", AGREE) for k, i in enumerate(fixed.STIGMA_ITEMS)},
}

HOW_OFTEN = ["Never", "Rarely", "Sometimes", "Often", "Very Often", None]
SYMPTOM = ["No", "Yes", "Yes, but not now", "No", "Yes", "No", "Yes"]
_BASE = {
    "record_id": "o_orderkey",
    "timepoint": "CAST(o_orderkey % 5 + 1 AS INT)",
    "redcap_event_name": pick("o_orderkey % 5", EVENTS),
    "site_type": "CASE WHEN o_custkey % 2 = 0 THEN 'PCC' ELSE 'MDC' END",
    "site_name": "CONCAT('clinic ', CAST(o_custkey AS VARCHAR(20)))",
    "months_symps": "CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE o_totalprice END",
    "patient_age": f"CASE WHEN {_order(1)} % 13 = 0 THEN NULL ELSE {_order(2)} % 90 END",
    "patient_gender": pick(
        f"{_order(3)} % 7",
        ["Female", "Male", "Non-binary", "Transgender Male", "Prefer not to answer", None, "Female"],
    ),
    "patient_ethn": pick(
        f"{_order(4)} % 5", [None, "Hispanic or Latino"] + ["Not Hispanic or Latino"] * 3
    ),
    **{f"patient_race___{j}": f"CASE WHEN {_order(4 + j)} % 5 = 0 THEN 1 ELSE 0 END"
       for j in range(1, 8)},
    "lcdiagnosis": pick(f"{_order(12)} % 3", ["Yes", "No"]),
}
# One order is one patient form.
PATIENT = {
    **_BASE,
    "pcc_appts": pick(f"{_order(13)} % 3", ["Yes", "No"]),
    "mdc_appts": pick(f"{_order(14)} % 4", ["Yes", "No", "Yes"]),
    **{f"{i}_{s}": pick(f"{_order(15 + 3 * n + k)} % 6", HOW_OFTEN)
       for n, s in enumerate(("pcc", "mdc")) for k, i in enumerate(("serious", "consequences", "talk"))},
    "appt_pcc": pick(f"{_order(21)} % 3", ["Yes", "No", "Yes"]),
    "explain_pcc": pick(f"{_order(22)} % 4", ["Yes, definitely", "Yes, somewhat", "No"]),
    "listen_pcc": pick(f"{_order(23)} % 4", ["Yes, definitely", "Yes, somewhat", "No"]),
    "living_sit": f"NULLIF({_order(24)} % 4, 0)",
    **{f"living_probs___{j}": f"CASE WHEN {_order(24 + j)} % 17 = 0 THEN NULL WHEN {_order(24 + j)} "
       f"% 5 = 1 THEN 1 ELSE 0 END" for j in range(1, 8)},
    "food_worry": f"NULLIF({_order(32)} % 4, 0)",
    "food_last": f"NULLIF({_order(33)} % 4, 0)",
    "transport": f"NULLIF({_order(34)} % 3, 0)",
    "utlities": f"NULLIF({_order(35)} % 4, 0)",
    "fin_strain": f"NULLIF({_order(36)} % 4, 0)",
    "help_daytoday": f"NULLIF({_order(37)} % 5, 0)",
    "lonely": f"NULLIF({_order(38)} % 6, 0)",
}
# The symptom part of the same form. A missing answer is rare, a missing gate is not.
SYMPTOMS = {
    "record_id": "o_orderkey",
    "redcap_event_name": _BASE["redcap_event_name"],
    "patient_gender": _BASE["patient_gender"],
    "site_type": _BASE["site_type"],
    "ps_ptpasc": pick("o_orderkey % 5", ["Yes", None, "No", "Yes", None]),
    "ps2_ptpasc": pick("o_orderkey % 5", [None, "Yes", None, "No", "No"]),
    "ps_ptpasc_t5": pick("o_custkey % 7", ["Yes", None, "No"]),
    **{n: f"CASE WHEN {_order(50 + k)} % 41 = 0 THEN NULL ELSE {pick(f'{_order(50 + k)} % 7', SYMPTOM)} END"
       for k, n in enumerate(fixed.SYMPTOM_WEIGHTS)},
    **{n: f"CASE WHEN {_order(70 + k)} % 6 = 0 THEN NULL ELSE {_order(70 + k)} % 2 END"
       for k, n in enumerate(fixed.BRANCHED_SYMPTOMS)},
}
DIMENSIONS = {
    f"ps_{s}_{d}": f"CASE WHEN {_order(80 + 3 * n + k)} % 6 = 5 THEN -88 ELSE {_order(80 + 3 * n + k)} % 6 END"
    for n, s in enumerate(("fatigue", "cough", "pain"))
    for k, d in enumerate(fixed.SYMPTOM_DIMENSIONS)
}
_HEALTH = ["1 - Poor", "2 - Fair", "3 - Good", "4 - Very good", "5 - Excellent", None]
_HOW_WELL = ["Poor", "Fair", "Good", "Very good", "Excellent", None]
GLOBAL_HEALTH = {
    "record_id": "o_orderkey",
    "site_type": _BASE["site_type"],
    **{f"promis_global0{j}": pick(f"{_order(100 + j)} % 6", _HEALTH) for j in (1, 2, 3, 4, 5, 6, 7)},
    "avg_pain": pick(f"{_order(108)} % 12", ["0 No pain", "1", "2", "3", "4", "5", "6", "7", "8", "9",
                                             "10 Worst pain imagin-able"]),
    "avg_fatigue": pick(f"{_order(109)} % 6", list(fixed.FATIGUE_SCORES)),
    "bothered": pick(f"{_order(110)} % 6", list(fixed.BOTHERED_SCORES)),
}

# One event row is one answered field of a participant.
ANSWERS = {
    "record_id": "user_id",
    "event_id": "event_id",
    "event_type": "event_type",
    "ts": "ts",
    "k": "CAST(regexp_extract(props, '([0-9]+)', 1) AS INT)",
    "value": "value",
}
VISIT_OF = {"signup": 1, "view": 2, "click": 3, "purchase": 4, "error": 5}
EVENT_CASE = "CASE event_type " + " ".join(
    f"WHEN '{t}' THEN '{EVENTS[k - 1]}'" for t, k in VISIT_OF.items()) + " END"
POINT_CASE = "CASE event_type " + " ".join(
    f"WHEN '{t}' THEN {k}" for t, k in VISIT_OF.items()) + " END"

VIEWS = {
    "staff": ("lineitem", STAFF),
    "staff_text": ("lineitem", STAFF_TEXT),
    "patient": ("orders", PATIENT),
    "symptoms": ("orders", SYMPTOMS),
    "dimensions": ("orders", DIMENSIONS),
    "health": ("orders", GLOBAL_HEALTH),
    "answers": ("events", ANSWERS),
}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    source, cols = VIEWS[name]
    return table(spark, sf_dir, source).selectExpr(*[f"{e} AS {n}" for n, e in cols.items()])


def cte(*names: str) -> str:
    """The same views as common table expressions."""
    return ", ".join(
        f"{n} AS (SELECT {', '.join(f'{e} AS {c}' for c, e in VIEWS[n][1].items())} FROM {VIEWS[n][0]})"
        for n in names
    )


def visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per participant and visit, as the survey has it. Grouping makes the
    visits unique, so a record has at most five rows however many events it has."""
    answers = view(spark, sf_dir, "answers")
    return (
        answers.groupBy(
            "record_id",
            F.expr(EVENT_CASE).alias("redcap_event_name"),
            F.expr(POINT_CASE).alias("timepoint"),
        )
        .agg(
            F.min("ts").alias("first_ts"),
            F.max("k").alias("k"),
            F.count(F.lit(1)).alias("n"),
            F.avg("value").alias("score"),
        )
        .withColumns(
            {
                "status": F.expr("CASE k % 4 WHEN 0 THEN NULL WHEN 1 THEN 'Incomplete' ELSE 'Complete' END"),
                "answer": F.expr("CASE WHEN k % 3 = 0 THEN NULL ELSE CONCAT('answer ', CAST(k AS VARCHAR(9))) END"),
            }
        )
    )


VISITS_CTE = f"""visits AS (SELECT *,
  CASE k % 4 WHEN 0 THEN NULL WHEN 1 THEN 'Incomplete' ELSE 'Complete' END AS status,
  CASE WHEN k % 3 = 0 THEN NULL ELSE CONCAT('answer ', CAST(k AS VARCHAR)) END AS answer
  FROM (SELECT record_id, {EVENT_CASE} AS redcap_event_name, {POINT_CASE} AS timepoint,
          MIN(ts) AS first_ts, MAX(k) AS k, COUNT(*) AS n, AVG(value) AS score
        FROM answers GROUP BY ALL))"""


def visits_cte() -> str:
    return cte("answers") + ", " + VISITS_CTE
