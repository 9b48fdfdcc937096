"""Recodes and questionnaire scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixed_values as fixed
from ..functions import nulls, recode
from ..operators import scales
from ..plans import patient, records, staff
from .registry import query
from .standins import CLIMATE, CULTURE, cte, table, view

def tally(df, *cols):
    """Rows per combination, so a whole-table recode returns a short table."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))


@query(
    "value_map",
    """SELECT CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'high'
      WHEN o_orderpriority = '3-MEDIUM' THEN 'medium' END AS urgency,
      CASE WHEN o_orderpriority = '5-LOW' THEN 'low' ELSE o_orderpriority END AS kept, COUNT(*) AS n
    FROM orders GROUP BY ALL""",
)
def value_map(spark, sf_dir):
    urgency = recode.value_map(
        "o_orderpriority", {("1-URGENT", "2-HIGH"): "high", "3-MEDIUM": "medium"}
    )
    kept = recode.value_map("o_orderpriority", {"5-LOW": "low"}, recode.KEEP)
    return tally(table(spark, sf_dir, "orders"), urgency.alias("urgency"), kept.alias("kept"))


@query(
    "age_bands",
    f"""WITH {cte('patient')} SELECT CASE WHEN patient_age >= 18 AND patient_age < 35 THEN '18-34'
      WHEN patient_age >= 35 AND patient_age < 65 THEN '35-64' WHEN patient_age >= 65 THEN '65+' END
      AS age_group, COUNT(*) AS n FROM patient GROUP BY ALL""",
)
def age_bands(spark, sf_dir):
    group = recode.band("patient_age", fixed.AGE_BANDS).alias("age_group")
    return tally(view(spark, sf_dir, "patient"), group)


@query(
    "set_bands",
    """SELECT CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'MACHINERY') THEN 'industry'
      WHEN c_mktsegment = 'BUILDING' THEN 'building' END AS sector,
      CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'MACHINERY') THEN 'industry' ELSE 'rest' END AS side,
      COUNT(*) AS n FROM customer GROUP BY ALL""",
)
def set_bands(spark, sf_dir):
    industry = {"industry": ["AUTOMOBILE", "MACHINERY"]}
    return tally(
        table(spark, sf_dir, "customer"),
        recode.set_band("c_mktsegment", {**industry, "building": ["BUILDING"]}).alias("sector"),
        recode.set_band("c_mktsegment", industry, "rest").alias("side"),
    )


@query(
    "experience_bands",
    f"""WITH {cte('staff')} SELECT CASE WHEN experience IS NULL THEN NULL WHEN experience <= 1 THEN '<=1'
      WHEN experience <= 5 THEN '2-5' WHEN experience <= 10 THEN '6-10' ELSE '>10' END AS experience_cat,
      CASE pcc_or_mdc WHEN 'practice' THEN 'PCC' WHEN 'clinic' THEN 'MDC' END AS pcc_or_mdc,
      COUNT(*) AS n FROM staff GROUP BY ALL""",
)
def experience_bands(spark, sf_dir):
    return tally(staff.recode(view(spark, sf_dir, "staff")), "experience_cat", "pcc_or_mdc")


_RACE_SUM = " + ".join(f"patient_race___{j}" for j in range(1, 8))
_RACE = "CASE " + " ".join(f"WHEN {c} = 1 THEN '{r}'" for c, r in fixed.RACES.items()) + " END"


@query(
    "demographic_groups",
    f"""WITH {cte('patient')} SELECT
      CASE WHEN patient_age >= 65 THEN '65+' WHEN patient_age >= 35 THEN '35-64'
        WHEN patient_age >= 18 THEN '18-34' END AS age_group,
      CASE WHEN patient_gender IN ('Female', 'Male') THEN patient_gender
        WHEN patient_gender IS NOT NULL THEN 'Unknown/Other' END AS gender_group,
      CASE WHEN patient_ethn = 'Hispanic or Latino' THEN patient_ethn
        WHEN {_RACE_SUM} > 1 THEN 'More than one race' ELSE {_RACE} END AS race, COUNT(*) AS n
    FROM patient GROUP BY ALL""",
)
def demographic_groups(spark, sf_dir):
    return tally(
        patient.demographics(view(spark, sf_dir, "patient")), "age_group", "gender_group", "race"
    )


@query(
    "race_open_with_ethnicity",
    f"""WITH {cte('patient')} SELECT CASE WHEN patient_ethn IS NULL THEN NULL
        WHEN patient_ethn = 'Hispanic or Latino' THEN patient_ethn
        WHEN {_RACE_SUM} > 1 THEN 'More than one race' ELSE {_RACE} END AS race, COUNT(*) AS n
    FROM patient GROUP BY ALL""",
)
def race_open_with_ethnicity(spark, sf_dir):
    form = view(spark, sf_dir, "patient")
    return tally(patient.demographics(form, keep_race_when_ethnicity_unknown=False), "race")


@query(
    "checked_flags",
    f"""WITH {cte('patient')} SELECT CAST(CASE WHEN pcc_appts IS NULL THEN NULL WHEN pcc_appts = 'Yes' THEN 1
      ELSE 0 END AS DOUBLE) AS visited, COUNT(*) AS n FROM patient GROUP BY ALL""",
)
def checked_flags(spark, sf_dir):
    return tally(
        view(spark, sf_dir, "patient"), recode.checked("pcc_appts", "Yes").cast("double").alias("visited")
    )


@query(
    "missing_to_level",
    f"""WITH {cte('patient')} SELECT COALESCE(pcc_appts, 'Unknown') AS pcc_appts,
      COALESCE(talk_mdc, 'Missing') AS talk_mdc, COUNT(*) AS n FROM patient GROUP BY ALL""",
)
def missing_to_level(spark, sf_dir):
    return tally(
        view(spark, sf_dir, "patient"),
        recode.name_missing("pcc_appts").alias("pcc_appts"),
        recode.name_missing("talk_mdc", "Missing").alias("talk_mdc"),
    )


@query(
    "status_clean_up",
    """WITH s AS (SELECT o_orderpriority || ' (' || o_orderstatus || ')' AS raw FROM orders),
      t AS (SELECT TRIM(REGEXP_REPLACE(raw, '\\(.*', '')) AS status FROM s)
    SELECT CASE WHEN status LIKE '%URGENT%' THEN 'No response' WHEN status LIKE '%SPECIFIED%'
      THEN 'Not eligible' ELSE status END AS status, COUNT(*) AS n FROM t GROUP BY ALL""",
)
def status_clean_up(spark, sf_dir):
    raw = F.concat("o_orderpriority", F.lit(" ("), "o_orderstatus", F.lit(")"))
    status = recode.first_match(
        recode.drop_parenthesis(raw), [("URGENT", "No response"), ("SPECIFIED", "Not eligible")]
    )
    return tally(table(spark, sf_dir, "orders"), status.alias("status"))


@query(
    "leading_number_and_text",
    """SELECT CAST(SUBSTR(o_orderpriority, 1, 1) AS INT) AS number,
      TRIM(SUBSTR(o_orderpriority, INSTR(o_orderpriority, '-') + 1)) AS text, COUNT(*) AS n
    FROM orders GROUP BY ALL""",
)
def leading_number_and_text(spark, sf_dir):
    return tally(
        table(spark, sf_dir, "orders"),
        recode.leading_number("o_orderpriority").alias("number"),
        recode.after_dash("o_orderpriority").alias("text"),
    )


def _digit(c):
    return f"CAST(SUBSTR({c}, 1, 1) AS INT)"


_PAIN = """CASE WHEN avg_pain = '0 No pain' THEN 5 WHEN avg_pain IN ('1','2','3') THEN 4
  WHEN avg_pain IN ('4','5','6') THEN 3 WHEN avg_pain IN ('7','8','9') THEN 2
  WHEN avg_pain LIKE '10%' THEN 1 END"""
_FATIGUE = """CASE avg_fatigue WHEN 'None' THEN 5 WHEN 'Mild' THEN 4 WHEN 'Moderate' THEN 3
  WHEN 'Severe' THEN 2 WHEN 'Very severe' THEN 1 END"""
_BOTHERED = """CASE bothered WHEN 'Never' THEN 5 WHEN 'Rarely' THEN 4 WHEN 'Sometimes' THEN 3
  WHEN 'Often' THEN 2 WHEN 'Always' THEN 1 END"""


def _miss(*parts):
    return " + ".join(f"CASE WHEN ({p}) IS NULL THEN 1 ELSE 0 END" for p in parts)


_PHYS = (_PAIN, _digit("promis_global07"), _digit("promis_global03"), _FATIGUE)
_MENT = (_digit("promis_global02"), _digit("promis_global04"), _digit("promis_global05"), _BOTHERED)


@query(
    "global_health_scores",
    f"""WITH {cte('health')}, s AS (SELECT {' + '.join(_PHYS)} AS phys, {' + '.join(_MENT)} AS ment,
        {_miss(*_PHYS)} AS n_miss_phys, {_miss(*_MENT)} AS n_miss_ment,
        TRIM(SUBSTR(promis_global01, INSTR(promis_global01, '-') + 1)) AS promis_1 FROM health)
    SELECT promis_1, CAST(phys AS DOUBLE) AS promis_global_phys, CAST(ment AS DOUBLE) AS promis_global_ment,
      n_miss_phys, n_miss_ment, CAST(2 * a.n_nationkey + 16 AS DOUBLE) AS promis_pht,
      CAST(2 * b.n_nationkey + 16 AS DOUBLE) AS promis_mht,
      COUNT(*) AS n
    FROM s LEFT JOIN nation a ON phys = a.n_nationkey LEFT JOIN nation b ON ment = b.n_nationkey
    GROUP BY ALL""",
)
def global_health_scores(spark, sf_dir):
    form = view(spark, sf_dir, "health")
    late = {
        f"{s}{x}": F.lit(None).cast("string")
        for s in patient.GLOBAL_HEALTH_SOURCES.values()
        for x in ("_v2", "_t5")
    }
    # The number of a nation stands for a raw sum, which runs from 4 to 20.
    score_table = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("Raw Summed Score"),
        (F.col("n_nationkey") * 2 + 16).cast("double").alias("T-Score"),
    )
    scored = patient.global_health(form.withColumns(late), score_table, score_table)
    return tally(
        scored.withColumns(
            {c: F.col(c).cast("double") for c in ("promis_global_phys", "promis_global_ment")}
        ),
        "promis_1", "promis_global_phys", "promis_global_ment", "n_miss_phys", "n_miss_ment",
        "promis_pht", "promis_mht",
    )


@query(
    "missing_item_counts",
    f"""WITH {cte('staff')} SELECT {_miss(*fixed.STIGMA_ITEMS)} AS n_stigma, {_miss(*CLIMATE)} AS n_climate,
      COUNT(*) AS n FROM staff GROUP BY ALL""",
)
def missing_item_counts(spark, sf_dir):
    counted = scales.add_missing_counts(
        view(spark, sf_dir, "staff"), {"n_stigma": fixed.STIGMA_ITEMS, "n_climate": CLIMATE}
    )
    return tally(counted, "n_stigma", "n_climate")


_WEIGHTED = " + ".join(
    f"CASE WHEN {s} IS NULL THEN NULL WHEN {s} LIKE '%Yes%' THEN {w} ELSE 0 END"
    for s, w in fixed.SYMPTOM_WEIGHTS.items()
)


@query(
    "weighted_symptom_score",
    f"""WITH {cte('symptoms')}, s AS (SELECT redcap_event_name, CASE WHEN ps_ptpasc = 'Yes' OR
        ps2_ptpasc = 'Yes' OR ps_ptpasc_t5 = 'Yes' THEN {_WEIGHTED} END AS score FROM symptoms)
    SELECT redcap_event_name, CAST(score AS DOUBLE) AS pasc_score,
      CAST(CASE WHEN score >= 12 THEN 1 WHEN score < 12 THEN 0 END AS DOUBLE) AS pasc_positive,
      COUNT(*) AS n FROM s GROUP BY ALL""",
)
def weighted_symptom_score(spark, sf_dir):
    form = view(spark, sf_dir, "symptoms")
    tails = [n.removeprefix("ps_") for n in fixed.SYMPTOM_WEIGHTS]
    late = {f"ps2_{t}": F.lit(None).cast("string") for t in tails}
    late |= {f"ps_{t}_t5": F.lit(None).cast("string") for t in tails}
    scored = patient.symptoms(form.withColumns(late))
    return tally(
        scored.withColumns({c: F.col(c).cast("double") for c in ("pasc_score", "pasc_positive")}),
        "redcap_event_name", "pasc_score", "pasc_positive",
    )


_DIM = " UNION ALL ".join(
    f"SELECT 'ps_{s}' AS symptom, '{d}' AS dimension, "
    f"CAST(NULLIF(ps_{s}_{d}, -88) AS DOUBLE) + {0 if d == 'burden' else 1} AS v FROM dimensions"
    for s in ("fatigue", "cough", "pain") for d in fixed.SYMPTOM_DIMENSIONS
)


@query(
    "symptom_dimension_means",
    f"""WITH {cte('dimensions')}, l AS ({_DIM}) SELECT symptom, dimension, ROUND(AVG(v), 6) AS mean
    FROM l GROUP BY ALL""",
)
def symptom_dimension_means(spark, sf_dir):
    return patient.severity_means(view(spark, sf_dir, "dimensions")).withColumn(
        "mean", F.round("mean", 6)
    )


def _often(c):
    return f"CASE {c} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in fixed.UNDERSTANDING_SCORES.items()) + " END"


def _lou(site):
    items = [_often(f"{i}_{site}") for i in patient.UNDERSTANDING_ITEMS]
    total = " + ".join(f"COALESCE({i}, 0)" for i in items)
    missing = _miss(*items)
    return (
        f"CASE WHEN {site}_appts = 'Yes' AND ({missing}) < 2 THEN "
        f"ROUND(({total}) / CAST(3 - ({missing}) AS DOUBLE), 6) END AS lou_score_{site}"
    )


@query(
    "understanding_scores",
    f"""WITH {cte('patient')} SELECT {_lou('pcc')}, {_lou('mdc')}, COUNT(*) AS n FROM patient GROUP BY ALL""",
)
def understanding_scores(spark, sf_dir):
    scored = patient.understanding(view(spark, sf_dir, "patient"))
    return tally(
        scored, *[F.round(f"lou_score_{s}", 6).alias(f"lou_score_{s}") for s in ("pcc", "mdc")]
    )


_PROBS = " + ".join(f"living_probs___{j}" for j in range(1, 8))
_NEEDS = f"""SELECT *,
  CASE WHEN {_PROBS} IS NULL THEN NULL WHEN living_sit IN (2, 3) OR {_PROBS} > 0 THEN 1 ELSE 0 END AS living_need,
  CASE WHEN food_worry IN (1, 2) OR food_last IN (1, 2) THEN 1 ELSE 0 END AS food_need,
  CASE WHEN transport IS NULL THEN NULL WHEN transport = 1 THEN 1 ELSE 0 END AS transport_need,
  CASE WHEN utlities IN (1, 2) THEN 1 ELSE 0 END AS utlities_need,
  CASE WHEN fin_strain IN (1, 2) THEN 1 ELSE 0 END AS fin_strain_need,
  CASE WHEN lonely IS NULL THEN NULL WHEN help_daytoday IN (3, 4) OR lonely > 3 THEN 1 ELSE 0 END AS social_need
  FROM patient"""


def _needs_check(summed):
    total = " + ".join(f"COALESCE({c}, 0)" for c in summed)
    needs = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in patient.NEEDS)
    return f"""WITH {cte('patient')}, d AS ({_NEEDS}) SELECT {needs},
      CAST({total} AS BIGINT) AS hrsn_need_score, COUNT(*) AS n FROM d GROUP BY ALL"""


def _needs(raw_codes):
    def run(spark, sf_dir):
        scored = patient.social_needs(view(spark, sf_dir, "patient"), raw_codes)
        return tally(
            scored,
            *[F.col(c).cast("double").alias(c) for c in patient.NEEDS],
            F.col("hrsn_need_score").cast("bigint").alias("hrsn_need_score"),
        )

    return run


query("social_needs_score", _needs_check(patient.NEEDS))(_needs(False))
query(
    "social_needs_score_with_codes",
    _needs_check(["living_need", "food_need", "transport", "utlities", "fin_strain", "social_need"]),
)(_needs(True))


# One part is one person of the intake form; each line item answers one question.
_CODES = {
    "R_AUDIT_ALCOHOL_STD_DRINKS": ["0", "1", "2", "3"],
    "R_SOCIAL_CONNECTIONS_MARITAL_STATUS": ["3", "4", "5", "6", "7", "8"],
    "R_CHILDREN'S_HEALTHWATCH_HOUSING_TIMES_MOVED": ["0", "1", "2", "3"],
    "R_EXERCISE_DAYS_PER_WEEK": ["0", "1", "2", "3", "4", "5", "6", "7"],
    "R_EXERCISE_MINUTES_PER_DAY": ["1", "2", "3", "4", "5", "6"],
    "R_PAC_B1300": ["Never", "Rarely", "Sometimes", "Often", "Always"],
}
_ALL_CODES = [
    _CODES.get(q) or [k for k in fixed.RECORD_ANSWERS[q] if len(k) == 1] for q in records.QUESTIONS
]
_Q = f"(l_orderkey + l_suppkey * 5 + l_linenumber) % {len(records.QUESTIONS)}"
_V = "(l_orderkey * 3 + l_partkey + l_linenumber * 7)"


def _intake(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    names = F.array(*[F.lit(q.replace("_", " ")) for q in records.QUESTIONS])
    codes = F.array(*[F.array(*[F.lit(c) for c in cs]) for cs in _ALL_CODES])
    where = F.expr(f"CAST({_Q} AS INT)")
    mine = F.get(codes, where)
    return lines.select(
        F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("arb_person_id"),
        F.get(names, where).alias("flowsheet_row_name"),
        F.get(mine, (F.expr(_V) % F.size(mine)).cast("int")).alias("VALUE"),
        F.date_format("l_shipdate", "MM/dd/yyyy").alias("observation_date"),
    )


def _quoted_list(values):
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


_INTAKE = f"""intake AS (SELECT arb_person_id, q, codes[v % LEN(codes) + 1] AS value, d FROM (SELECT
    'P' || l_partkey AS arb_person_id, {_quoted_list(records.QUESTIONS)}[{_Q} + 1] AS q,
    [{', '.join(_quoted_list(cs) for cs in _ALL_CODES)}][{_Q} + 1] AS codes, {_V} AS v,
    CAST(l_shipdate AS DATE) AS d FROM lineitem))"""
_COLS = {q: q.replace("'", "") for q in records.QUESTIONS}
_WIDE = f"""{_INTAKE}, wide AS (SELECT arb_person_id, """ + ", ".join(
    f"""ARG_MAX(value, CAST(d AS VARCHAR) || value) FILTER (q = '{q.replace("'", "''")}') AS "{c}" """
    for q, c in _COLS.items()
) + " FROM intake GROUP BY arb_person_id)"


def _label(question):
    col = _COLS[question]
    cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in fixed.RECORD_ANSWERS[question].items())
    return f'CASE "{col}" {cases} ELSE "{col}" END AS "{col}"'


@query(
    "intake_answers_by_person",
    f"WITH {_WIDE} SELECT arb_person_id, " + ", ".join(
        _label(q) if q in fixed.RECORD_ANSWERS else f'"{c}"' for q, c in _COLS.items()
    ) + " FROM wide",
)
def intake_answers_by_person(spark, sf_dir):
    wide = records.answers_as_text(records.person_rows(_intake(spark, sf_dir)))
    return wide.withColumnsRenamed({q: c for q, c in _COLS.items() if q != c})


def _any(*conds):
    return "CASE WHEN " + " OR ".join(f"COALESCE({c}, FALSE)" for c in conds) + " THEN 1 ELSE 0 END"


_TIES = [
    "R_SOCIAL_CONNECTIONS_MARITAL_STATUS IN ('3', '8')",
    "R_SOCIAL_CONNECTIONS_PHONE IN ('4', '5')",
    "R_SOCIAL_CONNECTIONS_GET_TOGETHER IN ('4', '5')",
    "R_SOCIAL_CONNECTIONS_RELIGION = '3'",
    "R_SOCIAL_CONNECTIONS_CLUB_MEMBERSHIP = '1'",
    "R_SOCIAL_CONNECTIONS_CLUB_ATTENDANCE = '3'",
]
_ISO = " + ".join(_any(t) for t in _TIES)
_ISO5 = " + ".join(_any(t) for t in _TIES[:5])
_A1 = "(CAST(R_AUDIT_ALCOHOL_FREQUENCY AS DOUBLE) - 1)"
_A2 = "CASE R_AUDIT_ALCOHOL_STD_DRINKS WHEN '1' THEN 0 ELSE CAST(R_AUDIT_ALCOHOL_STD_DRINKS AS DOUBLE) END"
_A3 = "(CAST(R_AUDIT_ALCOHOL_BINGE AS DOUBLE) - 1)"
_MOVED = "CAST(R_CHILDRENS_HEALTHWATCH_HOUSING_TIMES_MOVED AS INT) >= 2"
_RENT = "R_CHILDRENS_HEALTHWATCH_HOUSING_MORTGAGE = '1'"
_HOMELESS = "R_CHILDRENS_HEALTHWATCH_HOUSING_HOMELESS = '1'"
_MINUTES = """CASE WHEN R_EXERCISE_DAYS_PER_WEEK = '0' THEN 0 ELSE
  CAST(R_EXERCISE_DAYS_PER_WEEK AS DOUBLE) * CAST(R_EXERCISE_MINUTES_PER_DAY AS DOUBLE) * 10 END"""
DOMAINS_CTE = f"""{_WIDE}, points AS (SELECT *, {_ISO} AS iso, {_ISO5} AS iso5, {_MINUTES} AS minutes,
    {_A1} AS a1, COALESCE({_A1}, 0) + COALESCE({_A2}, 0) + COALESCE({_A3}, 0) AS alcohol FROM wide),
  domains AS (SELECT arb_person_id,
    {_any("R_FOOD_INSECURITY_ABILITY_TO_PAY IN ('2', '3')", "R_FOOD_INSECURITY_WORRY IN ('2', '3')")} AS unmet_food,
    {_any("R_TRANSPORTATION_DAILY_LIVING = '1'", "R_TRANSPORTATION_MEDICAL_APPT = '1'")} AS unmet_transp,
    {_any("R_AHC_HRSN_UTILITIES = '1'")} AS unmet_util,
    {_any(_MOVED, _RENT, _HOMELESS)} AS unmet_housing,
    CASE WHEN ({_MOVED} OR {_RENT} OR {_HOMELESS}) AND R_CHILDRENS_HEALTHWATCH_HOUSING_TIMES_MOVED IS NOT NULL
      AND R_CHILDRENS_HEALTHWATCH_HOUSING_MORTGAGE IS NOT NULL
      AND R_CHILDRENS_HEALTHWATCH_HOUSING_HOMELESS IS NOT NULL THEN 1 ELSE 0 END AS unmet_housing_strict,
    {_any("minutes <= 150")} AS less_than_150m_per_wk, minutes,
    iso AS social_iso_score1, iso5 AS social_iso_score2,
    CASE WHEN iso <= 1 THEN 1 ELSE 0 END AS socially_isolated1,
    CASE WHEN iso5 <= 1 THEN 1 ELSE 0 END AS socially_isolated2,
    {_any("R_SOCIAL_CONNECTIONS_GET_TOGETHER IN ('1', '2')", "R_SOCIAL_CONNECTIONS_PHONE IN ('1', '2')",
          "R_SOCIAL_CONNECTIONS_RELIGION = '1'", "R_SOCIAL_CONNECTIONS_CLUB_ATTENDANCE = '1'",
          "R_SOCIAL_CONNECTIONS_CLUB_MEMBERSHIP = '2'",
          "R_SOCIAL_CONNECTIONS_MARITAL_STATUS IN ('4', '6', '7')")} AS any_isolation_sign,
    {_any("R_AUDIT_ALCOHOL_FREQUENCY = '4'", "R_AUDIT_ALCOHOL_STD_DRINKS IN ('2', '3')",
          "R_AUDIT_ALCOHOL_BINGE IN ('2', '4')")} AS any_drinking_sign,
    {_any("R_STRESS_ANXIOUS IN ('4', '5')")} AS osq_pos,
    {_any("R_PAC_B1300 IN ('Often', 'Always')")} AS health_lit_pos,
    alcohol AS audit_score,
    CASE WHEN alcohol < 3 THEN 0 WHEN a1 IS NULL THEN NULL WHEN alcohol = a1 THEN 0 ELSE 1 END AS audit_pos
    FROM points)"""


def person_domains(spark, sf_dir, **options):
    return records.domains(records.person_rows(_intake(spark, sf_dir)), **options)


def _domain_query(name, *cols):
    """Rows per combination of the named results of one domain."""
    cells = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in cols)

    @query(name, f"WITH {DOMAINS_CTE} SELECT {cells}, COUNT(*) AS n FROM domains GROUP BY ALL")
    def run(spark, sf_dir):
        flags = person_domains(spark, sf_dir).withColumnRenamed("minutes_exer_per_wk", "minutes")
        return tally(flags, *[F.col(c).cast("double").alias(c) for c in cols])


_domain_query("unmet_needs", "unmet_food", "unmet_transp", "unmet_util", "unmet_housing")
_domain_query("exercise_flag", "minutes", "less_than_150m_per_wk")
_domain_query(
    "social_isolation", "social_iso_score1", "socially_isolated1", "social_iso_score2",
    "socially_isolated2", "any_isolation_sign",
)
_domain_query("stress_and_literacy", "osq_pos", "health_lit_pos")
_domain_query("alcohol_screen", "audit_score", "audit_pos", "any_drinking_sign")


@query(
    "unmet_housing_complete_answers",
    f"""WITH {DOMAINS_CTE} SELECT unmet_housing_strict AS unmet_housing, COUNT(*) AS n FROM domains
    GROUP BY ALL""",
)
def unmet_housing_complete_answers(spark, sf_dir):
    return tally(person_domains(spark, sf_dir, housing_unknown_hides=True), "unmet_housing")


@query(
    "reverse_scores",
    f"""WITH {cte('staff')} SELECT CAST((irritate - 6) * -1 AS DOUBLE) AS of_five,
      CAST((extra_time - 9) * -1 AS DOUBLE) AS of_eight, COUNT(*) AS n FROM staff GROUP BY ALL""",
)
def reverse_scores(spark, sf_dir):
    return tally(
        view(spark, sf_dir, "staff"),
        recode.reverse_score("irritate", 5).cast("double").alias("of_five"),
        recode.reverse_score("extra_time", 8).cast("double").alias("of_eight"),
    )


def _stigma_item(i):
    return f"(6 - {i})" if i in fixed.STIGMA_REVERSED else i


_STIGMA_SUM = " + ".join(f"COALESCE({_stigma_item(i)}, 0)" for i in fixed.STIGMA_ITEMS)
_STIGMA_MISS = _miss(*fixed.STIGMA_ITEMS)
STIGMA_SQL = (
    f"CASE WHEN ({_STIGMA_MISS}) <= 1 THEN ({_STIGMA_SUM}) / CAST(10 - ({_STIGMA_MISS}) AS DOUBLE) END"
)


@query(
    "attitude_score",
    f"""WITH {cte('staff')} SELECT pcc_or_mdc, ROUND({STIGMA_SQL}, 6) AS stigma,
      CASE WHEN ({_STIGMA_MISS}) = 0 THEN ROUND(({_STIGMA_SUM}) / CAST(10 AS DOUBLE), 6) END AS complete_cases,
      COUNT(*) AS n FROM staff GROUP BY ALL""",
)
def attitude_score(spark, sf_dir):
    scored = scales.add_scores(
        view(spark, sf_dir, "staff"),
        {"stigma": staff.stigma(), "complete_cases": staff.stigma(max_missing=0)},
    )
    return tally(scored, "pcc_or_mdc", *[F.round(c, 6).alias(c) for c in ("stigma", "complete_cases")])


@query(
    "attitude_score_rescaled",
    f"""WITH {cte('staff')} SELECT ROUND(({_STIGMA_SUM}) * CAST(1.32 AS DOUBLE), 4) AS stigma_score,
      COUNT(*) AS n FROM staff GROUP BY ALL""",
)
def attitude_score_rescaled(spark, sf_dir):
    scored = scales.add_scores(view(spark, sf_dir, "staff"), {"stigma_score": staff.stigma_rescaled()})
    return tally(scored, F.round("stigma_score", 4).alias("stigma_score"))


_EXTREME = " OR ".join(
    f"COALESCE({i}, 0) = {5 if i in fixed.STIGMA_REVERSED else 1}" for i in fixed.STIGMA_ITEMS
)


@query(
    "any_extreme_answer",
    f"""WITH {cte('staff')} SELECT site, CASE WHEN {_EXTREME} THEN 1 ELSE 0 END AS extreme,
      COUNT(*) AS n FROM staff GROUP BY ALL""",
)
def any_extreme_answer(spark, sf_dir):
    return tally(view(spark, sf_dir, "staff"), "site", staff.stigma_extreme().alias("extreme"))


@query(
    "climate_score",
    f"""WITH {cte('staff')} SELECT ROUND(({' + '.join(CLIMATE)}) / CAST(6 AS DOUBLE), 6) AS climate,
      COUNT(*) AS n FROM staff GROUP BY ALL""",
)
def climate_score(spark, sf_dir):
    form = view(spark, sf_dir, "staff")
    scored = scales.add_scores(form, {"climate": staff.climate(form.select(*CLIMATE))})
    return tally(scored, F.round("climate", 6).alias("climate"))


def _mean(items):
    return f"ROUND(({' + '.join(items)}) / CAST({len(items)} AS DOUBLE), 6)"


@query(
    "culture_subscales",
    f"""WITH {cte('staff')} SELECT {', '.join(f'{_mean(i)} AS {n}' for n, i in CULTURE.items())},
      {_mean([i for items in CULTURE.values() for i in items])} AS "CultureAvg", COUNT(*) AS n
    FROM staff GROUP BY ALL""",
)
def culture_subscales(spark, sf_dir):
    scored = scales.add_scores(view(spark, sf_dir, "staff"), staff.culture(CULTURE))
    return tally(scored, *[F.round(c, 6).alias(c) for c in (*CULTURE, "CultureAvg")])


@query(
    "row_sums_and_means",
    f"""WITH {cte('staff')} SELECT CAST(prefer_not + irritate AS DOUBLE) AS strict_sum,
      COALESCE(prefer_not, 0) + COALESCE(irritate, 0) AS open_sum,
      CASE WHEN prefer_not IS NULL AND irritate IS NULL THEN NULL
        ELSE (COALESCE(prefer_not, 0) + COALESCE(irritate, 0)) /
          CAST((prefer_not IS NOT NULL)::INT + (irritate IS NOT NULL)::INT AS DOUBLE) END AS open_mean,
      COUNT(*) AS n FROM staff GROUP BY ALL""",
)
def row_sums_and_means(spark, sf_dir):
    pair = ["prefer_not", "irritate"]
    return tally(
        view(spark, sf_dir, "staff"),
        nulls.row_sum(pair).cast("double").alias("strict_sum"),
        nulls.row_sum(pair, skip_missing=True).alias("open_sum"),
        nulls.row_mean(pair).alias("open_mean"),
    )
