"""The three survey flows end to end on invented records."""

import pytest
from pyspark.sql import functions as F

from sondage import fixed_values as fixed
from sondage.operators.cohort import CheckFailed, require_none
from sondage.plans import accrual, patient, records, report
from tests.conftest import rows

T1, T2, T3, T5 = (list(fixed.TIMEPOINTS)[i] for i in (0, 1, 2, 4))
PRE, SCREEN = fixed.PRE_ENROLMENT, fixed.SCREENING
YES = dict.fromkeys(fixed.SYMPTOM_WEIGHTS, "Yes")
NO = dict.fromkeys(fixed.SYMPTOM_WEIGHTS, "No")
HEALTH = {
    **{f"promis_global0{i}": "3 - Good" for i in range(1, 8)},
    "avg_pain": "0 No pain", "avg_fatigue": "Mild", "bothered": "Never",
}


def survey_rows():
    done = {"pasc_symptoms_and_followup_questions_complete": "Complete"}
    return [
        {"record_id": 1, "redcap_event_name": PRE, "name": "Ann", "mdc_name": None},
        {"record_id": 1, "redcap_event_name": SCREEN, "enrollstatus": "Enrollment completed",
         "pcc_or_mdc": "MDC", "mdc_name": "North"},
        {"record_id": 1, "redcap_event_name": T1, **done, "patient_age": 40, "patient_gender": "Female",
         "patient_race___1": 1, "patient_race___5": 1, "ps_ptpasc": "Yes", **YES, **HEALTH,
         "lcdiagnosis": "Yes", "conditions___1": "Checked", "mdc_appts": "Yes", "serious_mdc": "Never",
         "consequences_mdc": "Often", "living_sit": 2, "food_worry": 3, "food_last": 1, "transport": 1,
         "utlities": 3, "fin_strain": 1, "help_daytoday": 1, "lonely": 5,
         **{f"living_probs___{i}": 0 for i in range(1, 9)}},
        {"record_id": 1, "redcap_event_name": T2, "pasc_symptoms_only_t2_t4_complete": "Complete",
         "ps2_ptpasc": "Yes", **{n.replace("ps_", "ps2_"): "No" for n in YES}},
        {"record_id": 1, "redcap_event_name": T5, "conditions_t5___1": "Unchecked", "mdc_appts_t5": "Yes",
         "serious_mdc_t5": "Often", "consequences_mdc_t5": "Often", "talk_mdc_t5": "Rarely"},
        {"record_id": 2, "redcap_event_name": SCREEN, "name": "Test person"},
        {"record_id": 2, "redcap_event_name": T1},
        {"record_id": 3, "redcap_event_name": SCREEN, "enrollstatus": "Duplicate record"},
        {"record_id": 4, "redcap_event_name": SCREEN, "enrollstatus": "Enrollment completed",
         "not_enrolled_status": "left study (moved away)", "pcc_or_mdc": "PCC", "pcc_name": "Hill"},
        {"record_id": 4, "redcap_event_name": T1, **done, "patient_age": 70, "patient_ethn": "Hispanic or Latino",
         "patient_race___5": 1, "ps_ptpasc": "No", **NO},
        {"record_id": 4, "redcap_event_name": T3, "pasc_symptoms_only_t2_t4_complete": "Incomplete"},
        {"record_id": 5, "redcap_event_name": SCREEN, "enrollstatus": "patient declined"},
    ]


def all_columns():
    text, number = set(), {"record_id", "patient_age"}
    text |= {"redcap_event_name", "name", "anythingelse", "study_label", "not_enrolled_status",
             "enrollstatus", "pcc_or_mdc", "mdc_name", "pcc_name", "patient_gender", "patient_ethn",
             "pasc_symptoms_and_followup_questions_complete", "pasc_symptoms_only_t2_t4_complete",
             "pasc_symptoms_and_followup_questions_t5_complete", "ps_ptpasc", "ps2_ptpasc", "ps_ptpasc_t5",
             "lcdiagnosis", "lcdiagnosis_t5", "conditions___1", "conditions_t5___1", "pcc_appts", "mdc_appts",
             "pcc_appts_t5", "mdc_appts_t5"}
    for s in patient.GLOBAL_HEALTH_SOURCES.values():
        text |= {s, f"{s}_v2", f"{s}_t5"}
    for n in fixed.SYMPTOM_WEIGHTS:
        text |= {n, n.replace("ps_", "ps2_"), f"{n}_t5"}
    for i in patient.UNDERSTANDING_ITEMS:
        text |= {f"{i}_{s}{x}" for s in ("pcc", "mdc") for x in ("", "_t5")}
    number |= set(fixed.RACES) | {f"living_probs___{i}" for i in range(1, 9)}
    number |= {"living_sit", "food_worry", "food_last", "transport", "utlities", "fin_strain",
               "help_daytoday", "lonely"}
    return sorted(text), sorted(number)


@pytest.fixture(scope="module")
def prepared(spark):
    text, number = all_columns()
    schema = ", ".join([f"{c} string" for c in text] + [f"{c} int" for c in number])
    data = [tuple(r.get(c) for c in text + number) for r in survey_rows()]
    survey = spark.createDataFrame(data, schema)
    table = spark.createDataFrame(
        [(s, float(s) + 0.5, 1.0) for s in range(4, 21)], "`Raw Summed Score` int, `T-Score` double, SE double"
    )
    return patient.prepare(survey, table, table).cache()


def one(df, record, event):
    return df.where((F.col("record_id") == record) & (F.col("redcap_event_name") == event)).first()


def test_test_and_duplicate_records_are_gone(prepared):
    assert rows(prepared.select("record_id").distinct()) == [(1,), (4,), (5,)]


def test_no_row_is_lost_or_doubled(prepared):
    assert prepared.count() == 9


def test_status_and_site(prepared):
    got = {(r["record_id"], r["site_type"], r["site_name"]) for r in prepared.collect()}
    assert got == {(1, "MDC", "North"), (4, "PCC", "Hill"), (5, "Unknown", "Unknown")}
    left = one(prepared, 4, SCREEN)
    assert (left["enrollstatus"], left["ltfu"], left["ltfu_surv"]) == ("Enrollment completed", 1, T1)
    assert one(prepared, 5, SCREEN)["enrollstatus"] == "Declined"
    assert one(prepared, 1, PRE)["ltfu"] == 0


def test_demographics(prepared):
    first, second = one(prepared, 1, T1), one(prepared, 4, T1)
    assert (first["age_group"], second["age_group"]) == ("35-64", "65+")
    assert second["race"] == "Hispanic or Latino"
    # Only two flags are known, so the number of races is not.
    assert first["mt1_race"] is None and first["race"] is None


def test_clinical_columns_follow_the_visit(prepared):
    assert one(prepared, 1, T1)["conditions___1"] == 1
    assert one(prepared, 1, T5)["conditions___1"] == 0
    assert one(prepared, 1, T1)["lcdiagnosis"] == 1
    assert "conditions_t5___1" not in prepared.columns


def test_scores(prepared):
    first = one(prepared, 1, T1)
    assert (first["pasc_score"], first["pasc_positive"]) == (sum(fixed.SYMPTOM_WEIGHTS.values()), 1)
    assert (one(prepared, 1, T2)["pasc_score"], one(prepared, 1, T2)["pasc_positive"]) == (0, 0)
    assert one(prepared, 4, T1)["pasc_score"] is None
    # Pain 5, two items of 3, fatigue 4; three items of 3 and bothered 5.
    assert (first["promis_global_phys"], first["promis_pht"]) == (15, 15.5)
    assert (first["promis_global_ment"], first["promis_mht"]) == (14, 14.5)
    assert first["promis_1"] == "Good"
    assert (first["lou_score_mdc"], first["lou_score_pcc"]) == (2.5, None)
    assert one(prepared, 1, T5)["lou_score_mdc"] == pytest.approx(10 / 3)


def test_social_needs(prepared):
    first = one(prepared, 1, T1)
    assert [first[n] for n in patient.NEEDS] == [1, 1, 1, 0, 1, 1]
    assert first["hrsn_need_score"] == 5
    blank = one(prepared, 4, T1)
    assert [blank[n] for n in patient.NEEDS] == [None, 0, None, 0, 0, None]
    assert blank["hrsn_need_score"] == 0


def test_enrolment_check(prepared):
    require_none(patient.enrolment_violations(prepared), "first visit")
    broken = prepared.withColumn("pasc_symptoms_and_followup_questions_complete", F.lit("Incomplete"))
    with pytest.raises(CheckFailed):
        require_none(patient.enrolment_violations(broken), "first visit")


def test_understanding_long(prepared):
    assert rows(patient.understanding_long(prepared)) == [(1, "lou_score_mdc", 2.5)]


def test_severity_means(frame):
    raw = frame("ps_cough_burden int, ps_cough_sevdepaul int, ps_headache_freq int", (3, -88, 0), (5, 2, None))
    assert rows(patient.severity_means(raw)) == [
        ("ps_cough", "burden", 4.0), ("ps_cough", "sevdepaul", 3.0), ("ps_headache", "freqdepaul", 1.0),
    ]


def accrual_frame(spark):
    cols = ("record_id", "redcap_event_name", "enrollstatus", "patient_consent_form_complete",
            "healthrelated_social_needs_complete", "experiences_with_care_complete", "participatingclinic",
            "pcc_or_mdc_name", "healthrelated_social_needs_timestamp", "patient_consent_form_timestamp",
            "experiences_with_care_timestamp", "pasc_symptoms_and_followup_questions_complete", "site_type",
            "consent_name", "name", "site_name")
    data = [
        {"record_id": 1, "redcap_event_name": SCREEN, "enrollstatus": "Enrollment completed"},
        {"record_id": 1, "redcap_event_name": T1, "patient_consent_form_complete": "Complete",
         "healthrelated_social_needs_complete": "Complete", "consent_name": "A",
         "healthrelated_social_needs_timestamp": "2026-01-01 10:00:00",
         "patient_consent_form_timestamp": "2026-01-01 09:00:00"},
        {"record_id": 1, "redcap_event_name": T2, "experiences_with_care_complete": "Incomplete",
         "experiences_with_care_timestamp": "2026-04-05 09:00:00"},
        {"record_id": 2, "redcap_event_name": T1, "patient_consent_form_complete": "Complete",
         "healthrelated_social_needs_complete": "Complete",
         "healthrelated_social_needs_timestamp": "2026-01-01 10:00:00",
         "pasc_symptoms_and_followup_questions_complete": "Incomplete"},
        {"record_id": 3, "redcap_event_name": SCREEN},
    ]
    schema = "record_id int, " + ", ".join(f"{c} string" for c in cols[1:])
    df = spark.createDataFrame([tuple(r.get(c) for c in cols) for r in data], schema)
    stamps = [c for c in cols if c.endswith("timestamp")]
    df = df.withColumns({c: F.col(c).cast("timestamp") for c in stamps})
    return patient.add_timepoint(df.withColumn("site_type", F.coalesce("site_type", F.lit("PCC"))))


def test_accrual(spark):
    df = accrual_frame(spark)
    table = accrual.record_table(df)
    assert rows(table, "record_id", "enrollstatus", "patient_consent_form_complete") == [
        (1, "Enrollment completed", "Complete"), (2, "TBD", "Complete"), (3, "TBD", "Incomplete"),
    ]
    ids = accrual.consented(table)
    # 104 days after the first visit.
    states = accrual.visit_states(df, ids, "2026-04-15")
    got = {r["record_id"]: r for r in states.collect()}
    assert set(got) == {1, 2}
    assert (got[1]["days_since_t1"], got[1]["t1_status"]) == (104, "Complete")
    assert (got[1]["t2_status"], got[1]["t3_status"]) == ("Incomplete (past window)", "Not due for T3")
    assert got[2]["t2_status"] == got[2]["t5_status"] == "Incomplete T1 PASC"
    dates = {r["record_id"]: r for r in accrual.visit_dates(df, ids).collect()}
    assert (dates[1]["days_to_t2"], dates[2]["days_to_t2"]) == (94, None)
    assert rows(accrual.presence(df, [SCREEN, T1]), SCREEN, T1) == [(0, 1), (1, 0), (1, 1)]
    assert rows(accrual.consent_violations(df), "record_id") == [(2,)]
    assert accrual.capped(df, "2026-01-01").select("record_id").distinct().count() == 1


def test_intake_flow(frame):
    answers = frame(
        "arb_person_id string, flowsheet_row_name string, VALUE string, observation_date string",
        ("p", "R FOOD INSECURITY WORRY", "2", "01/02/2025"), ("p", "R EXERCISE DAYS PER WEEK", "0", "01/02/2025"),
        ("p", "R CHILDREN'S HEALTHWATCH HOUSING HOMELESS", "1", "01/02/2025"),
        ("p", "R STRESS ANXIOUS", "2", "12/31/2024"), ("p", "R STRESS ANXIOUS", "5", "01/02/2025"),
        ("q", "R SOCIAL CONNECTIONS MARITAL STATUS", "8", "01/02/2025"),
        ("q", "R SOCIAL CONNECTIONS PHONE", "5", "01/02/2025"),
        ("q", "R PAC B1300", "Always", "01/02/2025"),
    )
    people = frame("Pt_MDC string, Pt_Age string, Pt_Insurance_type string, Pt_Sex string",
                   ("p", "31 to 35", "CIGNA", "female"), ("q", "71 to 75", "OTHER", "male"),
                   ("z", "21 to 25", "CIGNA", "male"))
    flags = records.domains(records.person_rows(answers))
    joined = records.with_people(flags, people)
    got = {r["arb_person_id"]: r for r in joined.collect()}
    assert set(got) == {"p", "q"}
    p, q = got["p"], got["q"]
    assert [p[d] for d in records.DOMAINS] == [1, 1, 0, 0, 1, 0, 1, 1, 0]
    assert [q[d] for d in records.DOMAINS] == [0, 0, 0, 0, 0, 1, 0, 0, 0]
    assert (p["Pt_Age"], q["Pt_Age"], p["Pt_Insurance_type"], q["Pt_Insurance_type"]) == (
        "21 to 40", "61 to 85", "Commercial", None,
    )
    strict = records.domains(records.person_rows(answers), housing_unknown_hides=True)
    assert rows(strict, "arb_person_id", "unmet_housing") == [("p", 0), ("q", 0)]
    table = records.domain_table(joined, "Pt_Sex")
    row = table.where("variable = 'unmet_food' and group = 'Overall'").first()
    assert (row["n"], row["total"], row["test"], row["p_value"]) == (1, 2, "fisher", pytest.approx(1.0))


def test_report_rules(frame):
    data = [("n", "PCC", T1, 1, "x", 1.0)] * 5 + [("s", "MDC", T1, 1, "y", 2.0)] * 4 + [
        ("s", "MDC", T2, 2, "y", 3.0), ("s", "MDC", T1, 1, "x", 2.5), ("n", "PCC", T1, 1, "y", 1.5),
    ]
    df = frame("site_name string, site_type string, redcap_event_name string, timepoint int, v string,"
               " w double", *data)
    spec = report.Report(categorical=["v"], continuous=["w"], levels=["MDC", "PCC"])
    by_clinic = report.run(df, spec, "by_clinic")
    assert {r["group"] for r in by_clinic.collect()} == {"n", "s", "Overall"}
    fewer = report.run(df.where("w < 2.5"), spec, "by_clinic")
    assert {r["group"] for r in fewer.collect()} == {"n", "Overall"}
    by_type = report.run(df, spec, "by_site_type").collect()
    assert {(r["variable"], r["test"]) for r in by_type} == {("v", "fisher"), ("w", "t-test")}
    assert all(r["p_value"] is not None for r in by_type)
    by_visit = report.run(df, spec, "by_timepoint").collect()
    assert {r["group"] for r in by_visit} == {T1, T2, "Overall"}
    assert all(r["p_value"] is None for r in by_visit)
