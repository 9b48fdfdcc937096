"""Staff survey: rates, cohort, recodes and scales."""

import pytest

from sondage.operators.scales import add_scores
from sondage.operators.summary import collapsed, group_sizes
from sondage.plans import patient, staff
from sondage import fixed_values as fixed
from sondage.session import shared_folder
from tests.conftest import rows


@pytest.fixture
def forms(frame):
    return frame(
        "r int, consent_name string, employee_survey_t1_complete string, pcc_or_mdc string, experience double,"
        " practice_role_pcc string, practice_role_mdc string, expect_certain_number int, mid int, appreciation int",
        (1, "a", "Complete", "practice", 1.0, "Physician", None, 1, 2, 3),
        (2, "b", "Incomplete", "clinic", 7.0, None, "Resident physician/Fellow", 5, None, 5),
        (3, None, "Complete", "practice", None, "Other", None, 4, 4, 4),
        (4, "d", "Complete", "elsewhere", 12.0, None, None, None, None, None),
    )


def test_rates_are_nested(forms):
    got = staff.rates(forms).first()
    assert (got["n_records"], got["n_consented"], got["n_completed"]) == (4, 3, 2)
    assert got["rate_consented"] == 0.75
    assert got["rate_completed"] == pytest.approx(2 / 3)


def test_completed_cohort_and_roles(forms):
    assert rows(staff.completed(forms), "r") == [(1,), (4,)]
    assert rows(forms.where(staff.prescribers()), "r") == [(1,), (2,)]


def test_recode(forms):
    got = rows(staff.recode(forms), "r", "pcc_or_mdc", "experience_cat")
    assert got == [(1, "PCC", "<=1"), (2, "MDC", "6-10"), (3, "PCC", None), (4, None, ">10")]


def test_climate_needs_complete_answers(forms):
    scored = add_scores(forms, {"climate": staff.climate(forms)})
    assert rows(scored, "r", "climate") == [(1, 2.0), (2, None), (3, 4.0), (4, None)]
    assert scored.columns == [*forms.columns, "climate"]


def test_culture_subscales(frame):
    df = frame("a int, b int, c int", (1, 3, 5), (2, None, 4))
    scales = staff.culture({"first": ["a", "b"], "second": ["c"]}, reversed=["c"])
    got = rows(add_scores(df, scales), *scales)
    assert got == [(2.0, 1.0, pytest.approx(5 / 3)), (None, 2.0, None)]


def test_collapsed_percentages_are_of_the_group(frame):
    df = frame("g string, q string", ("P", "SD (1)"), ("P", "D (2)"), ("P", None), ("M", "A (4)"))
    out = collapsed(df, ["q"], fixed.AGREEMENT_GROUPS, "g", positive=["q"])
    got = {(r["g"], r["response"]): (r["n"], r["total"], r["valence"]) for r in out.collect()}
    assert got == {("P", "Disagree"): (2, 3, "positive"), ("P", "Unknown"): (1, 3, "positive"),
                   ("M", "Agree"): (1, 1, "positive")}


def test_group_headers(frame):
    df = frame("g string", ("a",), ("a",), (None,))
    assert rows(group_sizes(df, "g"), "header") == [("Overall, N = 2",), ("a, N = 2",)]
    assert rows(group_sizes(df, "g", missing_group="?"), "n") == [(1,), (2,), (3,)]


def test_other_texts_only_of_ticked_boxes(frame):
    cols = ", ".join(f"{t} string, {b} int" for t, b in patient.OTHER_TEXTS.items())
    df = frame(cols, ("asthma", 1, None, 0, None, None), ("lost", 0, "x", 1, "y", None))
    assert rows(patient.other_texts(df), "variable", "level", "n", "total") == [
        ("conditions_other", "asthma", 1, 1), ("other_med", "x", 1, 1),
    ]


def test_local_runs_keep_one_folder(spark):
    assert shared_folder(spark) == shared_folder(spark)
