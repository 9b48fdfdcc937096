"""Missing-value rules and recodes on rows that are all, partly and not missing."""

import pytest
from pyspark.sql import functions as F

from sondage import fixed_values as fixed
from sondage.functions import nulls, recode
from tests.conftest import rows


def values(df, col):
    return [r[0] for r in df.select(col).collect()]


@pytest.fixture
def answers(frame):
    return frame("i int, a int, b int, s string", (1, 1, 2, "Yes"), (2, None, 2, "no test"),
                 (3, None, None, None))


def test_choice_stays_missing(answers):
    assert values(answers, nulls.if_else(F.col("a") == 1, "y", "n")) == ["y", None, None]


def test_membership_of_missing_is_false(answers):
    assert values(answers, nulls.is_in("a", [1])) == [True, False, False]
    assert values(answers, nulls.not_in("a", [1])) == [False, True, True]


def test_two_kinds_of_pattern_tests(answers):
    assert values(answers, nulls.matches("s", "TEST", ignore_case=True)) == [False, True, False]
    assert values(answers, nulls.detects("s", "Yes")) == [True, False, None]


def test_row_sum_and_mean(answers):
    assert values(answers, nulls.row_sum(["a", "b"])) == [3, None, None]
    assert values(answers, nulls.row_sum(["a", "b"], skip_missing=True)) == [3, 2, 0]
    assert values(answers, nulls.row_mean(["a", "b"])) == [1.5, 2.0, None]
    assert values(answers, nulls.row_mean(["a", "b"], max_missing=0)) == [1.5, None, None]
    assert values(answers, nulls.missing_count(["a", "b"])) == [0, 1, 2]


def test_strict_aggregate(answers):
    got = answers.agg(
        nulls.strict(F.sum("a"), "a").alias("a"), nulls.strict(F.sum("i"), "i").alias("i")
    ).first()
    assert (got["a"], got["i"]) == (None, 6)


def test_half_even(frame):
    df = frame("x double", (0.5,), (1.5,), (2.5,))
    assert values(df, nulls.half_even(F.col("x"))) == [0.0, 2.0, 2.0]


def test_value_map_with_sets_and_default(frame):
    df = frame("s string", ("0 No pain",), ("2",), ("9",), ("other",), (None,))
    assert values(df, recode.value_map("s", fixed.PAIN_SCORES)) == [5, 4, 2, None, None]
    assert values(df, recode.value_map("s", {"2": "two"}, recode.KEEP)) == [
        "0 No pain", "two", "9", "other", None,
    ]


def test_age_bands_are_left_closed(frame):
    df = frame("x int", (17,), (18,), (34,), (35,), (64,), (65,), (None,))
    assert values(df, recode.band("x", fixed.AGE_BANDS)) == [
        None, "18-34", "18-34", "35-64", "35-64", "65+", None,
    ]


def test_experience_bands_are_right_closed(frame):
    df = frame("x double", (0.0,), (1.0,), (1.1,), (5.0,), (10.0,), (10.5,), (None,))
    cut = recode.cut_right("x", fixed.EXPERIENCE_BREAKS, fixed.EXPERIENCE_LABELS)
    assert values(df, cut) == ["<=1", "<=1", "2-5", "2-5", "6-10", ">10", None]


def test_set_band(frame):
    df = frame("s string", ("CIGNA",), ("UNITED MEDICARE",), ("X",), (None,))
    assert values(df, recode.set_band("s", fixed.PAYER_GROUPS)) == ["Commercial", "Medicare", None, None]


def test_text_clean_up(frame):
    df = frame("s string", ("left study (moved)",), ("3 - Good-ish",), (None,))
    assert values(df, recode.drop_parenthesis("s")) == ["left study", "3 - Good-ish", None]
    assert values(df, recode.after_dash("s")) == ["left study (moved)", "Good-ish", None]
    assert values(df, recode.leading_number("s")) == [None, 3, None]


def test_status_rules_apply_in_order(frame):
    df = frame("s string", ("never answered",), ("not eligible",), ("Enrollment completed",), (None,))
    assert values(df, recode.first_match("s", fixed.STATUS_RULES)) == [
        "No response", "Not eligible", "Enrollment completed", None,
    ]


def test_race(frame):
    flags = {"a": "A", "b": "B"}
    df = frame("a int, b int, e string", (1, 0, "no"), (1, 1, "no"), (0, 1, "hisp"), (0, 1, None),
               (0, 0, "no"))
    one = recode.first_checked(flags, several="More")
    keep = recode.override(one, F.col("e") == "hisp", "H")
    drop = recode.override(one, F.col("e") == "hisp", "H", keep_when_unknown=False)
    assert values(df, keep) == ["A", "More", "H", "B", None]
    assert values(df, drop) == ["A", "More", "H", None, None]


def test_codes_and_reversal(frame):
    df = frame("x int", (-88,), (1,), (None,))
    assert values(df, recode.without_code("x")) == [None, 1, None]
    assert values(df, recode.reverse_score("x", 5)) == [94, 5, None]
    assert rows(df.select(recode.name_missing("x").alias("x"))) == [("-88",), ("1",), ("Unknown",)]
