"""Scales with all, one and no items missing; summary tables and their denominators."""

import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from sondage import fixed_values as fixed
from sondage.functions.style import count_percent, percent_text
from sondage.operators import scales, summary
from sondage.operators.scales import Scale
from sondage.plans import staff
from tests.conftest import rows


def values(df, col):
    return [r[0] for r in df.select(col).collect()]


@pytest.fixture
def items(frame):
    return frame("a int, b int, c int, g string", (1, 2, 3, "Yes"), (5, None, 4, "Yes"),
                 (None, None, 2, "Yes"), (None, None, None, "Yes"), (1, 1, 1, "No"), (1, 1, 1, None))


def test_mean_scale_missing_rule(items):
    got = values(items, Scale(["a", "b", "c"], "mean", max_missing=1).score())
    assert got == [2.0, 4.5, None, None, 1.0, 1.0]


def test_complete_cases_only(items):
    assert values(items, Scale(["a", "b", "c"]).score()) == [2.0, None, None, None, 1.0, 1.0]


def test_gate_open_or_failed_gives_no_score(items):
    got = values(items, Scale(["a", "b", "c"], "mean", max_missing=3, gate="g = 'Yes'").score())
    assert got == [2.0, 4.5, 2.0, None, None, None]


def test_reversed_weighted_sum_and_cutoff(items):
    scale = Scale(["a", "b"], "sum", reversed=["b"], weights={"a": 10}, cutoff=12)
    df = scales.add_scores(items, {"s": scale})
    assert values(df, "s") == [14, None, None, None, 15, 15]
    assert values(df, "s_positive") == [1, None, None, None, 1, 1]


def test_open_sum_of_all_missing_is_zero(items):
    assert values(items, Scale(["a", "b", "c"], "sum", max_missing=None).score())[3] == 0


def test_stigma_versions(frame):
    cols = ", ".join(f"{i} int" for i in fixed.STIGMA_ITEMS)
    best = [1 if i in fixed.STIGMA_REVERSED else 5 for i in fixed.STIGMA_ITEMS]
    one_gone, two_gone = [None, *best[1:]], [None, None, *best[2:]]
    worst = [6 - v for v in best]
    df = frame(cols, best, one_gone, two_gone, worst, [None] * 10)
    assert values(df, staff.stigma().score()) == [5.0, 5.0, None, 1.0, None]
    assert values(df, staff.stigma(0).score()) == [5.0, None, None, 1.0, None]
    assert values(df, staff.stigma_rescaled().score()) == pytest.approx([66.0, 59.4, 52.8, 13.2, 0.0])
    assert values(df, staff.stigma_extreme()) == [0, 0, 0, 1, 0]


def test_alcohol_screen(frame):
    df = frame("f string, d string, b string", ("5", "1", "1"), ("5", "3", "1"), ("1", "2", "3"),
               (None, "3", "2"), (None, "1", "2"), ("2", None, None))
    got = df.select(*[c.alias(n) for n, c in scales.screen_alcohol("f", "d", "b").items()]).collect()
    assert [(r[0], r[1]) for r in got] == [(4, 0), (7, 1), (4, 1), (4, None), (1, 0), (1, 0)]


def test_exercise_and_isolation(frame):
    df = frame("d string, m string", ("0", None), ("3", "5"), ("3", "6"), (None, "5"))
    minutes = scales.exercise_minutes("d", "m")
    assert values(df, minutes) == [0.0, 150.0, 180.0, None]
    assert values(df, scales.any_need(minutes <= 150)) == [1, 1, 0, 0]
    ties = scales.isolation_points([F.col("d") == "3", F.col("m") == "5"])
    assert values(df, ties) == [0, 2, 1, 1]


def test_any_need_with_open_answers(frame):
    df = frame("a boolean, b boolean", (True, None), (False, None), (True, False), (None, None))
    assert values(df, scales.any_need(F.col("a"), F.col("b"))) == [1, 0, 1, 0]
    assert values(df, scales.any_need(F.col("a"), F.col("b"), unknown_hides=True)) == [0, 0, 1, 0]


def test_look_up_keeps_rows_without_entry(frame):
    df = frame("s int", (4,), (99,), (None,))
    table = frame("`Raw Summed Score` int, `T-Score` double", (4, 16.2), (4, 16.2))
    out = scales.look_up(df, table, "s", "Raw Summed Score", "T-Score", "t")
    assert rows(out) == [(4, 16.2), (99, None), (None, None)]


@pytest.fixture
def people(frame):
    return frame("g string, v string, w int", ("a", "x", 1), ("a", "y", 0), ("a", None, None),
                 ("b", "x", 1), (None, "x", 0))


def test_categorical_percentages_leave_out_missing(people):
    out = summary.categorical(people, ["v"], by="g", missing_group="Unknown")
    got = {(r["group"], r["level"]): (r["n"], r["total"], r["percent"]) for r in out.collect()}
    assert got[("a", "x")] == (1, 2, 50.0)
    assert got[("a", None)] == (1, 2, None)
    assert got[("Unknown", "x")] == (1, 1, 100.0)
    assert got[("Overall", "x")] == (3, 4, 75.0)


def test_overall_is_the_sum_of_groups(people):
    out = summary.categorical(people, ["v", "w"], by="g").collect()
    for key in {(r["variable"], r["level"]) for r in out}:
        parts = [r["n"] for r in out if (r["variable"], r["level"]) == key and r["group"] != "Overall"]
        whole = [r["n"] for r in out if (r["variable"], r["level"]) == key and r["group"] == "Overall"]
        assert whole == [sum(parts)]


def test_dichotomous_keeps_empty_groups(people):
    want = [("Overall", 2, 4), ("Unknown", 0, 1), ("a", 1, 2), ("b", 1, 1)]
    got = summary.dichotomous(people, {"w": 1}, by="g", missing_group="Unknown")
    assert rows(got, "group", "n", "total") == want
    got = summary.categorical(
        people, ["w"], by="g", missing_group="Unknown", missing="no", values={"w": 1}
    )
    assert rows(got, "group", "n", "total") == want


def test_rows_without_a_group_are_left_out(people):
    out = summary.categorical(people, ["v"], by="g")
    got = {(r["group"], r["level"]): (r["n"], r["total"]) for r in out.collect()}
    assert got[("Overall", "x")] == (2, 3)
    assert ("Unknown", "x") not in got


def test_continuous_of_single_and_empty_groups(frame):
    df = frame("g string, v double", ("a", 1.0), ("a", 2.0), ("a", 4.0), ("b", 7.0), ("c", None))
    got = {r["group"]: r for r in summary.continuous(df, ["v"], by="g").collect()}
    assert (got["a"]["median"], got["a"]["n"]) == (2.0, 3)
    assert (got["b"]["sd"], got["b"]["p25"]) == (None, 7.0)
    assert (got["c"]["n"], got["c"]["n_missing"], got["c"]["mean"]) == (0, 1, None)
    text = summary.continuous(df, ["v"], template="{mean} ({sd}); {median} ({p25}, {p75})").first()
    assert text["stat"] == "3.5 (2.6); 3.0 (1.5, 5.5)"


def test_means_that_end_in_five_behind_the_digits_round_up(frame):
    """Means of 32 prices end in 5 at the seventh digit: sums in floating point round some of them down."""
    rng = random.Random(4)
    cents = {f"g{k}": [rng.randrange(10**5, 5 * 10**7) for _ in range(32)] for k in range(60)}
    for all_of in cents.values():
        all_of[0] += 1 - sum(all_of) % 2
    df = frame("g string, v double", *[(g, c / 100) for g, all_of in cents.items() for c in all_of])
    want = {}
    for g, all_of in cents.items():
        millionths = int(Fraction(sum(all_of) * 10**4, 32) + Fraction(1, 2))
        want[g] = f"{millionths // 10**6:,}.{millionths % 10**6:06d}"
    for shape in (df.coalesce(1), df.repartition(5)):
        out = summary.continuous(shape, ["v"], by="g", template="{mean}", digits=6)
        got = {r["group"]: r["stat"] for r in out.collect()}
        assert {g: t for g, t in got.items() if g != "Overall"} == want


def test_moments_of_values_that_are_no_short_decimals(frame):
    """Values with more digits, huge ones, and none that is a number, keep floating point; equal values have sd 0."""
    third, nan = 1 / 3, float("nan")
    df = frame(
        "g string, v double", ("a", third), ("a", third), ("b", 1e30), ("b", 1e30), ("c", nan), ("c", 1.0),
        ("d", 0.1), ("d", 0.1), ("d", 0.1), ("e", 1e-9), ("e", 3e-9), ("f", 9e11), ("f", -9e11), ("g", -0.0),
    )
    got = {r["group"]: (r["mean"], r["sd"]) for r in summary.continuous(df, ["v"], by="g", overall=False).collect()}
    assert got["a"] == (third, 0.0) and got["b"] == (1e30, 0.0)
    assert all(x != x for x in got["c"])
    assert got["d"] == (0.1, 0.0) and got["e"] == pytest.approx((2e-9, 2e-9 / 2**0.5))
    assert got["f"] == (0.0, 9e11 * 2**0.5) and got["g"] == (0.0, None)


def test_percent_text(frame):
    df = frame("n long, t long", (1, 8), (1, 80), (1, 1500), (0, 5), (5, 5), (1, 200), (0, 0), (995, 10000))
    got = values(df, percent_text(F.col("n"), F.col("t")))
    assert got == ["13", "1.3", "<0.1", "0", "100", "0.5", "NA", "10"]
    assert values(frame("n long, t long", (1234, 4000)), count_percent(F.col("n"), F.col("t"))) == [
        "1,234 (31%)"
    ]


def test_likert_grid_and_answers_outside_levels(frame):
    df = frame("a string, b string", ("1", "2"), ("2", None), ("odd", "2"))
    out = summary.likert(df, ["a", "b"], ["1", "2", "Unknown"])
    assert rows(out, "item", "n", "n_1", "n_2", "n_3") == [("a", 2, 1, 1, 0), ("b", 3, 0, 2, 1)]


def test_endorsement_uses_branch_denominator(frame):
    df = frame("a int, b int, s string", (1, 1, "F"), (0, None, "M"), (1, 0, None))
    out = summary.endorsement(df, ["a", "b"], {"b": ~F.coalesce(F.col("s") == "M", F.lit(False))})
    assert rows(out, "item", "n", "total") == [("a", 2, 3), ("b", 1, 2)]


def test_side_by_side(people):
    out = summary.categorical(people, ["v"], by="g")
    wide = summary.side_by_side(out, ["a", "b"], ["variable", "level"])
    assert rows(wide) == [("v", "x", "1 (50%)", "1 (100%)"), ("v", "y", "1 (50%)", "0 (0%)"),
                          ("v", None, "1", "0 (0%)")]


def test_frequency_drops_missing_text(frame):
    df = frame("t string, k int", ("a", 1), ("a", 1), (None, 1), ("b", 2))
    assert rows(summary.frequency(df, "t", F.col("k") == 1), "level", "n", "total") == [("a", 2, 2)]


def test_strict_group_means(frame):
    df = frame("g string, v double", ("a", 1.0), ("a", 3.0), ("b", 1.0), ("b", None))
    got = {r["g"]: r for r in summary.group_means(df, ["g"], ["v"]).collect()}
    assert (got["a"]["mean_v"], got["a"]["se_v"]) == (2.0, pytest.approx(1.0))
    assert (got["b"]["mean_v"], got["b"]["n"]) == (None, 2)
