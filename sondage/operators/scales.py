"""Questionnaire scores from declarative scale definitions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import as_col, missing_count, quoted, row_mean, row_sum
from ..functions.recode import flag, reverse_score, value_map


@dataclass(frozen=True)
class Scale:
    """How a score comes from its items.

    items:       columns of the scale
    how:         "sum" or "mean"
    answers:     answer -> number, for items held as text
    reversed:    items mirrored on a 1..top range
    weights:     factor per item, 1 where absent
    max_missing: most unanswered items a score may have; ``None`` scores any
                 number, as the sum (or mean) of what was answered
    cutoff:      score from which ``positive`` is 1
    gate:        SQL condition; rows that fail it or leave it open get no score
    factor:      constant the score is multiplied with
    """

    items: Sequence[str]
    how: str = "mean"
    answers: Mapping | None = None
    reversed: Sequence[str] = ()
    top: int = 5
    weights: Mapping[str, float] = field(default_factory=dict)
    max_missing: int | None = 0
    cutoff: float | None = None
    gate: str | None = None
    factor: float = 1.0

    def item(self, name: str) -> Column:
        col = as_col(name)
        if self.answers is not None:
            col = value_map(col, self.answers)
        if name in self.reversed:
            col = reverse_score(col, self.top)
        if name in self.weights:
            col = col * F.lit(self.weights[name])
        return col

    def score(self) -> Column:
        items = [self.item(i) for i in self.items]
        if self.how == "mean":
            score = row_mean(items, self.max_missing)
        elif self.how == "sum":
            score = row_sum(items, skip_missing=self.max_missing != 0)
            if self.max_missing:
                score = F.when(missing_count(items) <= self.max_missing, score)
        else:
            raise ValueError("how must be 'sum' or 'mean'")
        if self.factor != 1.0:
            score = score * F.lit(self.factor)
        return score if self.gate is None else F.when(F.expr(self.gate), score)

    def positive(self) -> Column:
        if self.cutoff is None:
            raise ValueError("the scale has no cut-off")
        return flag(self.score() >= self.cutoff)


def add_scores(df: DataFrame, scales: Mapping[str, Scale]) -> DataFrame:
    """Add one column per scale, and ``<name>_positive`` where it has a cut-off.

    Recoded items become columns first, so that a score which looks at an item
    several times (its value, whether it is missing) does not recode it each time.
    """
    staged, plain = {}, {}
    for n, (name, scale) in enumerate(scales.items()):
        cols = {i: f"_item{n}_{k}" for k, i in enumerate(scale.items)}
        staged |= {cols[i]: scale.item(i) for i in scale.items}
        plain[name] = replace(
            scale, items=list(cols.values()), answers=None, reversed=(), weights={}
        )
    df = df.withColumns(staged).withColumns({name: p.score() for name, p in plain.items()})
    positive = {
        f"{name}_positive": flag(F.col(quoted(name)) >= scale.cutoff)
        for name, scale in scales.items()
        if scale.cutoff is not None
    }
    return (df.withColumns(positive) if positive else df).drop(*staged)


def add_missing_counts(df: DataFrame, counts: Mapping[str, Sequence[str]]) -> DataFrame:
    return df.withColumns({name: missing_count(items) for name, items in counts.items()})


def look_up(
    df: DataFrame, table: DataFrame, on: str, key: str, value: str, name: str
) -> DataFrame:
    """Add a value from a score table; rows without an entry get null.

    No hint is given: a table of a few score values falls under the session's
    broadcast threshold by its measured size, and a larger one is shuffled.
    """
    entries = table.groupBy(F.col(quoted(key)).alias("_key")).agg(
        F.min(F.col(quoted(value))).alias(name)
    )
    return df.join(entries, F.col(quoted(on)) == F.col("_key"), "left").drop("_key")


def any_need(*conditions: Column, unknown_hides: bool = False) -> Column:
    """1 when any condition holds, else 0.

    With ``unknown_hides`` an open condition makes the whole answer 0, the stricter
    reading of a panel that counts only complete answers.
    """
    hit = F.lit(False)
    known = F.lit(True)
    for c in conditions:
        hit = hit | F.coalesce(c, F.lit(False))
        known = known & c.isNotNull()
    return F.when(hit & known if unknown_hides else hit, 1).otherwise(0)


def any_extreme(items: Mapping[str, object]) -> Column:
    """1 when any item has its extreme answer; unanswered items never do."""
    return any_need(*[as_col(i) == F.lit(v) for i, v in items.items()])


def screen_alcohol(
    frequency: Column | str, drinks: Column | str, binge: Column | str, cutoff: float = 3
) -> dict[str, Column]:
    """Three-item alcohol screen from the codes of the intake form.

    Frequency and binge codes start at 1 and are shifted to 0; a drinks code of 1
    counts as 0. A score made of the frequency item alone is not positive. With
    the frequency item open, nothing shows where the points come from, and the
    outcome is open too.
    """
    first = as_col(frequency).try_cast("double") - 1
    second_raw = as_col(drinks).try_cast("double")
    second = F.when(second_raw == 1, 0.0).otherwise(second_raw)
    third = as_col(binge).try_cast("double") - 1
    score = row_sum([first, second, third], skip_missing=True)
    only_first = score == first
    reached = score >= cutoff
    positive = (
        F.when(~reached, 0).when(only_first, 0).when(~only_first, 1)
    )
    return {"alcohol_score": score, "alcohol_positive": positive}


def exercise_minutes(days: Column | str, tens_of_minutes: Column | str) -> Column:
    """Minutes per week from days per week and minutes per day in tens; zero days
    are zero minutes whatever the second answer."""
    d = as_col(days).try_cast("double")
    m = as_col(tens_of_minutes).try_cast("double") * 10
    return F.when(d == 0, 0.0).otherwise(d * m)


def isolation_points(conditions: Sequence[Column]) -> Column:
    """One point per social tie; open answers give none."""
    return row_sum([F.when(F.coalesce(c, F.lit(False)), 1).otherwise(0) for c in conditions])
