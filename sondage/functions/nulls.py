"""Missing-value rules of the survey scripts, written as Spark columns.

A survey answer that is missing must stay missing through a yes / no recode,
but must count as "not a member" in a set test. Spark's ``when`` and ``NOT IN``
do the opposite, so each rule has its own helper here.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c: Column | str) -> Column:
    return F.col(quoted(c)) if isinstance(c, str) else c


def quoted(name: str) -> str:
    """Column name safe for names holding dots, quotes or spaces."""
    return "`" + name.replace("`", "``") + "`"


def as_lit(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def if_else(cond: Column, yes, no) -> Column:
    """Two-way choice that stays missing when the condition is missing."""
    return F.when(cond, as_lit(yes)).when(~cond, as_lit(no))


def is_in(c: Column | str, values: Iterable) -> Column:
    """Set membership; a missing value is simply not a member."""
    return F.coalesce(as_col(c).isin(list(values)), F.lit(False))


def not_in(c: Column | str, values: Iterable) -> Column:
    """Complement of :func:`is_in`; keeps missing values."""
    return ~is_in(c, values)


def matches(c: Column | str, pattern: str, ignore_case: bool = False) -> Column:
    """Pattern test that is false on missing text."""
    return F.coalesce(detects(c, pattern, ignore_case), F.lit(False))


def detects(c: Column | str, pattern: str, ignore_case: bool = False) -> Column:
    """Pattern test that is missing on missing text."""
    return as_col(c).rlike(("(?i)" if ignore_case else "") + pattern)


def row_sum(cols: Sequence[Column | str], skip_missing: bool = False) -> Column:
    """Sum over columns of one row.

    Strict by default: one missing item makes the sum missing. With
    ``skip_missing`` an all-missing row sums to zero.
    """
    parts = [as_col(c) for c in cols]
    if skip_missing:
        parts = [F.coalesce(p, F.lit(0)) for p in parts]
    return reduce(add, parts)


def missing_count(cols: Sequence[Column | str]) -> Column:
    return reduce(add, [as_col(c).isNull().cast("int") for c in cols])


def row_mean(cols: Sequence[Column | str], max_missing: int | None = None) -> Column:
    """Mean of the answered items, missing past ``max_missing`` unanswered ones."""
    answered = F.lit(len(cols)) - missing_count(cols)
    mean = F.when(answered > 0, row_sum(cols, skip_missing=True).cast("double") / answered)
    if max_missing is None:
        return mean
    return F.when(missing_count(cols) <= max_missing, mean)


def strict(agg: Column, c: Column | str) -> Column:
    """Aggregate that is missing as soon as one input of the group is missing."""
    return F.when(F.count(as_col(c)) == F.count(F.lit(1)), agg)


def half_even(c: Column, digits: int = 0) -> Column:
    """Rounding to even on ties."""
    return F.bround(c, digits)
