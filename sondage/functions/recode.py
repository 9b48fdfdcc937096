"""Recodes of single answers: value maps, bands, flags and text clean-up."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .nulls import as_col, as_lit, if_else, is_in, matches, row_sum

KEEP = object()


def value_map(c: Column | str, mapping: Mapping, default=None) -> Column:
    """Translate values; a tuple key stands for several input values.

    ``default=KEEP`` leaves unlisted values as they are.
    """
    col = as_col(c)
    out = None
    for key, value in mapping.items():
        hit = col.isin(list(key)) if isinstance(key, tuple) else col == F.lit(key)
        out = F.when(hit, as_lit(value)) if out is None else out.when(hit, as_lit(value))
    if out is None:
        return col if default is KEEP else as_lit(default)
    return out.otherwise(col if default is KEEP else as_lit(default))


def band(c: Column | str, bands: Sequence[tuple[float | None, float | None, str]]) -> Column:
    """Half-open bands ``[low, high)``; values outside all of them are missing."""
    col = as_col(c)
    out = None
    for low, high, label in bands:
        hit = F.lit(True)
        if low is not None:
            hit = hit & (col >= low)
        if high is not None:
            hit = hit & (col < high)
        hit = hit & col.isNotNull()
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out


def cut_right(c: Column | str, breaks: Sequence[float], labels: Sequence[str]) -> Column:
    """Right-closed bands ``(previous, break]``; the last label is open above."""
    if len(labels) != len(breaks) + 1:
        raise ValueError("one label more than breaks is needed")
    col = as_col(c)
    out = F.when(col.isNull(), F.lit(None).cast("string"))
    for upper, label in zip(breaks, labels):
        out = out.when(col <= upper, label)
    return out.otherwise(labels[-1])


def set_band(c: Column | str, groups: Mapping[str, Sequence], default=None) -> Column:
    """Name of the first group a value belongs to."""
    out = None
    for label, members in groups.items():
        hit = is_in(c, members)
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out.otherwise(as_lit(default))


def flag(cond: Column) -> Column:
    """1 / 0, missing when the condition is missing."""
    return cond.cast("int")


def checked(c: Column | str, word: str = "Checked") -> Column:
    return flag(as_col(c) == word)


def name_missing(c: Column | str, label: str = "Unknown") -> Column:
    return F.coalesce(as_col(c).cast("string"), F.lit(label))


def first_checked(flags: Mapping[str, str], several: str | None = None) -> Column:
    """Label of the first set flag; ``several`` when more than one is set."""
    one = F.coalesce(*[F.when(as_col(c) == 1, label) for c, label in flags.items()])
    if several is None:
        return one
    total = row_sum(list(flags))
    return if_else(total > 1, several, one)


def override(c: Column, cond: Column, label: str, keep_when_unknown: bool = True) -> Column:
    """Replace by ``label`` where ``cond`` holds.

    With ``keep_when_unknown`` a missing condition leaves the value alone; without
    it the value becomes missing as well.
    """
    if keep_when_unknown:
        return F.when(cond, label).otherwise(c)
    return if_else(cond, label, c)


def drop_parenthesis(c: Column | str) -> Column:
    """Text before the first opening parenthesis, trimmed."""
    return F.trim(F.regexp_replace(as_col(c), r"(?s)\(.*", ""))


def first_match(c: Column | str, rules: Sequence[tuple[str, str]]) -> Column:
    """Label of the rule whose pattern occurs in the text, else the text itself.

    Rules apply one after the other to the running value, as a chain of
    replacements does.
    """
    out = as_col(c)
    for pattern, label in rules:
        out = F.when(matches(out, pattern), label).otherwise(out)
    return out


def leading_number(c: Column | str) -> Column:
    """First character as a number, e.g. ``"4 - Good"`` -> 4."""
    return F.substring(as_col(c), 1, 1).try_cast("int")


def after_dash(c: Column | str) -> Column:
    """Text after the first dash, trimmed."""
    return F.trim(F.regexp_replace(as_col(c), r"^[^-]*-", ""))


def reverse_score(c: Column | str, top: int) -> Column:
    """Mirror a 1..top item."""
    return F.lit(top + 1) - as_col(c)


def without_code(c: Column | str, code=-88) -> Column:
    """Turn a "not asked" code into missing."""
    col = as_col(c)
    return F.when(col != code, col)
