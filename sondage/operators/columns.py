"""Picking and renaming columns, and applying one rule to many of them."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import quoted


def starting(df: DataFrame, *prefixes: str) -> list[str]:
    return [c for c in df.columns if c.startswith(prefixes)]


def ending(df: DataFrame, *suffixes: str) -> list[str]:
    return [c for c in df.columns if c.endswith(suffixes)]


def span(df: DataFrame, first: str, last: str) -> list[str]:
    """Columns from ``first`` to ``last`` in frame order, both included."""
    names = df.columns
    return names[names.index(first) : names.index(last) + 1]


def pick(df: DataFrame, names: Iterable[str]) -> DataFrame:
    return df.select(*[quoted(n) for n in names])


def leave_out(df: DataFrame, names: Iterable[str]) -> DataFrame:
    gone = set(names)
    return pick(df, [c for c in df.columns if c not in gone])


def across(df: DataFrame, names: Iterable[str], rule: Callable[[Column], Column]) -> DataFrame:
    """Apply ``rule`` to every named column in one projection."""
    return df.withColumns({n: rule(F.col(quoted(n))) for n in names})


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def rename_in_order(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Give the columns new names by position."""
    if len(names) != len(df.columns):
        raise ValueError(f"{len(names)} names for {len(df.columns)} columns")
    return df.toDF(*names)


def rename_by_pattern(df: DataFrame, pattern: str, replacement: str) -> DataFrame:
    """Rewrite every column name with the first match of ``pattern`` replaced."""
    return rename_in_order(df, [re.sub(pattern, replacement, c, count=1) for c in df.columns])


def dictionary(raw: DataFrame, labelled: DataFrame) -> dict[str, str]:
    """Field name -> label, from two exports that differ only in their headers."""
    return dict(zip(raw.columns, labelled.columns, strict=True))


def label_header(df: DataFrame, labels: Mapping[str, str]) -> DataFrame:
    """Swap field names for labels; fields without a label keep their name."""
    return rename_in_order(df, [labels.get(c, c) for c in df.columns])


def labels_for(entries: DataFrame, fields: Sequence[str], name: str, label: str) -> dict[str, str]:
    """Labels of the given fields from a dictionary table.

    Only rows about these fields reach the driver, so the schema bounds them.
    """
    rows = (
        entries.where(F.col(quoted(name)).isin(list(fields)))
        .groupBy(F.col(quoted(name)).alias("name"))
        .agg(F.min(F.col(quoted(label))).alias("label"))
        .collect()
    )
    return {r["name"]: r["label"] for r in rows}
