"""Text cells of summary tables."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def percent_text(n: Column, total: Column) -> Column:
    """Whole percent from 10 up, one decimal below, ``<0.1`` for a trace.

    Integer arithmetic, so a tie always rounds up.
    """
    tenths = F.floor((n * 2000 + total) / (total * 2))
    whole = F.floor((n * 200 + total) / (total * 2))
    return (
        F.when(total == 0, F.lit("NA"))
        .when(n == 0, F.lit("0"))
        .when(n * 1000 < total, F.lit("<0.1"))
        .when(tenths >= 100, whole.cast("string"))
        .otherwise(F.format_string("%d.%d", F.floor(tenths / 10), tenths % 10))
    )


def count_percent(n: Column, total: Column) -> Column:
    """``1,234 (56%)``"""
    return F.concat(F.format_number(n, 0), F.lit(" ("), percent_text(n, total), F.lit("%)"))


def fill_template(template: str, parts: Mapping[str, Column]) -> Column:
    """Replace ``{name}`` tokens by columns already rendered as text."""
    pieces = []
    for literal, token in re.findall(r"([^{]*)(?:\{(\w+)\})?", template):
        if literal:
            pieces.append(F.lit(literal))
        if token:
            pieces.append(F.coalesce(parts[token], F.lit("NA")))
    return F.concat(*pieces)


def number_text(c: Column, digits: int = 1) -> Column:
    return F.format_number(F.round(c, digits), digits)
