"""One report definition, run by clinic, by site type or by visit."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.cohort import large_groups
from ..operators.stats import group_tests
from ..operators.summary import categorical, continuous, level_counts


@dataclass(frozen=True)
class Rule:
    """How a report by one variable is laid out.

    column: grouping column; min_rows: smallest group shown; show_p: add tests;
    first_visit: keep only first visits.
    """

    column: str
    show_p: bool = False
    continuous_test: str = "t.test"
    min_rows: int = 1
    first_visit: bool = True


RULES = {
    "by_clinic": Rule("site_name", min_rows=5),
    "by_site_type": Rule("site_type", show_p=True),
    "by_timepoint": Rule("redcap_event_name", first_visit=False),
}


@dataclass(frozen=True)
class Report:
    """Variables of a report by display type."""

    categorical: Sequence[str] = ()
    dichotomous: Mapping[str, object] = field(default_factory=dict)
    continuous: Sequence[str] = ()
    template: str = "{mean} ({sd}); [{min}, {median}, {max}]"
    levels: Sequence[str] = ()
    digits: int = 1


def run(
    df: DataFrame,
    report: Report,
    by_variable: str,
    rules: Mapping[str, Rule] = RULES,
    visit: str = "timepoint",
) -> DataFrame:
    """Rows of the whole report: variable, level, group, n, total, percent, stat,
    and test and p_value where the rule shows them."""
    rule = rules[by_variable]
    if rule.first_visit:
        df = df.where(F.col(visit) == 1)
    if rule.min_rows > 1:
        df = large_groups(df, rule.column, rule.min_rows)
    layout = ["variable", "level", "group", "n", "total", "percent", "stat"]
    no_text, no_number = F.lit(None).cast("string"), F.lit(None).cast("double")
    parts = []
    coded = [*report.categorical, *report.dichotomous]
    # One count of all levels serves the table and, below, the tests.
    counts = level_counts(df, coded, rule.column) if coded else None
    if coded:
        table = categorical(
            df, coded, by=rule.column, values=report.dichotomous, counts=counts
        )
        parts.append(table.withColumn("stat", no_text).select(*layout))
    if report.continuous:
        table = continuous(
            df, report.continuous, by=rule.column, template=report.template, digits=report.digits
        )
        parts.append(
            table.withColumns(
                {"level": no_text, "total": F.col("n"), "percent": no_number}
            ).select(*layout)
        )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    if not rule.show_p:
        return out.withColumns({"test": no_text, "p_value": no_number})
    tests = group_tests(
        df,
        rule.column,
        list(report.levels),
        coded,
        report.continuous,
        rule.continuous_test,
        counts,
    )
    # A null-safe join: an ordinary one would filter the variable in the tests'
    # branch and so part its counts from those of the table.
    tests = tests.withColumnRenamed("variable", "_tested")
    same = F.col("variable").eqNullSafe(F.col("_tested"))
    return out.join(tests, same, "left").drop("_tested")
