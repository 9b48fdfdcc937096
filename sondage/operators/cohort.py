"""Who is in the study: exclusions, first rows, status, windows and checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import as_lit, matches, quoted


class CheckFailed(ValueError):
    """A data check found rows that must not exist."""


def flagged_ids(df: DataFrame, key: str, patterns: Mapping[str, str]) -> DataFrame:
    """Distinct records with a keyword, in any case, in one of the columns."""
    hit = reduce(or_, [matches(c, p, ignore_case=True) for c, p in patterns.items()])
    return df.where(hit).select(quoted(key)).distinct()


def exclude_flagged(df: DataFrame, key: str, *patterns: Mapping[str, str]) -> DataFrame:
    """Remove every row of a record that has a keyword anywhere."""
    rules = [(c, p) for group in patterns for c, p in group.items()]
    hit = reduce(or_, [matches(c, p, ignore_case=True) for c, p in rules])
    return anti(df, df.where(hit).select(quoted(key)), key)


def semi(df: DataFrame, ids: DataFrame, *keys: str) -> DataFrame:
    """Rows whose key is among ``ids``."""
    return df.join(ids.select(*[quoted(k) for k in keys]).distinct(), list(keys), "left_semi")


def anti(df: DataFrame, ids: DataFrame, *keys: str) -> DataFrame:
    """Rows whose key is not among ``ids``; rows without a key stay."""
    return df.join(ids.select(*[quoted(k) for k in keys]).distinct(), list(keys), "left_anti")


def first_row(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    cols: Sequence[str] | None = None,
) -> DataFrame:
    """First row of each group by an explicit order.

    An aggregate instead of a row number: every task sends on one candidate row
    per group, however many rows a group has. Ties in ``order`` go by the columns.
    """
    cols = list(cols) if cols is not None else [c for c in df.columns if c not in keys]
    rank = [F.col(quoted(o)).alias(f"_o{i}") for i, o in enumerate(order)]
    row = F.struct(*rank, *[F.col(quoted(c)).alias(f"_c{i}") for i, c in enumerate(cols)])
    return (
        df.groupBy(*[quoted(k) for k in keys])
        .agg(F.min(row).alias("_row"))
        .select(
            *[quoted(k) for k in keys],
            *[F.col("_row")[f"_c{i}"].alias(c) for i, c in enumerate(cols)],
        )
    )


def record_first(
    df: DataFrame, key: str, order: Sequence[str], cols: Sequence[str]
) -> DataFrame:
    """One row per record: its first non-missing value of every column.

    Equals filling up and then down within the record and keeping the first row,
    as one aggregate without a window.
    """
    rank = [F.col(quoted(o)).alias(f"_o{i}") for i, o in enumerate(order)]

    def first_known(c):
        known = F.col(quoted(c)).isNotNull()
        return F.min(F.when(known, F.struct(*rank, F.col(quoted(c)).alias("_c"))))["_c"]

    return df.groupBy(quoted(key)).agg(*[first_known(c).alias(c) for c in cols])


def last_completed(
    df: DataFrame,
    key: str,
    visit: str,
    statuses: Sequence[str],
    event: str,
    done: str = "Complete",
) -> DataFrame:
    """Latest visit of each record whose status, from the first status column
    that is set, is complete."""
    status = F.coalesce(*[F.col(quoted(s)) for s in statuses])
    return (
        df.where((status == done) & F.col(quoted(visit)).isNotNull())
        .groupBy(quoted(key))
        .agg(F.max_by(quoted(event), quoted(visit)).alias("last_event"))
    )


def large_groups(df: DataFrame, group: str, at_least: int) -> DataFrame:
    """Rows of groups with enough rows; rows without a group are dropped."""
    big = (
        df.groupBy(quoted(group)).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= at_least)
    )
    return df.join(big.select(quoted(group)), [group], "left_semi")


def until(df: DataFrame, date: str, last_day: str) -> DataFrame:
    """Rows dated on or before a day; undated rows are dropped."""
    day = F.col(quoted(date)).try_cast("date")
    return df.where(day <= F.lit(last_day).cast("date"))


def visit_status(
    status: Column | str,
    days: Column | str,
    due: int,
    grace: int,
    label: str,
    blocked: Column | None = None,
    blocked_label: str = "Incomplete T1 PASC",
) -> Column:
    """State of a follow-up visit, given days since the first one.

    A blocking condition comes first. An unset status is "Not due" before the due
    day, "within window" during the grace days and "past window" after them; a
    started but incomplete visit turns "past window" after the grace days too.
    """
    status = F.col(quoted(status)) if isinstance(status, str) else status
    days = F.col(quoted(days)) if isinstance(days, str) else days
    late = due + grace
    open_status = status.isNull() | (status == "Incomplete")
    steps = F.when(blocked, blocked_label) if blocked is not None else F
    return (
        steps.when(status.isNull() & (days < due), f"Not due for {label}")
        .when(status.isNull() & (days >= due) & (days < late), "Incomplete (within window)")
        .when(open_status & (days >= late), "Incomplete (past window)")
        .otherwise(status)
    )


def follow_up_status(
    df: DataFrame,
    statuses: Mapping[str, str],
    days: str,
    windows: Mapping[str, tuple[int, int]],
    blocked: Column | None = None,
) -> DataFrame:
    """Replace each follow-up status column by its window state.

    ``statuses`` maps a column to its visit label, ``windows`` a label to
    (due day, grace days).
    """
    return df.withColumns(
        {
            c: visit_status(c, days, windows[label][0], windows[label][1], label, blocked)
            for c, label in statuses.items()
        }
    )


def funnel(df: DataFrame, steps: Mapping[str, Column], by: Sequence[str] = ()) -> DataFrame:
    """Count of each step and its rate on the step before; the first step's
    rate is on all rows. Steps are nested: a later one requires the earlier."""
    reached, aggs, previous = F.lit(True), [F.count(F.lit(1)).alias("n_records")], "n_records"
    rates = []
    for name, cond in steps.items():
        reached = reached & F.coalesce(cond, F.lit(False))
        aggs.append(F.count_if(reached).alias(f"n_{name}"))
        rates.append((name, previous))
        previous = f"n_{name}"
    out = df.groupBy(*[quoted(b) for b in by]).agg(*aggs)
    return out.withColumns(
        {
            f"rate_{name}": F.when(F.col(base) > 0, F.col(f"n_{name}") / F.col(base))
            for name, base in rates
        }
    )


def violations(df: DataFrame, rules: Mapping[str, Column], keys: Sequence[str]) -> DataFrame:
    """One row per broken rule and row."""
    broken = F.array_compact(
        F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in rules.items()])
    )
    return df.select(*[quoted(k) for k in keys], F.explode(broken).alias("check"))


def repeated(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Values that occur on more than one row, with their count."""
    return (
        df.groupBy(*[quoted(c) for c in cols])
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > 1)
    )


def require_none(found: DataFrame, message: str) -> None:
    """Fail when a check frame has a row; only one row is fetched."""
    row = found.take(1)
    if row:
        raise CheckFailed(f"{message}: {row[0].asDict()}")


def mark_ids(df: DataFrame, ids: DataFrame, key: str, name: str) -> DataFrame:
    """1 where the record is among ``ids``, else 0."""
    marked = ids.select(quoted(key)).distinct().withColumn(name, F.lit(1))
    return df.join(marked, [key], "left").withColumn(name, F.coalesce(F.col(name), F.lit(0)))


def event_timepoint(event: Column | str, timepoints: Mapping[str, int]) -> Column:
    """Integer time point of an event, missing for events that have none."""
    col = F.col(quoted(event)) if isinstance(event, str) else event
    out = None
    for name, point in timepoints.items():
        out = F.when(col == name, as_lit(point)) if out is None else out.when(col == name, point)
    return out


