"""Summary tables as long DataFrames: one row per variable, level and group.

Every table is one pass over the survey: variables are unpivoted inside the scan
stage, counted before the shuffle, and all later steps see counts only.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import localcontext

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import quoted, strict
from ..functions.recode import name_missing
from ..functions.style import count_percent, fill_template, number_text
from .ranks import percentiles
from .reshape import longer

OVERALL = "Overall"


def with_totals(
    counts: DataFrame, *totals: tuple[Sequence[str], Mapping[str, str]]
) -> DataFrame:
    """Add sums per key to a table of counts.

    Each total is a pair of keys and {new name: summed column}. All are summed from
    ``counts`` itself, so that they share its exchange, and joined back. A join and
    not a window: a key may own any number of levels.
    """
    out = counts
    for keys, sums in totals:
        tags = [f"_t{i}" for i in range(len(keys))]
        added = counts.groupBy(*[quoted(k) for k in keys]).agg(
            *[F.sum(c).alias(name) for name, c in sums.items()]
        )
        added = added.toDF(*tags, *sums)
        same = [F.col(quoted(k)).eqNullSafe(F.col(t)) for k, t in zip(keys, tags)]
        out = out.join(added, same, "left").drop(*tags)
    return out


def with_total(counts: DataFrame, keys: Sequence[str], n: str, name: str) -> DataFrame:
    return with_totals(counts, (keys, {name: n}))


def grouped(df: DataFrame, by: str | None, missing_group: str | None) -> tuple[DataFrame, Column]:
    """Rows that have a group, and the group as text. Rows without one are left
    out, unless ``missing_group`` names a group for them."""
    if by is None:
        return df, F.lit(OVERALL)
    if missing_group is not None:
        return df, name_missing(by, missing_group)
    return df.where(F.col(quoted(by)).isNotNull()), F.col(quoted(by)).cast("string")


def level_counts(
    df: DataFrame,
    variables: Sequence[str],
    by: str | None = None,
    strata: Sequence[str] = (),
    missing_group: str | None = None,
    drop_missing: bool = False,
) -> DataFrame:
    """Rows per stratum, variable, group and level; a missing level is a null level."""
    rows, group = grouped(df, by, missing_group)
    text = rows.select(
        *[F.col(quoted(k)) for k in strata],
        group.alias("group"),
        *[F.col(quoted(v)).cast("string").alias(v) for v in variables],
    )
    long = longer(text, [*strata, "group"], variables, "variable", "level")
    if drop_missing:
        long = long.where(F.col("level").isNotNull())
    keys = [quoted(k) for k in strata]
    return long.groupBy(*keys, "variable", "group", "level").agg(F.count(F.lit(1)).alias("n"))


def with_overall(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add the group "Overall" to counted rows, so survey rows are read once."""
    everyone = counts.groupBy(*[quoted(k) for k in keys]).agg(F.sum("n").alias("n"))
    return counts.unionByName(everyone.withColumn("group", F.lit(OVERALL)))


def categorical(
    df: DataFrame,
    variables: Sequence[str],
    by: str | None = None,
    strata: Sequence[str] = (),
    overall: bool = True,
    missing: str = "row",
    labels: Mapping[str, str] | None = None,
    levels: Mapping[str, Sequence[str]] | None = None,
    values: Mapping[str, object] | None = None,
    missing_group: str | None = None,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Count and percent of every level.

    missing: "row" keeps missing answers as a row outside the percentages,
             "level" counts them as the level "Unknown", "no" drops them
    labels:  variable -> text; adds ``label``
    levels:  variable -> levels in order; adds ``level_rank``, null for others
    values:  variable -> the one level to show (dichotomous display), shown even
             where no one has it

    Columns: strata, variable, level, group, n, total (non-missing rows of that
    variable and group), percent.
    """
    if missing == "level":
        df = df.withColumns({v: name_missing(v) for v in variables})
    if counts is None:
        counts = level_counts(df, variables, by, strata, missing_group, missing == "no")
    if by and overall:
        counts = with_overall(counts, [*strata, "variable", "level"])
    known = counts.withColumn("_known", F.when(F.col("level").isNotNull(), F.col("n")).otherwise(0))
    keys = [*strata, "variable", "group"]
    if values:
        # Regrouping instead of a filter: a filter on levels would reach the scan on
        # one side of the join below and make it read the survey twice.
        shown, hit = F.col("level"), F.lit(True)
        for v, level in values.items():
            mine = F.col("variable") == v
            shown = F.when(mine, F.lit(str(level))).otherwise(shown)
            hit = hit & (~mine | F.coalesce(F.col("level") == str(level), F.lit(False)))
        known = (
            known.withColumns({"_shown": shown, "n": F.when(hit, F.col("n")).otherwise(0)})
            .groupBy(*[quoted(k) for k in keys], F.col("_shown").alias("level"))
            .agg(F.sum("n").alias("n"), F.sum("_known").alias("_known"))
        )
    out = with_total(known, keys, "_known", "total").drop("_known")
    out = out.withColumn(
        "percent",
        F.when(F.col("level").isNotNull() & (F.col("total") > 0), F.col("n") * 100 / F.col("total")),
    )
    if labels:
        out = out.withColumn("label", _lookup("variable", labels, F.col("variable")))
    if levels:
        rank = None
        for v, names in levels.items():
            for i, name in enumerate(names):
                hit = (F.col("variable") == v) & (F.col("level") == name)
                rank = F.when(hit, i + 1) if rank is None else rank.when(hit, i + 1)
        out = out.withColumn("level_rank", rank)
    return out


def _lookup(name: str, table: Mapping[str, str], default: Column) -> Column:
    out = default
    for key, value in table.items():
        out = F.when(F.col(name) == key, value).otherwise(out)
    return out


def dichotomous(
    df: DataFrame,
    values: Mapping[str, object],
    by: str | None = None,
    overall: bool = True,
    strata: Sequence[str] = (),
    missing_group: str | None = None,
) -> DataFrame:
    """Count and percent of one level per variable, zero counts included.

    Conditional counts in one aggregate, without turning the survey long.
    """
    keys = [quoted(k) for k in strata]
    rows, group = grouped(df, by, missing_group)
    cells = [F.col(quoted(v)).cast("string").alias(v) for v in values]
    base = rows.select(*keys, group.alias("group"), *cells)
    sums = base.groupBy(*keys, "group").agg(
        *[F.count_if(F.col(quoted(v)) == str(x)).alias(f"{v}§n") for v, x in values.items()],
        *[F.count(F.col(quoted(v))).alias(f"{v}§total") for v in values],
    )
    if by and overall:
        everyone = sums.groupBy(*keys).agg(
            *[F.sum(F.col(f"`{v}§{s}`")).alias(f"{v}§{s}") for s in ("n", "total") for v in values]
        )
        sums = sums.unionByName(everyone.withColumn("group", F.lit(OVERALL)))
    pairs = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(v).alias("variable"),
                    F.lit(str(x)).alias("level"),
                    F.col(f"`{v}§n`").alias("n"),
                    F.col(f"`{v}§total`").alias("total"),
                )
                for v, x in values.items()
            ]
        )
    ).alias("_p")
    return (
        sums.select(*keys, "group", pairs)
        .select(*keys, "_p.variable", "_p.level", "group", "_p.n", "_p.total")
        .withColumn("percent", F.when(F.col("total") > 0, F.col("n") * 100 / F.col("total")))
    )


QUARTILES = {"p25": 0.25, "median": 0.5, "p75": 0.75}


def continuous_long(
    df: DataFrame,
    variables: Sequence[str],
    by: str | None = None,
    overall: bool = True,
    missing_group: str | None = None,
) -> DataFrame:
    """Group, variable and value, every row once more under "Overall" if asked."""
    rows, group = grouped(df, by, missing_group)
    cells = [F.col(quoted(v)).cast("double").alias(v) for v in variables]
    groups = [F.col("group")] + ([F.lit(OVERALL)] if by and overall else [])
    flat = [
        part for v in variables for g in groups for part in (F.lit(v), g, F.col(quoted(v)))
    ]
    return rows.select(group.alias("group"), *cells).select(
        F.stack(F.lit(len(variables) * len(groups)), *flat).alias("variable", "group", "value")
    )


def _moments() -> list[Column]:
    return [
        F.count("value").alias("n"),
        (F.count(F.lit(1)) - F.count("value")).alias("n_missing"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("sd"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    ]


def moments_of(long: DataFrame) -> DataFrame:
    return long.groupBy("variable", "group").agg(*_moments())


#: Values of this type add up without rounding, and so do their squares.
EXACT = "decimal(18,6)"


def mean_and_sd(n, total, squares):
    """Mean and standard deviation from exact sums of the values and of their squares."""
    out = {"mean": None, "sd": None}
    with localcontext() as context:
        context.prec = 100
        if total is not None:
            out["mean"] = float(total / n)
        if total is not None and squares is not None and n > 1:
            out["sd"] = float(((squares - total * total / n) / (n - 1)).sqrt())
    return out


def exact_moments_of(long: DataFrame) -> DataFrame:
    """As ``moments_of``, with mean and sd the same for any order of the rows.

    Values are summed as decimals, as they are written: a mean that ends in 5 behind the
    digits shown must not round by what summing left in its last bits. A group with a
    value that has more digits than EXACT, or with sums that do not fit, keeps the
    moments in floating point.
    """
    value = F.col("value")
    exact = value.try_cast(EXACT)
    fits = F.bool_and(value.isNull() | exact.cast("double").eqNullSafe(value))
    sums = {"_total": F.try_sum(exact), "_squares": F.try_sum(exact * exact)}
    rows = long.groupBy("variable", "group").agg(
        *_moments(), *[F.when(fits, c).alias(name) for name, c in sums.items()]
    )
    found = F.udf(mean_and_sd, "mean double, sd double")("n", "_total", "_squares")
    rows = rows.withColumn("_exact", found)
    better = {c: F.coalesce(F.col(f"_exact.{c}"), F.col(c)) for c in ("mean", "sd")}
    return rows.withColumns(better).drop("_exact", *sums)


def continuous(
    df: DataFrame,
    variables: Sequence[str],
    by: str | None = None,
    overall: bool = True,
    template: str | None = None,
    kind: int = 2,
    few_values: bool = False,
    digits: int = 1,
    missing_group: str | None = None,
) -> DataFrame:
    """Count, missing, mean, sd, min, max and exact quartiles of every variable.

    ``template`` adds ``stat``, e.g. ``"{mean} ({sd}); [{min}, {median}, {max}]"``.
    Quartiles are only computed when there is no template or it asks for them.
    """
    long = continuous_long(df, variables, by, overall, missing_group)
    keys = ["variable", "group"]
    moments = exact_moments_of(long)
    wanted = {
        k: p for k, p in QUARTILES.items() if template is None or "{" + k + "}" in template
    }
    if wanted:
        cuts = percentiles(long, "value", wanted, keys, kind, few_values=few_values)
        moments = moments.join(cuts, keys, "left")
    if template is None:
        return moments
    names = ["mean", "sd", "min", "max", *wanted]
    parts = {m: number_text(F.col(m), digits) for m in names}
    parts |= {"n": F.format_number("n", 0), "n_miss": F.format_number("n_missing", 0)}
    return moments.withColumn("stat", fill_template(template, parts))


def likert(
    df: DataFrame,
    items: Sequence[str],
    levels: Sequence[str],
    strata: Sequence[str] = (),
    unknown: str | None = "Unknown",
) -> DataFrame:
    """Item by level grid: ``n_<k>`` and ``percent_<k>`` for level number k.

    Missing answers become the level ``unknown`` when given. Answers outside the
    levels are missing and leave the denominator; ``n`` is what remains.
    """
    text = df.select(
        *[F.col(quoted(k)) for k in strata],
        *[(name_missing(i, unknown) if unknown else F.col(quoted(i))).alias(i) for i in items],
    )
    long = longer(text, list(strata), items, "item", "level")
    counts = [F.count_if(F.col("level") == lv).alias(f"n_{k}") for k, lv in enumerate(levels, 1)]
    valid = F.count_if(F.col("level").isin(list(levels))).alias("n")
    grid = long.groupBy(*[quoted(k) for k in strata], "item").agg(valid, *counts)
    return grid.withColumns(
        {
            f"percent_{k}": F.when(F.col("n") > 0, F.col(f"n_{k}") * 100 / F.col("n"))
            for k in range(1, len(levels) + 1)
        }
    )


def endorsement(
    df: DataFrame,
    items: Sequence[str],
    denominators: Mapping[str, Column] | None = None,
    strata: Sequence[str] = (),
) -> DataFrame:
    """Endorsed rows per 0/1 item with percent of all rows.

    A branched item has its own denominator: the rows for which the condition
    holds. An unanswered item is not endorsed but stays in the denominator.
    """
    special = denominators or {}
    keys = [quoted(k) for k in strata]
    sums = df.groupBy(*keys).agg(
        *[F.count_if(F.col(quoted(i)) == 1).alias(f"{i}§n") for i in items],
        *[
            (F.count_if(special[i]) if i in special else F.count(F.lit(1))).alias(f"{i}§total")
            for i in items
        ],
    )
    rows = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(i).alias("item"),
                    F.col(f"`{i}§n`").alias("n"),
                    F.col(f"`{i}§total`").alias("total"),
                )
                for i in items
            ]
        )
    ).alias("_r")
    return (
        sums.select(*keys, rows)
        .select(*keys, "_r.item", "_r.n", "_r.total")
        .withColumn("percent", F.when(F.col("total") > 0, F.col("n") * 100 / F.col("total")))
    )


def collapsed(
    df: DataFrame,
    items: Sequence[str],
    groups: Mapping[str, Sequence[str]],
    by: str,
    positive: Sequence[str] = (),
    unknown: str = "Unknown",
) -> DataFrame:
    """Answers folded into a few responses, as percent of the group's rows.

    ``groups`` maps a response to its answers; ``positive`` items are tagged by
    valence. Missing answers are the response ``unknown``.
    """
    fold = name_missing("level", unknown)
    for response, answers in groups.items():
        fold = F.when(F.col("level").isin(list(answers)), response).otherwise(fold)
    long = longer(
        df.select(F.col(quoted(by)), *[F.col(quoted(i)).cast("string").alias(i) for i in items]),
        [by],
        items,
        "item",
        "level",
    )
    counts = (
        long.withColumn("response", fold)
        .groupBy(quoted(by), "item", "response")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # Every row of the group gives one answer per item, so an item's answers add
    # up to the group size.
    sized = with_total(counts, [by, "item"], "n", "total")
    return sized.withColumns(
        {
            "percent": F.col("n") * 100 / F.col("total"),
            "valence": F.when(F.col("item").isin(list(positive)), "positive").otherwise("negative"),
        }
    )


def group_means(
    df: DataFrame, by: Sequence[str], values: Sequence[str], na_rm: bool = False
) -> DataFrame:
    """Mean and standard error per group and value column.

    The standard error divides by the square root of all rows. Unless ``na_rm``,
    one missing value makes both missing.
    """
    rows = F.count(F.lit(1))
    aggs = []
    for v in values:
        c = F.col(quoted(v))
        mean, se = F.avg(c), F.stddev_samp(c) / F.sqrt(rows)
        aggs += [
            (mean if na_rm else strict(mean, c)).alias(f"mean_{v}"),
            (se if na_rm else strict(se, c)).alias(f"se_{v}"),
        ]
    return df.groupBy(*[quoted(b) for b in by]).agg(rows.alias("n"), *aggs)


def frequency(df: DataFrame, text: str, where: Column | None = None) -> DataFrame:
    """Counts of the given texts among the selected rows, missing texts dropped."""
    return frequencies(df, {text: where})


def frequencies(df: DataFrame, texts: Mapping[str, Column | None]) -> DataFrame:
    """Counts of several free-text columns at once, each among its own rows."""
    cells = {
        t: F.col(quoted(t)) if cond is None else F.when(cond, F.col(quoted(t)))
        for t, cond in texts.items()
    }
    long = longer(df.select(*[c.alias(t) for t, c in cells.items()]), [], list(texts),
                  "variable", "level")
    counts = (
        long.where(F.col("level").isNotNull())
        .groupBy("variable", "level")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return with_total(counts, ["variable"], "n", "total").withColumn(
        "percent", F.col("n") * 100 / F.col("total")
    )


def group_sizes(
    df: DataFrame, by: str, overall: bool = True, missing_group: str | None = None
) -> DataFrame:
    """Rows per group, with a column heading of the form ``level, N = 1,234``."""
    rows, group = grouped(df, by, missing_group)
    sizes = rows.groupBy(group.alias("group")).agg(F.count(F.lit(1)).alias("n"))
    if overall:
        whole = sizes.agg(F.sum("n").alias("n")).where("n is not null")
        sizes = sizes.unionByName(whole.withColumn("group", F.lit(OVERALL)))
    return sizes.withColumn("header", F.concat("group", F.lit(", N = "), F.format_number("n", 0)))


def mean_of_monthly_counts(df: DataFrame, stamp: str) -> DataFrame:
    """Mean number of dated rows per calendar month that has any."""
    monthly = (
        df.where(F.col(quoted(stamp)).isNotNull())
        .groupBy(F.date_format(quoted(stamp), "yyyy-MM").alias("month"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return monthly.agg(F.avg("n").alias("mean"), F.count(F.lit(1)).alias("months"))


def side_by_side(table: DataFrame, groups: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Long summary to one ``n (p%)`` column per group, ``0 (0%)`` where empty.

    Missing rows show their count only.
    """
    cell = F.first(
        F.when(F.col("percent").isNull(), F.format_number("n", 0)).otherwise(
            count_percent(F.col("n"), F.col("total"))
        ),
        ignorenulls=True,
    )
    wide = table.groupBy(*[quoted(k) for k in keys]).pivot("group", list(groups)).agg(cell)
    return wide.fillna("0 (0%)", subset=list(groups))
