"""Tests and models. The survey rows meet one aggregate; formulas see its rows."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml.feature import RFormula
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import distributions as dist
from ..functions.nulls import quoted
from .ranks import average_rank, ranked_counts
from .summary import continuous_long, level_counts, moments_of, with_totals

NORMAL_975 = 1.959963984540054


def t_test(df: DataFrame, values: Sequence[str], by: str, levels: tuple[str, str]) -> DataFrame:
    """Two-sample t-test with pooled variance, one row per value column."""
    moments = moments_of(continuous_long(df, values, by, overall=False))
    aggs = []
    for i, level in enumerate(levels, 1):
        here = F.col("group") == level
        aggs += [
            F.coalesce(F.max(F.when(here, F.col("n"))), F.lit(0)).alias(f"n{i}"),
            F.max(F.when(here, F.col("mean"))).alias(f"mean{i}"),
            F.max(F.when(here, F.col("sd"))).alias(f"_s{i}"),
        ]
    rows = moments.groupBy("variable").agg(*aggs)
    n1, n2 = F.col("n1"), F.col("n2")
    freedom = n1 + n2 - 2
    # One answer has no spread of its own but still counts in the comparison.
    squares = [
        F.when(F.col(f"n{i}") > 1, (F.col(f"n{i}") - 1) * F.col(f"_s{i}") ** 2).otherwise(0.0)
        for i in (1, 2)
    ]
    known = (n1 > 0) & (n2 > 0) & (freedom > 0)
    pooled = F.when(known, (squares[0] + squares[1]) / freedom)
    se = F.when(known, F.sqrt(pooled * (F.lit(1) / n1 + F.lit(1) / n2)))
    out = rows.select(
        "variable", "n1", "n2", "mean1", "mean2",
        (F.col("mean1") - F.col("mean2")).alias("difference"),
        se.alias("se"),
        freedom.cast("double").alias("df"),
    ).withColumn("statistic", F.when(F.col("se") > 0, F.col("difference") / F.col("se")))
    return out.withColumn("p_value", dist.p_t("statistic", "df"))


def contingency(counts: DataFrame) -> DataFrame:
    """Cells of :func:`level_counts` with their row, column and table totals.

    Missing levels stay as null levels that count in no total. Dropping them with a
    filter would give each total a scan of its own instead of one shared count.
    """
    cells = counts.withColumn("_n", F.when(F.col("level").isNotNull(), F.col("n")).otherwise(0))
    cells = with_totals(
        cells,
        (["variable", "level"], {"row_total": "_n"}),
        (["variable", "group"], {"col_total": "_n"}),
        (["variable"], {"table_total": "_n"}),
    )
    return cells.drop("_n")


def chi_square(df: DataFrame, variables: Sequence[str], by: str) -> DataFrame:
    """Pearson chi-square without correction, one row per variable."""
    return _chi_square(contingency(level_counts(df, variables, by))).drop("table")


def _chi_square(cells: DataFrame) -> DataFrame:
    known = F.col("level").isNotNull()
    expected = F.col("row_total").cast("double") * F.col("col_total") / F.col("table_total")
    filled = known & (F.col("col_total") > 0)
    parts = cells.groupBy("variable").agg(
        F.max("table_total").alias("n"),
        F.sum(F.when(known, (F.col("n") - expected) ** 2 / expected)).alias("_seen"),
        F.sum(F.when(known, expected)).alias("_expected"),
        F.count("level").alias("_cells"),
        F.countDistinct("level").alias("rows"),
        F.countDistinct(F.when(filled, F.col("group"))).alias("cols"),
        F.min(F.when(known, F.col("row_total"))).alias("_r"),
        F.min(F.when(known, F.col("col_total"))).alias("_c"),
        # For the exact test.
        F.collect_list(F.when(known, F.struct("level", "group", "n"))).alias("table"),
    )
    # Empty cells are not stored; each adds its expected count.
    empty = F.when(F.col("_cells") < F.col("rows") * F.col("cols"), F.col("n") - F.col("_expected"))
    out = parts.select(
        "variable",
        "n",
        "rows",
        "cols",
        (F.col("_seen") + F.coalesce(empty, F.lit(0.0))).alias("statistic"),
        ((F.col("rows") - 1) * (F.col("cols") - 1)).cast("double").alias("df"),
        (F.col("_r").cast("double") * F.col("_c") / F.col("n")).alias("min_expected"),
        "table",
    )
    return out.withColumn(
        "p_value", dist.p_chi2("statistic", F.when(F.col("df") > 0, F.col("df")))
    )


@F.pandas_udf(T.DoubleType())
def _fisher(rows: pd.Series, cols: pd.Series, counts: pd.Series) -> pd.Series:
    out = []
    for r, c, n in zip(rows, cols, counts):
        if r is None:
            out.append(None)
            continue
        ri, rn = np.unique(np.asarray(r, dtype=str), return_inverse=True)
        ci, cn = np.unique(np.asarray(c, dtype=str), return_inverse=True)
        table = np.zeros((len(ri), len(ci)), dtype=np.int64)
        table[rn, cn] = n
        if table.shape == (2, 2):
            out.append(dist.fisher_two_by_two(*(int(v) for v in table.ravel())))
        elif min(table.shape) < 2:
            out.append(None)
        else:
            # The search walks columns; the shorter side makes the smaller state.
            out.append(dist.fisher_table(table if table.shape[0] <= table.shape[1] else table.T))
    return pd.Series(out, dtype="float64")


def categorical_test(
    df: DataFrame,
    variables: Sequence[str],
    by: str,
    exact_below: float = 5,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Chi-square, or Fisher's exact test where an expected count is small.

    The expected count alone decides. An exact test takes the time its table needs.
    """
    chi = _chi_square(contingency(level_counts(df, variables, by) if counts is None else counts))
    few = F.col("min_expected") < exact_below
    table = F.when(few & (F.col("df") > 0) & (F.size("table") > 0), F.col("table"))
    chi = chi.withColumn("_small", table).withColumn(
        "_exact", _fisher("_small.level", "_small.group", "_small.n")
    )
    return chi.select(
        "variable",
        "n",
        F.when(few & F.col("_exact").isNotNull(), "fisher").otherwise("chi-square").alias("test"),
        "statistic",
        "df",
        "min_expected",
        F.when(few, F.coalesce("_exact", "p_value")).otherwise(F.col("p_value")).alias("p_value"),
    )


def fisher(df: DataFrame, variables: Sequence[str], by: str) -> DataFrame:
    """Fisher's exact test whatever the expected counts; null for less than 2 x 2."""
    return categorical_test(df, variables, by, float("inf")).select(
        "variable", "n", "test",
        F.when(F.col("test") == "fisher", F.col("p_value")).alias("p_value"),
    )


def _rank_parts(df, value, by, levels, few_values, *more):
    rows = df.where(F.col(quoted(by)).isin(list(levels)))
    ranked = ranked_counts(
        rows,
        value,
        counts={f"g{i}": F.count_if(F.col(quoted(by)) == lv) for i, lv in enumerate(levels)},
        few_values=few_values,
    )
    centred = average_rank() - (F.col("total") + 1) / F.lit(2.0)
    ties = F.sum(F.pow(F.col("n").cast("double"), 3) - F.col("n"))
    aggs = [F.sum("n").alias("n"), ties.alias("ties"), *more]
    for i in range(len(levels)):
        aggs += [F.sum(f"g{i}").alias(f"n{i}"), F.sum(F.col(f"g{i}") * centred).alias(f"r{i}")]
    return ranked.agg(*aggs)


def kruskal_wallis(
    df: DataFrame, value: str, by: str, levels: Sequence[str], few_values: bool = False
) -> DataFrame:
    """Rank test of equal location over groups, corrected for ties."""
    parts = _rank_parts(df, value, by, levels, few_values)
    n = F.col("n").cast("double")
    spread = sum(
        (
            F.when(F.col(f"n{i}") > 0, F.col(f"r{i}") ** 2 / F.col(f"n{i}")).otherwise(0.0)
            for i in range(len(levels))
        ),
        F.lit(0.0),
    )
    used = sum(((F.col(f"n{i}") > 0).cast("int") for i in range(len(levels))), F.lit(0))
    out = parts.select(
        F.lit(value).alias("variable"),
        "n",
        (12 / (n * (n + 1)) * spread / (1 - F.col("ties") / (n * n * n - n))).alias("statistic"),
        (used - 1).cast("double").alias("df"),
    )
    return out.withColumn("p_value", dist.p_chi2("statistic", "df"))


@F.pandas_udf(T.DoubleType())
def _rank_sum_p(w: pd.Series, n1: pd.Series, n2: pd.Series, z: pd.Series, ties: pd.Series) -> pd.Series:
    out = []
    for wi, a, b, zi, t in zip(w, n1, n2, z, ties):
        if t == 0 and a < 50 and b < 50:
            out.append(dist.rank_sum_exact(wi, int(a), int(b)))
        else:
            out.append(None if pd.isna(zi) else dist.normal_two_sided(zi))
    return pd.Series(out, dtype="float64")


@F.pandas_udf(T.DoubleType())
def _rank_sum_exact_p(w: pd.Series, n1: pd.Series, n2: pd.Series, below: pd.Series, size: pd.Series) -> pd.Series:
    out = []
    for wi, a, b, less, same in zip(w, n1, n2, below, size):
        order = np.argsort(np.asarray(less, dtype=np.int64))
        less, same = (np.asarray(x, dtype=np.int64)[order] for x in (less, same))
        out.append(dist.rank_sum_tied(wi, int(a), less, same) if a > 0 and b > 0 else None)
    return pd.Series(out, dtype="float64")


def rank_sum(
    df: DataFrame,
    value: str,
    by: str,
    levels: tuple[str, str],
    few_values: bool = False,
    exact: bool | None = None,
) -> DataFrame:
    """Two-sample rank-sum test.

    ``exact`` None: exact below 50 answers a group without ties, else normal with
    continuity and tie correction, the usual rule of statistics packages. True: exact by
    counting all draws of tied scores, whatever the size; the counts of distinct values
    then meet in one task, which takes time with the cube of the answers. False: normal.
    A group without answers gives a null p-value.
    """
    more = [F.collect_list(c).alias(f"_{c}") for c in ("below", "n")] if exact else []
    parts = _rank_parts(df, value, by, levels, few_values, *more)
    n, n1, n2 = (F.col(c).cast("double") for c in ("n", "n0", "n1"))
    shift = F.col("r0")
    sigma = F.sqrt(n1 * n2 / 12 * ((n + 1) - F.try_divide(F.col("ties"), n * (n - 1))))
    out = parts.select(
        F.lit(value).alias("variable"),
        F.col("n0").alias("n1"),
        F.col("n1").alias("n2"),
        (shift + n1 * n2 / 2).alias("statistic"),
        F.when(sigma > 0, (shift - F.signum(shift) * 0.5) / sigma).alias("z"),
        "ties",
        *[F.col(c) for c in ("_below", "_n") if exact],
    )
    if exact:
        p = _rank_sum_exact_p("statistic", "n1", "n2", "_below", "_n")
    elif exact is None:
        p = _rank_sum_p("statistic", "n1", "n2", "z", "ties")
    else:
        p = F.when(F.col("z").isNotNull(), dist.p_normal("z"))
    return out.withColumn("p_value", p).drop("ties", "_below", "_n")


def correlation_test(df: DataFrame, x: str, y: str) -> DataFrame:
    """Pearson correlation over complete pairs with t-test and 95% interval."""
    a, b = F.col(quoted(x)).cast("double"), F.col(quoted(y)).cast("double")
    pairs = df.select(a.alias("a"), b.alias("b")).where("a is not null and b is not null")
    base = pairs.agg(F.count(F.lit(1)).alias("n"), F.corr("a", "b").alias("r"))
    freedom = (F.col("n") - 2).cast("double")
    z, half = F.atanh("r"), F.lit(NORMAL_975) / F.sqrt(F.col("n") - 3)
    out = base.select(
        "n",
        "r",
        (F.col("r") * F.sqrt(freedom / (1 - F.col("r") ** 2))).alias("statistic"),
        freedom.alias("df"),
        F.when(F.col("n") > 3, F.tanh(z - half)).alias("low"),
        F.when(F.col("n") > 3, F.tanh(z + half)).alias("high"),
    )
    return out.withColumn("p_value", dist.p_t("statistic", "df"))


def _group_moments(df: DataFrame, value: str, by: str) -> DataFrame:
    rows = df.select(
        F.col(quoted(by)).cast("string").alias("level"),
        F.col(quoted(value)).cast("double").alias("y"),
    ).where("level is not null and y is not null")
    return rows.rollup("level").agg(
        F.grouping("level").alias("whole"),
        F.count(F.lit(1)).alias("n"),
        F.avg("y").alias("mean"),
        (F.var_samp("y") * (F.count(F.lit(1)) - 1)).alias("ss"),
    )


def anova(df: DataFrame, value: str, by: str) -> DataFrame:
    """One-way analysis of variance: one row with both sums of squares."""
    part = F.col("whole") == 0
    sums = _group_moments(df, value, by).agg(
        (F.count_if(part) - 1).cast("double").alias("df_between"),
        F.sum(F.when(part, F.col("n") - 1)).cast("double").alias("df_within"),
        # A group of one row has no spread.
        F.sum(F.when(part, F.when(F.col("n") > 1, F.col("ss")).otherwise(0.0))).alias("ss_within"),
        F.max(F.when(~part, F.col("mean"))).alias("_mean"),
        # One entry per level, summed about the grand mean: no large sums to subtract.
        F.collect_list(F.when(part, F.struct("n", "mean"))).alias("_levels"),
    )
    between = F.aggregate(
        "_levels", F.lit(0.0), lambda s, g: s + g["n"] * (g["mean"] - F.col("_mean")) ** 2
    )
    out = sums.select(
        "df_between",
        "df_within",
        between.alias("ss_between"),
        "ss_within",
    ).withColumn(
        "statistic",
        (F.col("ss_between") / F.col("df_between")) / (F.col("ss_within") / F.col("df_within")),
    )
    return out.withColumn("p_value", dist.p_f("statistic", "df_between", "df_within"))


def _level_row(df: DataFrame, value: str, by: str, levels: Sequence[str]) -> DataFrame:
    """One row: n and mean per level, pooled error variance and its df."""
    y, g = F.col(quoted(value)).cast("double"), F.col(quoted(by)).cast("string")
    aggs = []
    for i, level in enumerate(levels):
        here = F.when(g == level, y)
        aggs += [
            F.count(here).alias(f"n{i}"),
            F.avg(here).alias(f"m{i}"),
            F.coalesce(F.var_samp(here) * (F.count(here) - 1), F.lit(0.0)).alias(f"s{i}"),
        ]
    row = df.agg(*aggs)
    total = sum((F.col(f"n{i}") for i in range(len(levels))), F.lit(0))
    squares = sum((F.col(f"s{i}") for i in range(len(levels))), F.lit(0.0))
    used = sum(((F.col(f"n{i}") > 0).cast("int") for i in range(len(levels))), F.lit(0))
    return row.withColumns(
        {"df": (total - used).cast("double"), "mse": squares / (total - used), "used": used}
    )


def _with_interval(df: DataFrame, estimate: str, half: Column) -> DataFrame:
    """``low`` and ``high``, ``half`` standard errors from the estimate."""
    half = F.col("se") * half
    return df.withColumns({"low": F.col(estimate) - half, "high": F.col(estimate) + half})


def marginal_means(
    df: DataFrame, value: str, by: str, levels: Sequence[str], confidence: float | None = None
) -> DataFrame:
    """Group means with standard errors from the pooled residual variance.

    With a ``confidence`` such as 0.95, ``low`` and ``high`` are the ends of the interval.
    """
    rows = F.array(
        *[
            F.struct(F.lit(lv).alias("level"), F.col(f"n{i}").alias("n"), F.col(f"m{i}").alias("mean"))
            for i, lv in enumerate(levels)
        ]
    )
    out = (
        _level_row(df, value, by, levels)
        .select(F.explode(rows).alias("r"), "df", "mse")
        .select("r.level", "r.n", "r.mean", F.sqrt(F.col("mse") / F.col("r.n")).alias("se"), "df")
        .where("n > 0")
    )
    return out if confidence is None else _with_interval(out, "mean", dist.q_t(F.lit(confidence), "df"))


def pairwise_contrasts(
    df: DataFrame,
    value: str,
    by: str,
    levels: Sequence[str],
    adjust: str = "tukey",
    confidence: float | None = None,
) -> DataFrame:
    """Differences of the level means, from one row of level moments.

    ``p_value`` is adjusted for all pairs by the studentised range, or plain with
    ``adjust="none"``. With a ``confidence``, ``low`` and ``high`` are the ends of the
    interval, adjusted in the same way: it leaves out 0 where ``p_value`` is small enough.
    """
    pairs = [
        F.struct(
            F.lit(f"{levels[i]} - {levels[j]}").alias("contrast"),
            (F.col(f"m{i}") - F.col(f"m{j}")).alias("estimate"),
            F.sqrt(F.col("mse") * (1 / F.col(f"n{i}") + 1 / F.col(f"n{j}"))).alias("se"),
        )
        for i in range(len(levels))
        for j in range(i + 1, len(levels))
    ]
    out = (
        _level_row(df, value, by, levels)
        .select(F.explode(F.array(*pairs)).alias("c"), "df", "used")
        .select("c.*", "df", "used")
        .where("estimate is not null")
        .withColumn("statistic", F.col("estimate") / F.col("se"))
    )
    p = {
        "tukey": lambda: dist.p_tukey(F.abs("statistic") * F.sqrt(F.lit(2.0)), "used", "df"),
        "none": lambda: dist.p_t("statistic", "df"),
    }[adjust]()
    out = out.withColumn("p_value", p)
    if confidence is not None:
        level = F.lit(confidence)
        half = {
            "tukey": lambda: dist.q_tukey(level, "used", "df") / F.sqrt(F.lit(2.0)),
            "none": lambda: dist.q_t(level, "df"),
        }[adjust]()
        out = _with_interval(out, "estimate", half)
    return out.drop("used")


def linear_model(
    df: DataFrame, outcome: str, terms: Sequence[str], confidence: float | None = None
) -> DataFrame:
    """Least squares with text terms as treatment contrasts.

    The first level in alphabetical order is the reference. Rows with a missing
    value in a used column are left out. Returns term, estimate, se, statistic,
    p_value, and with a ``confidence`` the ends low and high of the interval; fitting is
    one pass that sums the normal equations on the executors.
    """
    spark = df.sparkSession
    rows = df.select(*[F.col(quoted(c)) for c in (outcome, *terms)]).dropna()
    formula = RFormula(
        formula=f"{outcome} ~ {' + '.join(terms)}",
        stringIndexerOrderType="alphabetDesc",
        featuresCol="_x",
        labelCol="_y",
    )
    ready = formula.fit(rows).transform(rows).select("_x", "_y")
    # No scaling: with the normal solver it changes nothing but rounding.
    model = LinearRegression(
        featuresCol="_x", labelCol="_y", solver="normal", standardization=False
    ).fit(ready)
    attrs = ready.schema["_x"].metadata["ml_attr"]["attrs"]
    names = [a["name"] for a in sorted((a for k in attrs.values() for a in k), key=lambda a: a["idx"])]
    info = model.summary
    table = zip(
        [*names, "(Intercept)"],
        [*map(float, model.coefficients), float(model.intercept)],
        map(float, info.coefficientStandardErrors),
        map(float, info.tValues),
        map(float, info.pValues),
    )
    out = spark.createDataFrame(
        list(table), "term string, estimate double, se double, statistic double, p_value double"
    )
    if confidence is None:
        return out
    return _with_interval(out, "estimate", F.lit(dist.t_quantile(confidence, float(info.degreesOfFreedom))))


def group_tests(
    df: DataFrame,
    by: str,
    levels: Sequence[str],
    categorical: Sequence[str] = (),
    continuous: Sequence[str] = (),
    continuous_test: str = "t.test",
    counts: DataFrame | None = None,
) -> DataFrame:
    """One p-value per variable of a grouped table: variable, test, p_value.

    ``counts`` are the level counts of the categorical variables, if known already.
    """
    frames = []
    if categorical:
        coded = categorical_test(df, categorical, by, counts=counts)
        frames.append(coded.select("variable", "test", "p_value"))
    if continuous and continuous_test == "t.test":
        if len(levels) != 2:
            raise ValueError("a t-test needs two groups")
        t = t_test(df, continuous, by, (levels[0], levels[1]))
        frames.append(t.select("variable", F.lit("t-test").alias("test"), "p_value"))
    elif continuous:
        for v in continuous:
            ranked = (
                rank_sum(df, v, by, (levels[0], levels[1]))
                if len(levels) == 2
                else kruskal_wallis(df, v, by, levels)
            )
            name = "rank-sum" if len(levels) == 2 else "kruskal-wallis"
            frames.append(ranked.select("variable", F.lit(name).alias("test"), "p_value"))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
