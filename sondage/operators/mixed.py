"""Random-intercept model over repeated answers of the same record.

Records with the same number of answers share one weight matrix, so per number of
answers a handful of sums is all the likelihood needs. Spark makes those sums; the
one-dimensional search runs on them, a row per distinct number of answers.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.distributions import t_quantile, t_two_sided
from ..functions.nulls import quoted


def answer_sums(
    df: DataFrame, record: str, item: str, value: str, levels: Sequence[str], one_mean: bool = False
) -> DataFrame:
    """Sums over records per number of answers ``m``, with the mean answer of each level.

    Answers are taken as differences from the mean of their level (of all answers with
    ``one_mean``), and the squares inside a record from the record's own mean, so that
    neither a large mean nor records far apart leave large sums to subtract. ``c``, ``d``:
    counts and summed differences from the record's mean by level; ``t``: a record's total.
    """
    y, g = F.col(quoted(value)).cast("double"), F.col(quoted(item))
    rows = df.where(g.isin(list(levels)) & y.isNotNull())
    groups = [F.lit(True)] if one_mean else [g == lv for lv in levels]
    k = range(len(groups))
    means = rows.agg(F.array(*[F.avg(F.when(of, y)) for of in groups]).alias("means"))
    rows = rows.select(F.col(quoted(record)).alias("record"), *[of.alias(f"g{j}") for j, of in enumerate(groups)], y.alias("y"))
    # one row, computed once and handed to every task
    rows = rows.withColumn("means", means.scalar())
    centre = F.coalesce(*[F.when(F.col(f"g{j}"), F.col("means")[j]) for j in k])
    rows = rows.withColumn("y", F.col("y") - centre)
    per_record = rows.groupBy("record").agg(
        *[F.count_if(f"g{j}").cast("double").alias(f"c{j}") for j in k],
        *[F.coalesce(F.sum(F.when(F.col(f"g{j}"), F.col("y"))), F.lit(0.0)).alias(f"s{j}") for j in k],
        F.count(F.lit(1)).alias("m"),
        F.sum("y").alias("t"),
        (F.var_pop("y") * F.count(F.lit(1))).alias("q"),
        F.first("means").alias("means"),
    )
    return per_record.groupBy("m").agg(
        F.count(F.lit(1)).alias("records"),
        F.array(*[F.sum(f"c{j}") for j in k]).alias("c"),
        F.array(*[F.sum(F.col(f"s{j}") - F.col(f"c{j}") * F.col("t") / F.col("m")) for j in k]).alias("d"),
        F.array(*[F.sum(F.col(f"c{j}") * F.col("t")) for j in k]).alias("ct"),
        F.array(*[F.sum(F.col(f"c{i}") * F.col(f"c{j}")) for i in k for j in k]).alias("cc"),
        F.sum("t").alias("t"),
        F.sum(F.col("t") * F.col("t")).alias("tt"),
        F.sum("q").alias("q"),
        F.first("means").alias("means"),
    )


class _Fit:
    """Restricted likelihood from the sums of :func:`answer_sums`.

    The unknowns are the mean of the first level and the other levels' differences from
    it. With ``f = 1 / (1 + m * ratio)`` a record counts by its differences from its own
    mean in full and by that mean with weight ``m * f``; nothing else depends on the
    ratio of the variances, so derivatives need only that of ``f``.
    """

    def __init__(self, sums: pd.DataFrame):
        column = lambda c: np.stack([np.asarray(v, float) for v in sums[c]])
        self.m, self.records = sums["m"].to_numpy(float), sums["records"].to_numpy(float)
        self.n = float((self.m * self.records).sum())
        c, d, ct = column("c"), column("d"), column("ct")
        self.means = np.asarray(sums["means"].iloc[0], float)
        self.p = k = c.shape[1]
        cc = column("cc").reshape(-1, k, k)
        m = self.m[:, None, None]
        # what is inside records, and what the records' means add, per number of answers
        inside = np.zeros((len(c), k, k))
        inside[:, np.arange(k), np.arange(k)] = c
        inside -= cc / m
        inside[:, 0, :] = inside[:, :, 0] = 0
        between = cc / m
        between[:, 0, 1:] = between[:, 1:, 0] = c[:, 1:]
        between[:, 0, 0] = self.m * self.records
        self.inside, self.between = inside.sum(axis=0), between
        d[:, 0] = 0
        self.d, self.bt = d.sum(axis=0), ct / self.m[:, None]
        self.bt[:, 0] = sums["t"].to_numpy(float)
        self.q, self.tt = float(sums["q"].sum()), sums["tt"].to_numpy(float) / self.m

    def _scaled(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        by = 1 / np.sqrt(np.diag(a))
        rest = b * (by if b.ndim == 1 else by[:, None])
        out = np.linalg.solve(a * by[:, None] * by, rest)
        return out * (by if b.ndim == 1 else by[:, None])

    def at(self, lam: float):
        """Precision, estimates and residual square for a variance ratio."""
        f = 1 / (1 + self.m * lam)
        a = self.inside + (f[:, None, None] * self.between).sum(axis=0)
        b = self.d + f @ self.bt
        beta = self._scaled(a, b)
        whole = self.q + float(f @ self.tt)
        # what remains below the rounding of the sums is none
        return a, beta, max(whole - float(b @ beta), 4e-16 * self.n * whole)

    def deviance(self, theta: float, sigma: float) -> float:
        a, _, rss = self.at(theta * theta)
        spread = float((self.records * np.log1p(self.m * theta * theta)).sum())
        return (self.n - self.p) * 2 * np.log(sigma) + spread + np.linalg.slogdet(a)[1] + rss / sigma**2

    def _profile(self, v: float) -> tuple[float, float]:
        """Deviance with the best sigma at the logarithm ``v`` of the ratio, and its derivative."""
        lam = np.exp(v)
        a, beta, rss = self.at(lam)
        f = 1 / (1 + self.m * lam)
        df = -self.m * lam * f * f
        da = (df[:, None, None] * self.between).sum(axis=0)
        drss = float(df @ self.tt) - 2 * float((df @ self.bt) @ beta) + float(beta @ da @ beta)
        value = (self.n - self.p) * np.log(rss) + float((self.records * np.log1p(self.m * lam)).sum()) + np.linalg.slogdet(a)[1]
        slope = (self.n - self.p) * drss / rss + float((self.records * self.m * lam * f).sum()) + np.trace(self._scaled(a, da))
        return value, slope

    def solve(self) -> tuple[float, float]:
        """Theta (ratio of standard deviations) and residual sigma.

        The slope of the deviance over the logarithm of the ratio is followed from one over
        a million times the number of answers up to where it stays positive for good, so no
        ratio is too large, and its root is bisected.
        """
        step, v = 0.5, -np.log(1e6 * self.m.max())
        grid = []
        while len(grid) < 2000:
            grid.append((v, *self._profile(v)))
            # no spread inside records leaves the ratio without an end
            if v > 5 and grid[-1][2] > 0 and grid[-2][2] > 0:
                break
            v += step
        best = min(range(len(grid)), key=lambda i: grid[i][1])
        low, high = grid[max(0, best - 1)][0], grid[min(len(grid) - 1, best + 1)][0]
        for _ in range(100):
            middle = (low + high) / 2
            if middle in (low, high):
                break
            low, high = (low, middle) if self._profile(middle)[1] > 0 else (middle, high)
        none = self.at(0.0)
        at_zero = (self.n - self.p) * np.log(none[2]) + np.linalg.slogdet(none[0])[1]
        theta = float(np.exp((low + high) / 4)) if self._profile((low + high) / 2)[0] < at_zero and best else 0.0
        return theta, float(np.sqrt(self.at(theta**2)[2] / (self.n - self.p)))

    def weights_of(self, levels: np.ndarray) -> np.ndarray:
        """Weights of level means as weights of the unknowns."""
        out = levels.astype(float).copy()
        out[0] = levels.sum()
        return out

    def estimate(self, theta: float, levels: np.ndarray) -> float:
        """A weighted sum of level means."""
        return float(self.weights_of(levels) @ self.at(theta * theta)[1] + levels @ self.means)

    def contrast_variance(self, theta: float, sigma: float, weights: np.ndarray) -> float:
        return float(sigma**2 * weights @ self._scaled(self.at(theta * theta)[0], weights))

    def freedom(self, theta: float, sigma: float, weights: np.ndarray) -> float:
        """Satterthwaite degrees of freedom from numerical derivatives."""
        at = np.array([theta, sigma])
        step = np.array([1e-3 * max(theta, 0.1), 1e-3 * sigma])

        def slope(f, i, h):
            e = np.zeros(2)
            e[i] = h
            return (f(*(at + e)) - f(*(at - e))) / (2 * h)

        def curve(f, i, j, h):
            ei, ej = np.zeros(2), np.zeros(2)
            ei[i], ej[j] = h[i], h[j]
            if i == j:
                return (f(*(at + ei)) - 2 * f(*at) + f(*(at - ei))) / h[i] ** 2
            corners = f(*(at + ei + ej)) - f(*(at + ei - ej)) - f(*(at - ei + ej)) + f(*(at - ei - ej))
            return corners / (4 * h[i] * h[j])

        def better(calc, h):  # one Richardson step
            return (4 * calc(h / 2) - calc(h)) / 3

        var = lambda th, s: self.contrast_variance(th, s, weights)
        grad = np.array([better(lambda h, i=i: slope(var, i, h), step[i]) for i in range(2)])
        hess = np.array(
            [
                [better(lambda h, i=i, j=j: curve(self.deviance, i, j, h), step) for j in range(2)]
                for i in range(2)
            ]
        )
        unit = step / step.max() if theta == 0 else np.array([theta, sigma])  # both of a size, however far apart
        size, axes = np.linalg.eigh((hess + hess.T) / 2 * np.outer(unit, unit))
        keep = size > 1e-8 * max(size.max(), 1e-300)
        cov = 2 * (axes[:, keep] / size[keep]) @ axes[:, keep].T * np.outer(unit, unit)
        denom = float(grad @ cov @ grad)
        return 2 * var(theta, sigma) ** 2 / denom if denom > 0 else float("inf")


_FIT = " var_record double, var_residual double, n_records long, n_answers long"
_CONTRAST = (
    "contrast string, estimate double, se double, df double, statistic double, p_value double," + _FIT
)
_MEAN = "level string, mean double, se double, df double, low double, high double," + _FIT


def _fitted(sums: DataFrame, schema: str, rows_of: Callable[[_Fit, float, float], list[tuple]]) -> DataFrame:
    """Rows made of one fit; no answers, no rows, and no spread to estimate, null statistics."""
    names = [c.split()[0] for c in schema.split(",")]

    def fit(some: pd.DataFrame) -> pd.DataFrame:
        model = _Fit(some.sort_values("m"))
        if model.n <= model.p or (np.diag(model.between.sum(axis=0)) == 0).any() or model.q + model.tt.sum() == 0:
            return pd.DataFrame([], columns=names)
        theta, sigma = model.solve()
        tail = ((theta * sigma) ** 2, sigma**2, int(model.records.sum()), int(model.n))
        return pd.DataFrame([(*r, *tail) for r in rows_of(model, theta, sigma)], columns=names)

    return sums.groupBy(F.lit("all")).applyInPandas(fit, schema)


def random_intercept_contrasts(
    df: DataFrame, record: str, item: str, value: str, levels: Sequence[str]
) -> DataFrame:
    """``value ~ item + (1 | record)`` by restricted likelihood; all differences of
    item means with Satterthwaite degrees of freedom. A zero record variance is a
    valid fit. Null answers and other items are left out; no rows where a level has no
    answer, where there are no more answers than levels or where no answer differs from
    the mean of its level."""
    names = list(levels)

    def rows_of(model: _Fit, theta: float, sigma: float) -> list[tuple]:
        rows = []
        for i, j in itertools.combinations(range(len(names)), 2):
            w = np.zeros(len(names))
            w[i], w[j] = 1, -1
            estimate, weights = model.estimate(theta, w), model.weights_of(w)
            se = float(np.sqrt(model.contrast_variance(theta, sigma, weights)))
            df_ = model.freedom(theta, sigma, weights)
            rows.append((f"{names[i]} - {names[j]}", estimate, se, df_, estimate / se, t_two_sided(estimate / se, df_)))
        return rows

    return _fitted(answer_sums(df, record, item, value, names), _CONTRAST, rows_of)


def random_intercept_means(
    df: DataFrame, record: str, item: str, value: str, levels: Sequence[str], confidence: float = 0.95
) -> DataFrame:
    """Estimated mean of each level in the same model, with its confidence interval."""
    names = list(levels)

    def rows_of(model: _Fit, theta: float, sigma: float) -> list[tuple]:
        rows = []
        for i, name in enumerate(names):
            w = np.eye(len(names))[i]
            mean, weights = model.estimate(theta, w), model.weights_of(w)
            se = float(np.sqrt(model.contrast_variance(theta, sigma, weights)))
            df_ = model.freedom(theta, sigma, weights)
            half = se * t_quantile(confidence, df_)
            rows.append((name, mean, se, df_, mean - half, mean + half))
        return rows

    return _fitted(answer_sums(df, record, item, value, names), _MEAN, rows_of)


def intraclass_correlation(
    df: DataFrame, record: str, item: str, value: str, levels: Sequence[str]
) -> DataFrame:
    """Share of the variance of ``value ~ 1 + (1 | record)`` that lies between records."""
    def rows_of(model: _Fit, theta: float, sigma: float) -> list[tuple]:
        return [(theta**2 / (1 + theta**2),)]

    sums = answer_sums(df, record, item, value, list(levels), one_mean=True)
    return _fitted(sums, "icc double," + _FIT, rows_of)
