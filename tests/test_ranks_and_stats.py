"""Order statistics and tests against direct computation."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sondage.functions import distributions as dist
from sondage.operators import mixed, ranks, stats
from tests.conftest import rows


def average_ranks(xs):
    order = sorted(xs)
    return [sum(i + 1 for i, y in enumerate(order) if y == x) / order.count(x) for x in xs]


@pytest.fixture
def skewed(frame):
    rng = random.Random(3)
    data = [("a", round(rng.lognormvariate(0, 2), 2)) for _ in range(300)]
    data += [("b", float(rng.randint(1, 5))) for _ in range(200)] + [("b", 3.0)] * 200
    data += [("c", 1.0), ("c", None), (None, 2.0), (None, 2.0)]
    return data, frame("g string, v double", *data)


@pytest.mark.parametrize("options", [{"slices": 16}, {"slices": 3}, {"few_values": True}])
def test_ranks_match_brute_force(skewed, options):
    data, df = skewed
    got = ranks.with_ranks(df, "v", ["g"], **options).collect()
    for g in ("a", "b", "c", None):
        xs = [v for k, v in data if k == g and v is not None]
        mine = sorted((r["v"], r["rank"]) for r in got if r["g"] == g and r["v"] is not None)
        assert mine == sorted(zip(xs, average_ranks(xs)))
    assert [r["rank"] for r in got if r["v"] is None] == [None]


@pytest.mark.parametrize("options", [{"slices": 16}, {"few_values": True}])
def test_percentiles_match_definitions(skewed, options):
    data, df = skewed
    probs = {f"q{i}": i / 20 for i in range(21)}
    for kind in (2, 7):
        got = {r["g"]: r for r in ranks.percentiles(df, "v", probs, ["g"], kind, **options).collect()}
        for g in ("a", "b", "c", None):
            xs = np.array([v for k, v in data if k == g and v is not None])
            method = {2: "averaged_inverted_cdf", 7: "linear"}[kind]
            want = [np.quantile(xs, p, method=method) for p in probs.values()]
            assert [got[g][n] for n in probs] == pytest.approx(want)


def test_percentiles_of_nothing(frame):
    df = frame("v double", (None,))
    assert ranks.percentiles(df, "v", {"m": 0.5}).first()["m"] is None


def test_tails_against_known_values():
    assert dist.t_two_sided(2.228139, 10) == pytest.approx(0.05, abs=1e-6)
    assert dist.t_two_sided(12.706205, 1) == pytest.approx(0.05, abs=1e-6)
    assert dist.chi2_tail(3.841459, 1) == pytest.approx(0.05, abs=1e-6)
    assert dist.chi2_tail(18.307038, 10) == pytest.approx(0.05, abs=1e-6)
    assert dist.f_tail(4.102821, 2, 10) == pytest.approx(0.05, abs=1e-6)
    assert dist.normal_two_sided(1.959964) == pytest.approx(0.05, abs=1e-6)
    assert dist.t_two_sided(1.5, 1e6) == pytest.approx(math.erfc(1.5 / math.sqrt(2)), abs=1e-6)


@pytest.mark.parametrize(
    "q, k, df", [(3.877, 3, 10), (3.958, 4, 20), (3.314, 3, 1e6), (5.218, 4, 5)]
)
def test_studentised_range_against_tables(q, k, df):
    assert dist.tukey_tail(q, k, df) == pytest.approx(0.05, abs=2e-4)


def test_studentised_range_of_two_groups_is_a_t_test():
    for t, df in ((0.7, 4), (2.1, 9), (3.3, 60)):
        assert dist.tukey_tail(t * math.sqrt(2), 2, df) == pytest.approx(dist.t_two_sided(t, df), abs=1e-6)


def brute_fisher(table):
    """All tables with the same margins, by plain recursion."""
    r, c = table.sum(axis=1), table.sum(axis=0)

    def tables(rows_left, room):
        if len(rows_left) == 1:
            yield [tuple(room)]
            return
        def fill(total, caps):
            if len(caps) == 1:
                if total <= caps[0]:
                    yield (total,)
                return
            for x in range(min(total, caps[0]) + 1):
                for rest in fill(total - x, caps[1:]):
                    yield (x, *rest)
        for row in fill(rows_left[0], room):
            for rest in tables(rows_left[1:], [a - b for a, b in zip(room, row)]):
                yield [row, *rest]

    def weight(t):
        w = 1.0
        for row in t:
            for x in row:
                w /= math.factorial(x)
        return w

    all_w = [weight(t) for t in tables(list(map(int, r)), list(map(int, c)))]
    seen = weight(table.tolist())
    return sum(w for w in all_w if w <= seen * (1 + 1e-7)) / sum(all_w)


@pytest.mark.parametrize(
    "table", [[[3, 1], [1, 4]], [[3, 0, 2], [1, 4, 1]], [[2, 1, 0], [0, 3, 1], [1, 0, 2]]]
)
def test_fisher_enumeration(table):
    t = np.array(table)
    want = brute_fisher(t)
    assert dist.fisher_table(t) == pytest.approx(want)
    if t.shape == (2, 2):
        assert dist.fisher_two_by_two(*t.ravel()) == pytest.approx(want)
    assert dist.fisher_table(t, max_states=2) is None


def test_fisher_of_many_cells_rows_and_states(frame):
    """No size of a table changes the test; the expected count decides alone."""
    for t in ([[3, 0, 2, 1], [1, 4, 1, 2], [0, 1, 3, 1]], [[9, 1, 0], [1, 8, 1], [0, 0, 7]]):
        want = brute_fisher(np.array(t))
        assert dist.fisher_table(np.array(t)) == pytest.approx(want)
        assert dist.fisher_table(np.array(t), block=5) == pytest.approx(want)

    def two_rows(t):
        """Every table of 2 x 3 by its two free counts."""
        (r1, _), c = map(int, t.sum(axis=1)), [int(v) for v in t.sum(axis=0)]
        log = lambda x: math.lgamma(x + 1)
        one = lambda x, k: -log(x) - log(c[k] - x)
        all_p = [one(r1 - b - d, 0) + one(b, 1) + one(d, 2) for b in range(c[1] + 1) for d in range(c[2] + 1) if 0 <= r1 - b - d <= c[0]]
        seen, top = sum(one(int(v), k) for k, v in enumerate(t[0])), max(all_p)
        return sum(math.exp(p - top) for p in all_p if p <= seen + 1e-7) / sum(math.exp(p - top) for p in all_p)

    table = np.array([[2500, 30, 9], [2450, 41, 1]])
    assert table.sum() > 5000
    want = two_rows(table)
    assert dist.fisher_table(table) == pytest.approx(want)
    rows = [("ab"[i], "xyz"[j]) for (i, j), n in np.ndenumerate(table) for _ in range(n)]
    got = stats.categorical_test(frame("g string, v string", *rows), ["v"], "g").first()
    assert (got["test"], got["p_value"]) == ("fisher", pytest.approx(want))

    # 2 x 40 is more than 64 cells: each level once, so every table is as likely.
    rows = [("ab"[k % 2], f"l{k}") for k in range(40)]
    got = stats.categorical_test(frame("g string, v string", *rows), ["v"], "g").first()
    assert (got["test"], got["p_value"]) == ("fisher", pytest.approx(1.0))


def test_tails_at_any_number_of_rows():
    """Against the limits and their first correction in 1 / df."""
    normal = math.erfc(1.96 / math.sqrt(2))
    density = math.exp(-(1.96**2) / 2) / math.sqrt(2 * math.pi)
    for df in (1e6, 1e9, 1e12, 1e13):
        first = density * (1.96**3 + 1.96) / (2 * df)
        assert dist.t_two_sided(1.96, df) == pytest.approx(normal + first, rel=1e-9)
        assert dist.f_tail(3.0, 2, df) == pytest.approx((1 + 6 / df) ** (-df / 2) if df < 1e9 else math.exp(-3 + 9 / df), rel=1e-9)
    # Both ways of computing agree where one takes over from the other.
    for stat in (0.3, 1.96, 8.0):
        assert dist.t_two_sided(stat, 1e6 - 1) == pytest.approx(dist.t_two_sided(stat, 1e6), rel=1e-4)


def test_exact_two_by_two_of_large_counts():
    assert dist.fisher_two_by_two(10**9, 10**9, 10**9, 10**9) == pytest.approx(1.0)
    n, z = 10**8, 2.0
    move = int(z * math.sqrt(n) / 2)
    p = dist.fisher_two_by_two(n + move, n - move, n - move, n + move)
    assert p == pytest.approx(math.erfc(z / math.sqrt(2)), rel=1e-3)


@pytest.mark.parametrize(
    "table",
    [[[3, 1, 4], [1, 5, 9]], [[0, 7, 2, 2], [9, 1, 3, 4]], [[1, 1, 1, 1], [30, 2, 5, 9]], [[5, 0, 0, 6], [0, 5, 6, 0]], [[2, 2, 2, 1, 0], [1, 1, 4, 0, 3]]],
)
def test_fisher_of_two_rows_closes_the_last_columns_at_once(table):
    table = np.array(table)
    want = brute_fisher(table)
    for block in (3, 500_000):
        assert dist.fisher_table(table, block=block) == pytest.approx(want, rel=1e-9)
        assert dist.fisher_table(table[::-1, ::-1], block=block) == pytest.approx(want, rel=1e-9)


def brute_rank_sum(a, b):
    """Share of all draws whose mean rank is at least as far from the middle as the one seen."""
    values = np.array([*a, *b], dtype=float)
    rank = np.array([(values < v).sum() + ((values == v).sum() + 1) / 2 for v in values])
    middle = rank.mean() * len(a)
    far = [abs(rank[list(d)].sum() - middle) for d in itertools.combinations(range(len(values)), len(a))]
    return np.mean(np.array(far) >= abs(rank[: len(a)].sum() - middle) - 1e-9)


@pytest.mark.parametrize(
    "a, b",
    [
        ([1, 2, 2, 3], [2, 3, 3, 4, 5]),
        ([5, 5, 5], [5, 5]),
        ([1], [1, 2, 2, 2, 7]),
        ([1.5, 1.5, 9, 9, 9, 10], [0, 1.5]),
        ([1, 4, 6], [2, 3, 5, 7]),
        ([-3, -3, 0, 0, 0, 8], [-3, 0, 8, 8, 8, 8, 8]),
    ],
)
def test_exact_rank_sum_of_tied_scores(frame, a, b):
    df = frame("g string, v double", *[("a", float(v)) for v in a], *[("b", float(v)) for v in b], ("c", 1.0), ("a", None))
    want = brute_rank_sum(a, b)
    assert stats.rank_sum(df, "v", "g", ("a", "b"), exact=True).first()["p_value"] == pytest.approx(want)
    assert stats.rank_sum(df, "v", "g", ("b", "a"), exact=True).first()["p_value"] == pytest.approx(want)


def test_exact_rank_sum_of_larger_samples(frame):
    n1, n2 = 30, 70
    w = 700
    below, size = np.arange(n1 + n2), np.ones(n1 + n2, dtype=int)
    assert dist.rank_sum_tied(w, n1, below, size) == pytest.approx(dist.rank_sum_exact(w, n1, n2), rel=1e-9)
    assert dist.rank_sum_tied(n1 * n2 - w, n2, below, size) == pytest.approx(dist.rank_sum_exact(w, n1, n2), rel=1e-9)
    empty = frame("g string, v double", ("a", 1.0), ("a", None))
    assert stats.rank_sum(empty, "v", "g", ("a", "b"), exact=True).first()["p_value"] is None
    plain = frame("g string, v double", ("a", 1.0), ("a", 2.0), ("b", 3.0))
    assert stats.rank_sum(plain, "v", "g", ("a", "b"), exact=False).first()["p_value"] == pytest.approx(dist.normal_two_sided(-0.5 / np.sqrt(2 / 12 * 4)))


def test_rank_sum_exact_small():
    # Complete separation of 3 and 3: two of twenty arrangements are as extreme.
    assert dist.rank_sum_exact(0, 3, 3) == pytest.approx(0.1)
    assert dist.rank_sum_exact(9, 3, 3) == pytest.approx(0.1)


def expand(counts):
    return [(g, lv) for (g, lv), n in counts.items() for _ in range(n)]


def test_categorical_test_picks_by_expected_count(frame):
    big = expand({("a", "x"): 30, ("a", "y"): 20, ("b", "x"): 25, ("b", "y"): 25})
    df = frame("g string, v string", *big, ("a", None), (None, "x"))
    got = stats.categorical_test(df, ["v"], "g").first()
    assert (got["test"], got["n"]) == ("chi-square", 100)
    assert got["statistic"] == pytest.approx(1.0101, abs=1e-4)
    small = frame("g string, v string", *expand({("a", "x"): 3, ("a", "y"): 1, ("b", "x"): 1, ("b", "y"): 4}))
    got = stats.categorical_test(small, ["v"], "g").first()
    assert got["test"] == "fisher"
    assert got["p_value"] == pytest.approx(brute_fisher(np.array([[3, 1], [1, 4]])))


def test_empty_cell_counts_in_chi_square(frame):
    df = frame("g string, v string", *expand({("a", "x"): 10, ("b", "x"): 10, ("b", "y"): 20}))
    got = stats.chi_square(df, ["v"], "g").first()
    assert got["statistic"] == pytest.approx(40 * (10 * 20 - 0) ** 2 / (20 * 20 * 10 * 30))


def test_t_test_equals_two_group_anova(frame):
    rng = random.Random(1)
    data = [("a", rng.gauss(0, 1)) for _ in range(20)] + [("b", rng.gauss(1, 1)) for _ in range(15)]
    df = frame("g string, v double", *data, ("a", None), (None, 1.0))
    t = stats.t_test(df, ["v"], "g", ("a", "b")).first()
    f = stats.anova(df, "v", "g").first()
    assert t["statistic"] ** 2 == pytest.approx(f["statistic"])
    assert t["p_value"] == pytest.approx(f["p_value"])
    pair = stats.pairwise_contrasts(df, "v", "g", ["a", "b"]).first()
    assert pair["p_value"] == pytest.approx(t["p_value"], abs=1e-6)


def test_rank_tests_on_small_samples(frame):
    df = frame("g string, v double", ("a", 1.0), ("a", 2.0), ("a", 3.0), ("b", 4.0), ("b", 5.0), ("b", 6.0))
    got = stats.rank_sum(df, "v", "g", ("a", "b")).first()
    assert (got["statistic"], got["p_value"]) == (0.0, pytest.approx(0.1))
    h = stats.kruskal_wallis(df, "v", "g", ["a", "b"], few_values=True).first()
    assert h["statistic"] == pytest.approx(27 / 7)


def test_linear_model_matches_least_squares(frame):
    rng = random.Random(5)
    data = [(rng.choice("pqr"), rng.choice("uv"), rng.random(), rng.gauss(0, 1)) for _ in range(120)]
    df = frame("f string, h string, x double, y double", *data, (None, "u", 1.0, 1.0))
    got = {r["term"]: r for r in stats.linear_model(df, "y", ["f", "h", "x"]).collect()}
    x = np.array([[1, f == "q", f == "r", h == "v", v] for f, h, v, _ in data], dtype=float)
    y = np.array([d[3] for d in data])
    beta = np.linalg.solve(x.T @ x, x.T @ y)
    s2 = ((y - x @ beta) ** 2).sum() / (len(y) - 5)
    se = np.sqrt(s2 * np.diag(np.linalg.inv(x.T @ x)))
    for i, term in enumerate(["(Intercept)", "f_q", "f_r", "h_v", "x"]):
        assert got[term]["estimate"] == pytest.approx(beta[i])
        assert got[term]["se"] == pytest.approx(se[i])
        assert got[term]["p_value"] == pytest.approx(dist.t_two_sided(beta[i] / se[i], len(y) - 5))


def dense_reml(data, levels):
    """Restricted likelihood with full covariance matrices, on a fine grid."""
    ids = sorted({d[0] for d in data})
    y = np.array([d[2] for d in data])
    x = np.array([[d[1] == lv for lv in levels] for d in data], dtype=float)
    z = np.array([[d[0] == i for i in ids] for d in data], dtype=float)
    n, p = x.shape

    def at(lam):
        v = np.eye(n) + lam * z @ z.T
        vi = np.linalg.inv(v)
        a = x.T @ vi @ x
        beta = np.linalg.solve(a, x.T @ vi @ y)
        r = y - x @ beta
        s2 = r @ vi @ r / (n - p)
        dev = (n - p) * np.log(s2) + np.linalg.slogdet(v)[1] + np.linalg.slogdet(a)[1]
        return dev, beta, s2, a

    low, high = 0.0, 10.0
    for _ in range(6):
        grid = np.linspace(low, high, 61)
        best = int(np.argmin([at(g)[0] for g in grid]))
        low, high = grid[max(0, best - 1)], grid[min(60, best + 1)]
    lam = (low + high) / 2
    return lam, at(lam)


def test_random_intercept_matches_dense_likelihood(frame):
    rng = random.Random(11)
    data = []
    for i in range(40):
        level = rng.gauss(0, 1)
        for lv, shift in (("mdc", 0.0), ("pcc", 0.5)):
            if rng.random() < 0.8:
                data.append((i, lv, level + shift + rng.gauss(0, 0.7)))
    df = frame("r int, item string, v double", *data, (99, "mdc", None), (98, "other", 1.0))
    got = mixed.random_intercept_contrasts(df, "r", "item", "v", ["mdc", "pcc"]).first()
    lam, (_, beta, s2, a) = dense_reml(data, ["mdc", "pcc"])
    w = np.array([1.0, -1.0])
    assert got["estimate"] == pytest.approx(w @ beta, abs=1e-4)
    assert got["se"] == pytest.approx(math.sqrt(s2 * w @ np.linalg.solve(a, w)), abs=1e-4)
    assert got["var_residual"] == pytest.approx(s2, rel=1e-3)
    assert got["var_record"] == pytest.approx(lam * s2, rel=1e-3)
    assert 10 < got["df"] < len(data)


def test_singular_fit_is_the_pooled_comparison(frame):
    # Within-record differences far larger than between: no record variance is left.
    data = [(i, lv, (1 if (i + k) % 2 else -1) * 1.0 + 0.1 * k) for i in range(10) for k, lv in enumerate("ab")]
    df = frame("r int, item string, v double", *data)
    got = mixed.random_intercept_contrasts(df, "r", "item", "v", ["a", "b"]).first()
    assert got["var_record"] == 0.0
    assert got["df"] == pytest.approx(18, abs=1e-3)


def test_statistics_ignore_row_order(frame):
    data = [("a", float(i % 7)) for i in range(50)] + [("b", float(i % 5)) for i in range(40)]
    one = frame("g string, v double", *data)
    two = frame("g string, v double", *reversed(data)).repartition(3)
    for run in (
        lambda d: stats.rank_sum(d, "v", "g", ("a", "b")),
        lambda d: ranks.deciles(d, "v").select(*[F.round(c, 9) for c in ["p10", "p50", "p90"]]),
    ):
        assert rows(run(one)) == rows(run(two))


def test_intraclass_correlation_of_unbalanced_records(frame):
    """Against the dense likelihood on a grid; records with one answer count."""
    answers = {1: [3.0, 4.0, 3.5], 2: [8.0], 3: [6.0, 7.5], 4: [1.0, 2.0, 1.5, 2.5], 5: [5.0], 6: [9.0, 8.0]}
    rows = [(r, "ab"[k % 2], y) for r, ys in answers.items() for k, y in enumerate(ys)]
    got = mixed.intraclass_correlation(frame("r int, g string, y double", *rows), "r", "g", "y", ["a", "b"]).first()
    y = np.array([v for ys in answers.values() for v in ys])
    who = np.repeat(list(answers), [len(v) for v in answers.values()])
    same, n = (who[:, None] == who[None, :]).astype(float), len(y)

    def minus_twice_log(share):
        v = share * same + (1 - share) * np.eye(n)
        inv, one = np.linalg.inv(v), np.ones(n)
        rest = y - (one @ inv @ y) / (one @ inv @ one)
        return np.linalg.slogdet(v)[1] + np.log(one @ inv @ one) + (n - 1) * np.log(rest @ inv @ rest)

    grid = np.linspace(0, 0.9999, 10_001)
    want = grid[int(np.argmin([minus_twice_log(s) for s in grid]))]
    assert (got["n_records"], got["n_answers"]) == (6, 13)
    assert got["icc"] == pytest.approx(want, abs=2e-4)


@pytest.mark.parametrize("mean, apart", [(0.0, 1.0), (1e9, 1.0), (-3e7, 0.02), (5.0, 300.0), (1e6, 1e5)])
def test_random_intercept_at_any_mean_and_ratio(frame, mean, apart):
    """The fit of answers moved far away, or of records far apart, is that of a dense likelihood on plain ones."""
    rng = np.random.default_rng(3)
    level, noise = rng.normal(size=40), rng.normal(size=(40, 3))
    data, plain = [], []
    for i in range(40):
        for k in range(1 + i % 3):
            z = round(float(apart * level[i] + (0.5 if k == 1 else 0) + noise[i, k]), 6)
            data.append((i, "ab"[k % 2], mean + (1000.0 if k % 2 else 0.0) + z))
            plain.append((i, "ab"[k % 2], z))
    df = frame("r int, item string, v double", *data)
    got = mixed.random_intercept_contrasts(df, "r", "item", "v", ["a", "b"]).first()
    ys = np.array([y for *_, y in plain])
    who, item = np.array([i for i, *_ in plain]), np.array([g for _, g, _ in plain])
    x = np.stack([np.ones(len(ys)), item == "b"], 1).astype(float)
    same = (who[:, None] == who[None, :]).astype(float)

    def at(v):
        inv = np.linalg.inv(np.eye(len(ys)) + np.exp(v) * same)
        a = x.T @ inv @ x
        beta = np.linalg.solve(a, x.T @ inv @ ys)
        rest = ys - x @ beta
        s2 = rest @ inv @ rest / (len(ys) - 2)
        return (len(ys) - 2) * np.log(s2) - np.linalg.slogdet(inv)[1] + np.linalg.slogdet(a)[1], beta, s2, a

    low, high = -25.0, 28.0
    for _ in range(9):
        grid = np.linspace(low, high, 15)
        best = int(np.argmin([at(v)[0] for v in grid]))
        low, high = grid[max(0, best - 1)], grid[min(14, best + 1)]
    _, beta, s2, a = at((low + high) / 2)
    ratio = np.exp((low + high) / 2)
    assert got["estimate"] == pytest.approx(-beta[1] - 1000, abs=2e-5 * max(1, abs(mean) / 1e8))
    assert got["se"] == pytest.approx(math.sqrt(s2 * np.linalg.inv(a)[1, 1]), rel=2e-4)
    assert got["var_residual"] == pytest.approx(s2, rel=1e-3)
    if ratio > 1e-4:
        assert got["var_record"] == pytest.approx(ratio * s2, rel=5e-3)


def test_random_intercept_without_anything_to_fit(frame):
    schema = "r int, item string, v double"
    for data in ([(1, "a", None)], [(1, "a", 1.0), (1, "b", 2.0)], [(1, "a", 1.0), (2, "a", 2.0)], [(k, "ab"[k % 2], float(k % 2)) for k in range(9)]):
        df = frame(schema, *data)
        assert mixed.random_intercept_contrasts(df, "r", "item", "v", ["a", "b"]).count() == 0
        assert mixed.random_intercept_means(df, "r", "item", "v", ["a", "b"]).count() == 0


def test_quantiles_invert_the_tails():
    for df in (1, 3.5, 30, 4000):
        for confidence in (0.5, 0.95, 0.999):
            assert dist.t_two_sided(dist.t_quantile(confidence, df), df) == pytest.approx(1 - confidence, rel=1e-6)
    assert dist.t_quantile(0.95, 10) == pytest.approx(2.228139, abs=1e-6)
    assert dist.tukey_quantile(0.95, 3, 20) == pytest.approx(3.578, abs=1e-3)


def test_intervals_hold_what_the_p_values_say(frame):
    rng = random.Random(8)
    df = frame("v double, g string", *[(rng.gauss("abc".index(g) * 0.6, 1), g) for g in "abc" for _ in range(25)])
    for adjust in ("tukey", "none"):
        for r in stats.pairwise_contrasts(df, "v", "g", ["a", "b", "c"], adjust, confidence=0.95).collect():
            assert (r["p_value"] < 0.05) == (not r["low"] <= 0 <= r["high"])
    plain = {r["contrast"]: r for r in stats.pairwise_contrasts(df, "v", "g", ["a", "b"], "none", confidence=0.9).collect()}
    adjusted = {r["contrast"]: r for r in stats.pairwise_contrasts(df, "v", "g", ["a", "b"], confidence=0.9).collect()}
    # two levels: one pair, so nothing to adjust for
    assert plain["a - b"]["low"] == pytest.approx(adjusted["a - b"]["low"], rel=1e-6)
    means = stats.marginal_means(df, "v", "g", ["a", "b", "c"], confidence=0.95).collect()
    assert all(r["low"] < r["mean"] < r["high"] for r in means)
    fit = {r["term"]: r for r in stats.linear_model(df, "v", ["g"], confidence=0.95).collect()}
    pair = stats.pairwise_contrasts(df, "v", "g", ["b", "a", "c"], "none", confidence=0.95).first()
    assert fit["g_b"]["low"] == pytest.approx(pair["low"], rel=1e-6)
