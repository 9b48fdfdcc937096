"""Statistical tests and models.

The checks work out tail probabilities from finite series, which exist for whole
degrees of freedom.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixed_values as fixed
from ..operators import mixed, stats
from ..plans import patient, records, report
from .registry import query
from .scores import DOMAINS_CTE, person_domains
from .standins import cte, pick, table, view, visits, visits_cte
from .summaries import REPORT, report_check, rounded

PI = "3.141592653589793"


def erfc_sql(x: str) -> str:
    """Complementary error function of a number from 0 to about 5, by its series."""
    term = (
        f"EXP(2 * i * LN(2) + LGAMMA(i + 1) - LGAMMA(2 * i + 2) + (2 * i + 1) * LN(GREATEST({x}, 1e-12)))"
    )
    return f"(1 - 2 / SQRT({PI}) * EXP(-({x}) * ({x})) * LIST_SUM([{term} FOR i IN RANGE(0, 120)]))"


def chi2_sql(x: str, df: int) -> str:
    if df == 1:
        return erfc_sql(f"SQRT({x} / 2)")
    terms = " + ".join(f"POW({x} / 2, {i}) / {_factorial(i)}" for i in range(df // 2))
    return f"(EXP(-({x}) / 2) * ({terms}))"


def _factorial(i: int) -> int:
    return 1 if i < 2 else i * _factorial(i - 1)


def t_sql(t: str, df: str) -> str:
    """Two-sided p of a t value with whole degrees of freedom."""
    angle = f"ATAN(ABS({t}) / SQRT({df}))"
    half = f"CAST({df} AS BIGINT)"
    even_term = (
        f"EXP(LGAMMA(2 * j + 1) - 2 * j * LN(2) - 2 * LGAMMA(j + 1) + 2 * j * LN(COS({angle})))"
    )
    even = f"SIN({angle}) * LIST_SUM([{even_term} FOR j IN RANGE(0, {half} // 2)])"
    odd_term = (
        f"EXP(2 * j * LN(2) + 2 * LGAMMA(j + 1) - LGAMMA(2 * j + 2) + (2 * j + 1) * LN(COS({angle})))"
    )
    odd = (
        f"2 / {PI} * ({angle} + SIN({angle}) * "
        f"LIST_SUM([{odd_term} FOR j IN RANGE(0, ({half} - 1) // 2)]))"
    )
    return f"(1 - CASE WHEN CAST({df} AS BIGINT) % 2 = 0 THEN {even} ELSE {odd} END)"


def chi_parts(source: str, variable: str, by: str) -> str:
    """One row with the chi-square statistic of a table."""
    return f"""SELECT '{variable}' AS variable, CAST(SUM(o) AS BIGINT) AS n, SUM((o - e) * (o - e) / e) AS x,
      CAST((COUNT(DISTINCT r) - 1) * (COUNT(DISTINCT c) - 1) AS DOUBLE) AS df, MIN(e) AS min_expected FROM (
      SELECT a.r, b.c, COALESCE(o, 0) AS o, a.n * b.n / CAST((SELECT COUNT(*) FROM {source} WHERE {variable}
        IS NOT NULL AND {by} IS NOT NULL) AS DOUBLE) AS e
      FROM (SELECT {variable} AS r, COUNT(*) AS n FROM {source} WHERE {variable} IS NOT NULL AND {by} IS NOT NULL
        GROUP BY 1) a
      CROSS JOIN (SELECT {by} AS c, COUNT(*) AS n FROM {source} WHERE {variable} IS NOT NULL AND {by} IS NOT NULL
        GROUP BY 1) b
      LEFT JOIN (SELECT {variable} AS r, {by} AS c, COUNT(*) AS o FROM {source} GROUP BY ALL) t
        ON t.r = a.r AND t.c = b.c)"""


_T = """SELECT COUNT(*) FILTER (g = '{a}') AS n1, COUNT(*) FILTER (g = '{b}') AS n2,
  AVG(v) FILTER (g = '{a}') AS mean1, AVG(v) FILTER (g = '{b}') AS mean2,
  VAR_SAMP(v) FILTER (g = '{a}') AS v1, VAR_SAMP(v) FILTER (g = '{b}') AS v2 FROM {t} WHERE v IS NOT NULL"""
_T_REST = """mean1 - mean2 AS difference, CAST(n1 + n2 - 2 AS DOUBLE) AS df,
  SQRT(((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2) * (1 / n1 + 1 / n2)) AS se"""


@query(
    "two_sample_t_test",
    f"""WITH o AS (SELECT o_orderstatus AS g, o_totalprice AS v FROM orders),
      m AS ({_T.format(a='F', b='O', t='o')}), s AS (SELECT *, {_T_REST} FROM m)
    SELECT 'o_totalprice' AS variable, n1, n2, ROUND(mean1, 3) AS mean1, ROUND(mean2, 3) AS mean2,
      ROUND(difference, 3) AS difference, ROUND(se, 3) AS se, df, ROUND(difference / se, 6) AS statistic,
      ROUND({t_sql('difference / se', 'df')}, 6) AS p_value FROM s""",
)
def two_sample_t_test(spark, sf_dir):
    out = stats.t_test(table(spark, sf_dir, "orders"), ["o_totalprice"], "o_orderstatus", ("F", "O"))
    out = rounded(out, 3, ("mean1", "mean2", "difference", "se"))
    return rounded(out, 6, ("statistic", "p_value"))


@query(
    "chi_square_test",
    f"""WITH x AS ({chi_parts('orders', 'o_orderpriority', 'o_orderstatus')})
    SELECT variable, n, ROUND(x, 6) AS statistic, df, ROUND(min_expected, 4) AS min_expected,
      ROUND({chi2_sql('x', 8)}, 6) AS p_value FROM x""",
)
def chi_square_test(spark, sf_dir):
    out = stats.chi_square(table(spark, sf_dir, "orders"), ["o_orderpriority"], "o_orderstatus")
    out = rounded(out.drop("rows", "cols"), 4, ("min_expected",))
    return rounded(out, 6, ("statistic", "p_value"))


_FISHER = """m AS (SELECT COUNT(*) FILTER (quality = 0 AND toxic = 0) AS a, COUNT(*) FILTER (quality = 0) AS r1,
    COUNT(*) FILTER (quality = 1) AS r2, COUNT(*) FILTER (toxic = 0) AS c1, COUNT(*) AS n FROM labels),
  k AS (SELECT *, UNNEST(RANGE(GREATEST(0, c1 - r2), LEAST(r1, c1) + 1)) AS k FROM m),
  d AS (SELECT a, k, n, LGAMMA(r1 + 1) + LGAMMA(r2 + 1) + LGAMMA(c1 + 1) + LGAMMA(n - c1 + 1) - LGAMMA(n + 1)
      - LGAMMA(k + 1) - LGAMMA(r1 - k + 1) - LGAMMA(c1 - k + 1) - LGAMMA(r2 - c1 + k + 1) AS lp FROM k)"""


@query(
    "fisher_exact_test",
    f"""WITH {_FISHER} SELECT 'quality' AS variable, ANY_VALUE(n) AS n, 'fisher' AS test,
      ROUND(SUM(EXP(lp)) FILTER (lp <= (SELECT lp FROM d WHERE k = a) + 1e-7), 6) AS p_value FROM d""",
)
def fisher_exact_test(spark, sf_dir):
    out = stats.fisher(table(spark, sf_dir, "labels"), ["quality"], "toxic")
    return rounded(out, 6, ("p_value",))


_BY_LANGUAGE = """x AS (SELECT lang, quality, toxic FROM labels JOIN documents USING (doc_id)),
  t AS (SELECT 'quality' AS variable, quality AS v, lang FROM x UNION ALL SELECT 'toxic', toxic, lang FROM x),
  c AS (SELECT variable, lang, COUNT(*) AS c, COUNT(*) FILTER (v = 1) AS o FROM t
    WHERE v IS NOT NULL AND lang IS NOT NULL GROUP BY ALL),
  k AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY variable ORDER BY lang) AS j,
    SUM(c) OVER (PARTITION BY variable ORDER BY lang DESC) - c AS later FROM c),
  m AS (SELECT variable, SUM(c) AS n, SUM(o) AS r, MAX(j) AS cols,
    SUM(LGAMMA(c + 1) - LGAMMA(o + 1) - LGAMMA(c - o + 1)) AS seen FROM k GROUP BY variable),
  f AS (SELECT variable, CAST(0 AS BIGINT) AS j, CAST(r AS BIGINT) AS free, CAST(0 AS DOUBLE) AS lp FROM m
    UNION ALL
    SELECT variable, j, CAST(free - x AS BIGINT), lp + LGAMMA(c + 1) - LGAMMA(x + 1) - LGAMMA(c - x + 1) FROM (
      SELECT f.variable, k.j, f.free, f.lp, k.c,
        UNNEST(RANGE(CAST(GREATEST(0, f.free - k.later) AS BIGINT), CAST(LEAST(f.free, k.c) AS BIGINT) + 1)) AS x
      FROM f JOIN k ON k.variable = f.variable AND k.j = f.j + 1))"""


@query(
    "fisher_exact_test_by_language",
    f"""WITH RECURSIVE {_BY_LANGUAGE} SELECT variable, CAST(ANY_VALUE(n) AS BIGINT) AS n, 'fisher' AS test,
      ROUND(SUM(EXP(lp - LGAMMA(n + 1) + LGAMMA(r + 1) + LGAMMA(n - r + 1))) FILTER (lp <= seen + 1e-7), 6) AS p_value
    FROM f JOIN m USING (variable) WHERE j = cols GROUP BY variable""",
)
def fisher_exact_test_by_language(spark, sf_dir):
    """Tables of 2 x 4, against an enumeration of all tables with their margins."""
    rows = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id")
    return rounded(stats.fisher(rows, ["quality", "toxic"], "lang"), 6, ("p_value",))


@query(
    "categorical_test_by_expected_count",
    f"""WITH {_FISHER}, x AS ({chi_parts('labels', 'quality', 'toxic')}),
      f AS (SELECT SUM(EXP(lp)) FILTER (lp <= (SELECT lp FROM d WHERE k = a) + 1e-7) AS exact FROM d)
    SELECT variable, n, CASE WHEN min_expected < 5 THEN 'fisher' ELSE 'chi-square' END AS test,
      ROUND(CASE WHEN min_expected < 5 THEN exact ELSE {chi2_sql('x', 1)} END, 6) AS p_value FROM x, f""",
)
def categorical_test_by_expected_count(spark, sf_dir):
    out = stats.categorical_test(table(spark, sf_dir, "labels"), ["quality"], "toxic")
    return rounded(out, 6, ("p_value",)).select("variable", "n", "test", "p_value")


def _ranks(source, where="TRUE"):
    return f"""r AS (SELECT g, v, (RANK() OVER (ORDER BY v) * 2 + COUNT(*) OVER (PARTITION BY v) - 1) / 2 AS rk
      FROM {source} WHERE {where}),
      t AS (SELECT SUM(CAST(c AS DOUBLE) * c * c - c) AS ties FROM (SELECT COUNT(*) AS c FROM r GROUP BY v)),
      s AS (SELECT g, COUNT(*) AS n, SUM(rk) AS rs FROM r GROUP BY g),
      a AS (SELECT CAST(SUM(n) AS BIGINT) AS n FROM s)"""


@query(
    "kruskal_wallis_test",
    f"""WITH e AS (SELECT event_type AS g, value AS v FROM events), {_ranks('e')},
      h AS (SELECT ANY_VALUE(a.n) AS n, SUM(s.n * POW(s.rs / s.n - (a.n + 1) / 2, 2)) AS ss FROM s, a),
      x AS (SELECT n, 12 / (CAST(n AS DOUBLE) * (n + 1)) * ss / (1 - ties / (CAST(n AS DOUBLE) * n * n - n)) AS x
        FROM h, t)
    SELECT 'value' AS variable, n, ROUND(x, 6) AS statistic, CAST(4 AS DOUBLE) AS df,
      ROUND({chi2_sql('x', 4)}, 6) AS p_value FROM x""",
)
def kruskal_wallis_test(spark, sf_dir):
    out = stats.kruskal_wallis(
        table(spark, sf_dir, "events"), "value", "event_type",
        ["click", "error", "purchase", "signup", "view"],
    )
    return rounded(out, 6, ("statistic", "p_value"))


@query(
    "rank_sum_test",
    f"""WITH e AS (SELECT event_type AS g, value AS v FROM events WHERE event_type IN ('click', 'view')),
      {_ranks('e')}, w AS (SELECT x.n AS n1, y.n AS n2, x.rs - x.n * (x.n + 1) / 2 AS w,
        SQRT(x.n * y.n / 12 * ((a.n + 1) - ties / (CAST(a.n AS DOUBLE) * (a.n - 1)))) AS sigma
        FROM s x, s y, a, t WHERE x.g = 'click' AND y.g = 'view'),
      z AS (SELECT *, (w - n1 * n2 / 2 - 0.5 * SIGN(w - n1 * n2 / 2)) / sigma AS z FROM w)
    SELECT 'value' AS variable, n1, n2, w AS statistic, ROUND(z, 6) AS z,
      ROUND({erfc_sql('ABS(z) / SQRT(2)')}, 6) AS p_value FROM z""",
)
def rank_sum_test(spark, sf_dir):
    out = stats.rank_sum(table(spark, sf_dir, "events"), "value", "event_type", ("click", "view"))
    return rounded(out, 6, ("z", "p_value"))


@query(
    "correlation_test",
    f"""WITH c AS (SELECT COUNT(*) AS n, CORR(o_totalprice, c_acctbal) AS r FROM orders JOIN customer
        ON o_custkey = c_custkey), s AS (SELECT n, r, CAST(n - 2 AS DOUBLE) AS df,
        r * SQRT((n - 2) / (1 - r * r)) AS t FROM c)
    SELECT n, ROUND(r, 8) AS r, ROUND(t, 6) AS statistic, df,
      ROUND(TANH(ATANH(r) - 1.959963984540054 / SQRT(n - 3)), 6) AS low,
      ROUND(TANH(ATANH(r) + 1.959963984540054 / SQRT(n - 3)), 6) AS high,
      ROUND({t_sql('t', 'df')}, 6) AS p_value FROM s""",
)
def correlation_test(spark, sf_dir):
    joined = table(spark, sf_dir, "orders").join(
        table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    out = rounded(stats.correlation_test(joined, "o_totalprice", "c_acctbal"), 8, ("r",))
    return rounded(out, 6, ("statistic", "low", "high", "p_value"))


_GROUPS = """g AS (SELECT o_orderstatus AS level, COUNT(*) AS n, AVG(o_totalprice) AS mean,
    VAR_SAMP(o_totalprice) AS v FROM orders GROUP BY 1),
  w AS (SELECT SUM((n - 1) * v) AS ssw, CAST(SUM(n) - 3 AS DOUBLE) AS df, SUM(n * mean) / SUM(n) AS grand FROM g),
  b AS (SELECT SUM(n * POW(mean - grand, 2)) AS ssb FROM g, w)"""


@query(
    "analysis_of_variance",
    f"""WITH {_GROUPS} SELECT CAST(2 AS DOUBLE) AS df_between, df AS df_within,
      CAST(ROUND(ssb / 1e6) AS DOUBLE) AS ss_between, CAST(ROUND(ssw / 1e6) AS DOUBLE) AS ss_within,
      ROUND(ssb / 2 / (ssw / df), 6) AS statistic,
      ROUND(POW(1 + ssb / ssw, -df / 2), 6) AS p_value FROM w, b""",
)
def analysis_of_variance(spark, sf_dir):
    out = stats.anova(table(spark, sf_dir, "orders"), "o_totalprice", "o_orderstatus")
    out = out.withColumns({c: F.round(F.col(c) / 1e6) for c in ("ss_between", "ss_within")})
    return rounded(out, 6, ("statistic", "p_value"))


@query(
    "marginal_means",
    f"""WITH {_GROUPS} SELECT level, n, ROUND(mean, 3) AS mean, ROUND(SQRT(ssw / df / n), 3) AS se, df
    FROM g, w""",
)
def marginal_means(spark, sf_dir):
    out = stats.marginal_means(
        table(spark, sf_dir, "orders"), "o_totalprice", "o_orderstatus", ["F", "O", "P"]
    )
    return rounded(out, 3, ("mean", "se"))


@query(
    "pairwise_contrasts",
    f"""WITH {_GROUPS}, p AS (SELECT x.level || ' - ' || y.level AS contrast, x.mean - y.mean AS estimate,
        SQRT(ssw / df * (1 / x.n + 1 / y.n)) AS se, df FROM g x JOIN g y ON x.level < y.level, w)
    SELECT contrast, ROUND(estimate, 3) AS estimate, ROUND(se, 3) AS se, df,
      ROUND(estimate / se, 6) AS statistic, ROUND({t_sql('estimate / se', 'df')}, 6) AS p_value FROM p""",
)
def pairwise_contrasts(spark, sf_dir):
    out = stats.pairwise_contrasts(
        table(spark, sf_dir, "orders"), "o_totalprice", "o_orderstatus", ["F", "O", "P"], adjust="none"
    )
    return rounded(rounded(out, 3, ("estimate", "se")), 6, ("statistic", "p_value"))


@query("pairwise_contrasts_adjusted")
def pairwise_contrasts_adjusted(spark, sf_dir):
    return stats.pairwise_contrasts(
        table(spark, sf_dir, "orders"), "o_totalprice", "o_orderstatus", ["F", "O", "P"]
    )


@query(
    "linear_model_one_factor",
    f"""WITH {_GROUPS}, m AS (SELECT 'o_orderstatus_' || x.level AS term, x.mean - y.mean AS estimate,
        SQRT(ssw / df * (1 / x.n + 1 / y.n)) AS se, df FROM g x, g y, w WHERE y.level = 'F' AND x.level <> 'F'
      UNION ALL SELECT '(Intercept)', mean, SQRT(ssw / df / n), df FROM g, w WHERE level = 'F')
    SELECT term, ROUND(estimate, 3) AS estimate, ROUND(se, 3) AS se, ROUND(estimate / se, 5) AS statistic,
      ROUND({t_sql('estimate / se', 'df')}, 6) AS p_value FROM m""",
)
def linear_model_one_factor(spark, sf_dir):
    out = stats.linear_model(table(spark, sf_dir, "orders"), "o_totalprice", ["o_orderstatus"])
    out = rounded(rounded(out, 3, ("estimate", "se")), 5, ("statistic",))
    return rounded(out, 6, ("p_value",))


#: 97.5 percent point of the normal distribution, and of t around it in powers of 1 / df.
_Z = 1.959963984540054


def t_point_sql(df: str) -> str:
    """Half-width of a 95 percent interval in standard errors, for many degrees of freedom."""
    z = _Z
    terms = [
        z,
        (z**3 + z) / 4,
        (5 * z**5 + 16 * z**3 + 3 * z) / 96,
        (3 * z**7 + 19 * z**5 + 17 * z**3 - 15 * z) / 384,
        (79 * z**9 + 776 * z**7 + 1482 * z**5 - 1920 * z**3 - 945 * z) / 92160,
    ]
    return "(" + " + ".join(f"{c!r} / POWER({df}, {k})" for k, c in enumerate(terms)) + ")"


@query(
    "marginal_means_with_intervals",
    f"""WITH {_GROUPS}, s AS (SELECT level, n, mean, SQRT(ssw / df / n) AS se, df FROM g, w)
    SELECT level, n, ROUND(mean, 3) AS mean, ROUND(se, 3) AS se, df, ROUND(mean - se * {t_point_sql('df')}, 2) AS low,
      ROUND(mean + se * {t_point_sql('df')}, 2) AS high FROM s""",
)
def marginal_means_with_intervals(spark, sf_dir):
    out = stats.marginal_means(
        table(spark, sf_dir, "orders"), "o_totalprice", "o_orderstatus", ["F", "O", "P"], confidence=0.95
    )
    return rounded(rounded(out, 3, ("mean", "se")), 2, ("low", "high"))


@query(
    "pairwise_contrasts_with_intervals",
    f"""WITH {_GROUPS}, p AS (SELECT x.level || ' - ' || y.level AS contrast, x.mean - y.mean AS estimate,
        SQRT(ssw / df * (1 / x.n + 1 / y.n)) AS se, df FROM g x JOIN g y ON x.level < y.level, w)
    SELECT contrast, ROUND(estimate, 3) AS estimate, ROUND(se, 3) AS se, df, ROUND(estimate / se, 6) AS statistic,
      ROUND({t_sql('estimate / se', 'df')}, 6) AS p_value, ROUND(estimate - se * {t_point_sql('df')}, 2) AS low,
      ROUND(estimate + se * {t_point_sql('df')}, 2) AS high FROM p""",
)
def pairwise_contrasts_with_intervals(spark, sf_dir):
    out = stats.pairwise_contrasts(
        table(spark, sf_dir, "orders"), "o_totalprice", "o_orderstatus", ["F", "O", "P"], adjust="none", confidence=0.95
    )
    out = rounded(rounded(out, 3, ("estimate", "se")), 6, ("statistic", "p_value"))
    return rounded(out, 2, ("low", "high"))


@query(
    "linear_model_with_intervals",
    f"""WITH {_GROUPS}, m AS (SELECT 'o_orderstatus_' || x.level AS term, x.mean - y.mean AS estimate,
        SQRT(ssw / df * (1 / x.n + 1 / y.n)) AS se, df FROM g x, g y, w WHERE y.level = 'F' AND x.level <> 'F'
      UNION ALL SELECT '(Intercept)', mean, SQRT(ssw / df / n), df FROM g, w WHERE level = 'F')
    SELECT term, ROUND(estimate, 3) AS estimate, ROUND(se, 3) AS se, ROUND(estimate - se * {t_point_sql('df')}, 2) AS low,
      ROUND(estimate + se * {t_point_sql('df')}, 2) AS high FROM m""",
)
def linear_model_with_intervals(spark, sf_dir):
    out = stats.linear_model(table(spark, sf_dir, "orders"), "o_totalprice", ["o_orderstatus"], confidence=0.95)
    out = out.drop("statistic", "p_value")
    return rounded(rounded(out, 3, ("estimate", "se")), 2, ("low", "high"))


@query("linear_model_several_terms")
def linear_model_several_terms(spark, sf_dir):
    joined = table(spark, sf_dir, "orders").join(
        table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    return stats.linear_model(joined, "o_totalprice", ["o_orderstatus", "c_mktsegment", "c_acctbal"])


def _paired(spark, sf_dir):
    """Two mean answers per participant, with a level of their own per participant.

    The closed form that the check uses holds for participants with both answers.
    """
    rows = (
        visits(spark, sf_dir)
        .where("timepoint in (2, 3)")
        .select(
            "record_id",
            F.expr("CASE WHEN timepoint = 2 THEN 'mdc' ELSE 'pcc' END").alias("type"),
            (F.col("score") + F.col("record_id") % 7 * 20).alias("score"),
        )
    )
    both = rows.groupBy("record_id").agg(F.count(F.lit(1)).alias("k")).where("k = 2")
    return rows.join(both, "record_id", "left_semi")


_PAIRS = visits_cte() + """, p AS (SELECT record_id,
    MAX(score + record_id % 7 * 20) FILTER (timepoint = 2) AS a, MAX(score + record_id % 7 * 20) FILTER (timepoint = 3) AS b
    FROM visits WHERE timepoint IN (2, 3) GROUP BY record_id HAVING COUNT(*) = 2),
  q AS (SELECT COUNT(*) AS n, AVG(a - b) AS d, VAR_SAMP(a - b) AS vd, VAR_SAMP(a + b) AS vs,
    VAR_SAMP(a) AS va, VAR_SAMP(b) AS vb FROM p),
  u AS (SELECT *, vs > vd AS inner_fit, CASE WHEN vs > vd THEN vd / 2 ELSE (va + vb) / 2 END AS within,
    GREATEST((vs - vd) / 4, 0) AS between FROM q)"""


@query(
    "random_intercept_contrast",
    f"""WITH {_PAIRS}, f AS (SELECT *, SQRT(2 * within / n) AS se,
        CAST(CASE WHEN inner_fit THEN n - 1 ELSE 2 * n - 2 END AS DOUBLE) AS df FROM u)
    SELECT 'mdc - pcc' AS contrast, ROUND(d, 6) AS estimate, ROUND(se, 4) AS se, ROUND(df, 1) AS df,
      ROUND(d / se, 4) AS statistic, ROUND({t_sql('d / se', 'df')}, 5) AS p_value,
      ROUND(between, 3) AS var_record, ROUND(within, 3) AS var_residual, n AS n_records, 2 * n AS n_answers FROM f""",
)
def random_intercept_contrast(spark, sf_dir):
    out = mixed.random_intercept_contrasts(
        _paired(spark, sf_dir), "record_id", "type", "score", ["mdc", "pcc"]
    )
    out = rounded(out, 6, ("estimate",))
    out = rounded(rounded(out, 4, ("se", "statistic")), 5, ("p_value",))
    return rounded(rounded(out, 1, ("df",)), 3, ("var_record", "var_residual"))


@query(
    "random_intercept_means",
    f"""WITH {_PAIRS}, f AS (SELECT *, SQRT((within + between) / n) AS se, CASE WHEN inner_fit
        THEN (n - 1) * POWER(vs + vd, 2) / (vs * vs + vd * vd) ELSE 2 * n - 2 END AS df,
        (SELECT AVG(a) FROM p) AS ma, (SELECT AVG(b) FROM p) AS mb FROM u),
      l AS (SELECT 'mdc' AS level, ma AS mean, * FROM f UNION ALL SELECT 'pcc', mb, * FROM f)
    SELECT level, ROUND(mean, 6) AS mean, ROUND(se, 4) AS se, ROUND(df, 1) AS df,
      ROUND(mean - se * {t_point_sql('df')}, 4) AS low, ROUND(mean + se * {t_point_sql('df')}, 4) AS high,
      ROUND(between, 3) AS var_record, ROUND(within, 3) AS var_residual, n AS n_records, 2 * n AS n_answers FROM l""",
)
def random_intercept_means(spark, sf_dir):
    """Estimated means of both kinds in the mixed model, with their intervals."""
    out = mixed.random_intercept_means(_paired(spark, sf_dir), "record_id", "type", "score", ["mdc", "pcc"])
    out = rounded(rounded(out, 6, ("mean",)), 4, ("se", "low", "high"))
    return rounded(rounded(out, 1, ("df",)), 3, ("var_record", "var_residual"))


@query("random_intercept_contrast_unbalanced")
def random_intercept_contrast_unbalanced(spark, sf_dir):
    """All visits: even ones of one kind of clinic, odd ones of the other, so that kinds and participants differ in number."""
    rows = visits(spark, sf_dir).select(
        "record_id",
        F.expr("CASE WHEN timepoint % 2 = 0 THEN 'mdc' ELSE 'pcc' END").alias("type"),
        (F.col("score") + F.col("record_id") % 7 * 20).alias("score"),
    )
    return mixed.random_intercept_contrasts(rows, "record_id", "type", "score", ["mdc", "pcc"])


@query(
    "intraclass_correlation",
    f"""WITH {_PAIRS}, l AS (SELECT record_id, a AS y FROM p UNION ALL SELECT record_id, b FROM p),
      m AS (SELECT record_id, AVG(y) AS m, SUM(y) AS s, SUM(y * y) AS q FROM l GROUP BY 1),
      v AS (SELECT COUNT(*) AS n, 2 * VAR_SAMP(m) AS msb, SUM(q - s * s / 2) / COUNT(*) AS msw FROM m)
    SELECT ROUND(GREATEST((msb - msw) / (msb + msw), 0), 5) AS icc, ROUND(GREATEST((msb - msw) / 2, 0), 3) AS var_record,
      ROUND(msw, 3) AS var_residual, n AS n_records, 2 * n AS n_answers FROM v""",
)
def intraclass_correlation(spark, sf_dir):
    out = mixed.intraclass_correlation(
        _paired(spark, sf_dir), "record_id", "type", "score", ["mdc", "pcc"]
    )
    return rounded(rounded(out, 5, ("icc",)), 3, ("var_record", "var_residual"))


@query("intraclass_correlation_unbalanced")
def intraclass_correlation_unbalanced(spark, sf_dir):
    """All visits of all participants, whatever number each has."""
    rows = visits(spark, sf_dir).select(
        "record_id",
        F.expr("CASE WHEN timepoint % 2 = 0 THEN 'mdc' ELSE 'pcc' END").alias("type"),
        (F.col("score") + F.col("record_id") % 7 * 20).alias("score"),
    )
    return mixed.intraclass_correlation(rows, "record_id", "type", "score", ["mdc", "pcc"])


@query("understanding_contrast_of_forms")
def understanding_contrast_of_forms(spark, sf_dir):
    scored = patient.understanding(view(spark, sf_dir, "patient"))
    # A customer stands for the record, so that both kinds of clinic meet in one.
    long = patient.understanding_long(
        scored.withColumn("record_id", F.col("site_name")), timepoint=1
    )
    return mixed.random_intercept_contrasts(
        long, "record_id", "type", "score", ["lou_score_mdc", "lou_score_pcc"]
    )


_SITE = cte("patient") + ", f AS (SELECT * FROM patient WHERE timepoint = 1)"


_P_VALUES = f"""WITH {_SITE}, c AS ({chi_parts('f', 'patient_gender', 'site_type')} UNION ALL
        {chi_parts('f', 'patient_ethn', 'site_type')} UNION ALL {chi_parts('f', 'lcdiagnosis', 'site_type')}),
      o AS (SELECT site_type AS g, months_symps AS v FROM f), m AS ({_T.format(a='MDC', b='PCC', t='o')}),
      s AS (SELECT *, {_T_REST} FROM m)
    SELECT variable, 'chi-square' AS test, ROUND(CASE WHEN df = 1 THEN {chi2_sql('x', 1)}
      ELSE {chi2_sql('x', 4)} END, 6) AS p_value FROM c
    UNION ALL SELECT 'months_symps', 't-test', ROUND({t_sql('difference / se', 'df')}, 6) FROM s"""


@query("report_p_values", _P_VALUES)
def report_p_values(spark, sf_dir):
    first = view(spark, sf_dir, "patient").where("timepoint = 1")
    rule = report.RULES["by_site_type"]
    out = stats.group_tests(
        first, rule.column, REPORT.levels, [*REPORT.categorical, *REPORT.dichotomous],
        REPORT.continuous, rule.continuous_test,
    )
    return rounded(out, 6, ("p_value",))


@query(
    "report_by_site_type",
    f"""SELECT r.*, test, p_value FROM ({report_check('site_type', 'timepoint = 1')}) r
    LEFT JOIN ({_P_VALUES}) p USING (variable)""",
)
def report_by_site_type(spark, sf_dir):
    out = report.run(view(spark, sf_dir, "patient"), REPORT, "by_site_type")
    return rounded(out, 6, ("percent", "p_value"))


@query(
    "need_domain_tests",
    f"""WITH {DOMAINS_CTE}, j AS (SELECT CASE WHEN p_size % 2 = 0 THEN 'even' ELSE 'odd' END AS grp, d.*
        FROM domains d JOIN part ON arb_person_id = 'P' || p_partkey),
      c AS ({' UNION ALL '.join(chi_parts('j', d, 'grp') for d in records.DOMAINS)})
    SELECT variable, n, ROUND(x, 5) AS statistic, ROUND({chi2_sql('x', 1)}, 5) AS p_value FROM c""",
)
def need_domain_tests(spark, sf_dir):
    groups = table(spark, sf_dir, "part").select(
        F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("arb_person_id"),
        F.expr("CASE WHEN p_size % 2 = 0 THEN 'even' ELSE 'odd' END").alias("grp"),
    )
    joined = person_domains(spark, sf_dir).join(groups, "arb_person_id")
    out = stats.categorical_test(joined, records.DOMAINS, "grp")
    return rounded(out, 5, ("statistic", "p_value")).select("variable", "n", "statistic", "p_value")


_AGES = [age for ages in fixed.RECORD_AGE_GROUPS.values() for age in ages]
_SEX = "CASE WHEN p_size % 2 = 0 THEN 'female' ELSE 'male' END"


def _people(spark, sf_dir):
    """A person for each part, with the demographics of a health record."""
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias(records.PATIENT),
        F.expr(pick(f"p_partkey % {len(_AGES) + 2}", _AGES)).alias("Pt_Age"),
        F.expr(_SEX).alias("Pt_Sex"),
        F.lit(None).cast("string").alias("Pt_Insurance_type"),
    )


_BANDS = " ".join(
    f"WHEN age IN ({', '.join(repr(a) for a in ages)}) THEN '{band}'" for band, ages in fixed.RECORD_AGE_GROUPS.items()
)
_PEOPLE = f"""{DOMAINS_CTE}, r AS (SELECT 'P' || p_partkey AS id, {_SEX} AS sex, {pick(f'p_partkey % {len(_AGES) + 2}', _AGES)} AS age
    FROM part),
  j AS (SELECT d.*, sex, CASE {_BANDS} ELSE '{fixed.RECORD_AGE_DEFAULT}' END AS band FROM domains d JOIN r ON arb_person_id = id)"""


def _share_parts(by: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{d}' AS variable, COALESCE({by}, 'Overall') AS "group", COUNT(*) FILTER ({d} = 1) AS n, COUNT({d}) AS total
        FROM j WHERE {by} IS NOT NULL GROUP BY GROUPING SETS (({by}), ())"""
        for d in records.DOMAINS
    )


@query(
    "need_domains_by_sex",
    f"""WITH {_PEOPLE}, s AS ({_share_parts('sex')}),
      c AS ({' UNION ALL '.join(chi_parts('j', d, 'sex') for d in records.DOMAINS)})
    SELECT s.variable, "group", s.n, total, ROUND({chi2_sql('x', 1)}, 5) AS p_value FROM s JOIN c ON s.variable = c.variable""",
)
def need_domains_by_sex(spark, sf_dir):
    """Share of people with each need by sex, with the test over the groups."""
    joined = records.with_people(person_domains(spark, sf_dir), _people(spark, sf_dir)).where("Pt_Sex is not null")
    out = records.domain_table(joined, "Pt_Sex")
    return rounded(out.select("variable", "group", "n", "total", "p_value"), 5, ("p_value",))


@query(
    "need_domains_by_age",
    f"""WITH {_PEOPLE} {_share_parts('band')}""",
)
def need_domains_by_age(spark, sf_dir):
    """Share of people with each need by age band, bands being sets of the record's own age groups."""
    joined = records.with_people(person_domains(spark, sf_dir), _people(spark, sf_dir)).where("Pt_Sex is not null")
    return records.domain_table(joined, "Pt_Age").select("variable", "group", "n", "total")
