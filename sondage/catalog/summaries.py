"""Summary tables and the configured report."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixed_values as fixed
from ..functions.recode import cut_right, flag
from ..functions.style import count_percent
from ..operators import ranks, summary
from ..operators.scales import add_scores
from ..plans import records, report, staff
from .registry import query
from .scores import DOMAINS_CTE, STIGMA_SQL, person_domains
from .standins import cte, table, view

PRICE_BREAKS = [100_000, 200_000, 300_000]
PRICE_LABELS = ["<=100k", "100k-200k", "200k-300k", ">300k"]


def _orders(spark, sf_dir):
    people = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    orders = table(spark, sf_dir, "orders").select(
        "o_custkey",
        "o_orderstatus",
        cut_right("o_totalprice", PRICE_BREAKS, PRICE_LABELS).alias("price_band"),
    )
    return orders.join(people, F.col("o_custkey") == F.col("c_custkey"), "left")


def rounded(df, digits=6, cols=("percent",)):
    return df.withColumns({c: F.round(c, digits) for c in cols})


_ORDERS = """f AS (SELECT c_mktsegment AS g, o_orderstatus,
    CASE WHEN o_totalprice <= 100000 THEN '<=100k' WHEN o_totalprice <= 200000 THEN '100k-200k'
      WHEN o_totalprice <= 300000 THEN '200k-300k' ELSE '>300k' END AS price_band
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey),
  both_groups AS (SELECT g AS "group", * FROM f UNION ALL SELECT 'Overall', * FROM f)"""


def _counted(source, variables, group='"group"'):
    """Counts and percentages per level of the listed variables, missing apart."""
    long = " UNION ALL ".join(
        f"""SELECT {group} AS "group", '{v}' AS variable, CAST({v} AS VARCHAR) AS level FROM {source}"""
        for v in variables
    )
    total = 'SUM(CASE WHEN level IS NOT NULL THEN n ELSE 0 END) OVER (PARTITION BY variable, "group")'
    return f"""long AS ({long}), c AS (SELECT variable, level, "group", COUNT(*) AS n FROM long GROUP BY ALL),
      counted AS (SELECT variable, level, "group", n, CAST({total} AS BIGINT) AS total,
        CASE WHEN level IS NOT NULL THEN ROUND(n * 100 / {total}, 6) END AS percent FROM c)"""


@query(
    "summary_by_group",
    f"""WITH {_ORDERS}, {_counted('both_groups', ['price_band', 'o_orderstatus'])} SELECT * FROM counted""",
)
def summary_by_group(spark, sf_dir):
    out = summary.categorical(
        _orders(spark, sf_dir), ["price_band", "o_orderstatus"], by="c_mktsegment"
    )
    return rounded(out).select("variable", "level", "group", "n", "total", "percent")


_FORM = ["patient_gender", "patient_ethn", "pcc_appts"]


@query(
    "categorical_summary",
    f"""WITH {cte('patient')}, {_counted('patient', _FORM, "'Overall'")} SELECT * FROM counted""",
)
def categorical_summary(spark, sf_dir):
    out = summary.categorical(view(spark, sf_dir, "patient"), _FORM)
    return rounded(out).select("variable", "level", "group", "n", "total", "percent")


@query(
    "summary_missing_as_level",
    f"""WITH {cte('patient')}, known AS (SELECT site_type, COALESCE(patient_gender, 'Unknown') AS
      patient_gender FROM patient), {_counted('known', ['patient_gender'], 'site_type')} SELECT * FROM counted""",
)
def summary_missing_as_level(spark, sf_dir):
    out = summary.categorical(
        view(spark, sf_dir, "patient"), ["patient_gender"], by="site_type", overall=False,
        missing="level",
    )
    return rounded(out).select("variable", "level", "group", "n", "total", "percent")


@query(
    "summary_with_labels_and_order",
    f"""WITH {cte('patient')}, {_counted('patient', ['serious_pcc', 'talk_pcc'], "'Overall'")}
    SELECT CASE variable WHEN 'serious_pcc' THEN 'Took me seriously' ELSE 'Could talk' END AS label,
      variable, level, CAST(LIST_POSITION(['Never', 'Rarely', 'Sometimes', 'Often', 'Very Often'], level)
        AS INT) AS level_rank, n, total, percent FROM counted WHERE level IS NOT NULL""",
)
def summary_with_labels_and_order(spark, sf_dir):
    order = list(fixed.UNDERSTANDING_SCORES)
    out = summary.categorical(
        view(spark, sf_dir, "patient"),
        ["serious_pcc", "talk_pcc"],
        missing="no",
        labels={"serious_pcc": "Took me seriously", "talk_pcc": "Could talk"},
        levels={"serious_pcc": order, "talk_pcc": order},
    )
    return rounded(out).select(
        "label", "variable", "level", "level_rank", "n", "total", "percent"
    )


@query(
    "summary_side_by_side",
    f"""WITH {_ORDERS}, {_counted('both_groups', ['o_orderstatus'])},
      t AS (SELECT *, (n * 2000 + total) // (total * 2) AS tenths, (n * 200 + total) // (total * 2) AS whole
        FROM counted),
      s AS (SELECT level, "group", FORMAT('{{:,}}', n) || ' (' || CASE WHEN n * 1000 < total THEN '<0.1'
        WHEN tenths >= 100 THEN CAST(whole AS VARCHAR)
        ELSE CAST(tenths // 10 AS VARCHAR) || '.' || CAST(tenths % 10 AS VARCHAR) END || '%)' AS cell FROM t)
    SELECT level, MAX(cell) FILTER ("group" = 'BUILDING') AS "BUILDING",
      MAX(cell) FILTER ("group" = 'MACHINERY') AS "MACHINERY",
      MAX(cell) FILTER ("group" = 'Overall') AS "Overall" FROM s GROUP BY level""",
)
def summary_side_by_side(spark, sf_dir):
    out = summary.categorical(_orders(spark, sf_dir), ["o_orderstatus"], by="c_mktsegment")
    return summary.side_by_side(out, ["BUILDING", "MACHINERY", "Overall"], ["level"])


@query(
    "summary_cells",
    f"""WITH {cte('patient')}, {_counted('patient', ['patient_gender'], 'site_type')}
    SELECT "group", level, FORMAT('{{:,}}', n) || ' (' || CASE WHEN (n * 2000 + total) // (total * 2) >= 100
        THEN CAST((n * 200 + total) // (total * 2) AS VARCHAR)
        ELSE FORMAT('{{}}.{{}}', (n * 2000 + total) // (total * 2) // 10, (n * 2000 + total) // (total * 2) % 10)
      END || '%)' AS cell FROM counted WHERE level IS NOT NULL""",
)
def summary_cells(spark, sf_dir):
    out = summary.categorical(
        view(spark, sf_dir, "patient"), ["patient_gender"], by="site_type", overall=False, missing="no"
    )
    return out.select("group", "level", count_percent(F.col("n"), F.col("total")).alias("cell"))


_MOMENTS = """COUNT(v) AS n, COUNT(*) - COUNT(v) AS n_missing, ROUND(AVG(v), 4) AS mean,
  ROUND(STDDEV_SAMP(v), 4) AS sd, MIN(v) AS min, MAX(v) AS max"""


@query(
    "continuous_summary",
    f"""WITH {cte('patient')}, v AS (SELECT site_type AS "group", months_symps AS v FROM patient
        UNION ALL SELECT 'Overall', months_symps FROM patient),
      r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY "group" ORDER BY v) AS i,
        COUNT(*) OVER (PARTITION BY "group") AS k FROM v WHERE v IS NOT NULL),
      p AS (SELECT "group", """
    + ", ".join(
        f"""ROUND(AVG(CASE WHEN (k * {num}) % 4 = 0 THEN CASE WHEN i IN (k * {num} // 4, k * {num} // 4 + 1) THEN v END
          WHEN i = k * {num} // 4 + 1 THEN v END), 4) AS {name}"""
        for name, num in (("p25", 1), ("median", 2), ("p75", 3))
    )
    + f""" FROM r GROUP BY "group"), m AS (SELECT "group", {_MOMENTS} FROM v GROUP BY "group")
    SELECT 'months_symps' AS variable, m.*, p25, median, p75 FROM m JOIN p USING ("group")""",
)
def continuous_summary(spark, sf_dir):
    out = summary.continuous(view(spark, sf_dir, "patient"), ["months_symps"], by="site_type")
    return rounded(out, 4, ("mean", "sd", "p25", "median", "p75"))


@query(
    "continuous_summary_text",
    f"""WITH {cte('staff')}, v AS (SELECT pcc_or_mdc AS "group", UNNEST(['prefer_not', 'irritate']) AS variable,
        UNNEST([prefer_not, irritate]) AS v FROM staff)
    SELECT variable, "group", FORMAT('{{:.2f}} ({{:.2f}}); [{{:.2f}}, {{:.2f}}, {{:.2f}}]', ROUND(AVG(v), 2),
      ROUND(STDDEV_SAMP(v), 2), CAST(MIN(v) AS DOUBLE), CAST(MEDIAN(v) AS DOUBLE), CAST(MAX(v) AS DOUBLE)) AS stat
    FROM v GROUP BY ALL""",
)
def continuous_summary_text(spark, sf_dir):
    out = summary.continuous(
        view(spark, sf_dir, "staff"),
        ["prefer_not", "irritate"],
        by="pcc_or_mdc",
        overall=False,
        template="{mean} ({sd}); [{min}, {median}, {max}]",
        few_values=True,
        digits=2,
    )
    return out.select("variable", "group", "stat")


_FLAGS = """SELECT "group", 'lcdiagnosis' AS variable, 'Yes' AS level, COUNT(*) FILTER (lcdiagnosis = 'Yes') AS n,
    COUNT(lcdiagnosis) AS total FROM g GROUP BY ALL
  UNION ALL SELECT "group", 'patient_race___1', '1', COUNT(*) FILTER (patient_race___1 = 1),
    COUNT(patient_race___1) FROM g GROUP BY ALL"""


@query(
    "dichotomous_summary",
    f"""WITH {cte('patient')}, g AS (SELECT site_type AS "group", * FROM patient UNION ALL
        SELECT 'Overall', * FROM patient), d AS ({_FLAGS})
    SELECT *, ROUND(n * 100 / total, 6) AS percent FROM d""",
)
def dichotomous_summary(spark, sf_dir):
    out = summary.dichotomous(
        view(spark, sf_dir, "patient"), {"lcdiagnosis": "Yes", "patient_race___1": 1}, by="site_type"
    )
    return rounded(out)


@query(
    "one_level_shown",
    f"""WITH {cte('patient')}, {_counted('patient', ['lcdiagnosis', 'pcc_appts'], 'site_type')}
    SELECT * FROM counted WHERE variable = 'pcc_appts' OR level = 'Yes'""",
)
def one_level_shown(spark, sf_dir):
    out = summary.categorical(
        view(spark, sf_dir, "patient"), ["lcdiagnosis", "pcc_appts"], by="site_type", overall=False,
        values={"lcdiagnosis": "Yes"},
    )
    return rounded(out).select("variable", "level", "group", "n", "total", "percent")


_GRID_ITEMS = fixed.STIGMA_ITEMS


def _grid(strata):
    lead = "".join(f"{s}, " for s in strata)
    items = ", ".join(f"'{i}'" for i in _GRID_ITEMS)
    values = ", ".join(f"COALESCE({i}, 'Unknown')" for i in _GRID_ITEMS)
    counts = ", ".join(
        f"COUNT(*) FILTER (level = '{lv}') AS n_{k}, "
        f"ROUND(COUNT(*) FILTER (level = '{lv}') * 100 / COUNT(*), 6) AS percent_{k}"
        for k, lv in enumerate(fixed.AGREEMENT_LEVELS, 1)
    )
    return f"""WITH {cte('staff_text')}, l AS (SELECT {lead} UNNEST([{items}]) AS item,
      UNNEST([{values}]) AS level FROM staff_text)
      SELECT {lead} item, COUNT(*) AS n, {counts} FROM l GROUP BY ALL"""


def _likert(strata):
    def run(spark, sf_dir):
        out = summary.likert(
            view(spark, sf_dir, "staff_text"), _GRID_ITEMS, fixed.AGREEMENT_LEVELS, strata
        )
        return rounded(out, 6, [f"percent_{k}" for k in range(1, 7)])

    return run


query("likert_grid", _grid([]))(_likert([]))
query("likert_grid_by_stratum", _grid(["burnout"]))(_likert(["burnout"]))


@query(
    "summary_within_strata",
    f"""WITH {cte('patient')}, c AS (SELECT patient_ethn, 'race_1' AS variable, site_type AS "group",
        CAST(patient_race___1 AS VARCHAR) AS level, COUNT(*) AS n FROM patient GROUP BY ALL)
    SELECT *, CAST(SUM(n) OVER (PARTITION BY patient_ethn, "group") AS BIGINT) AS total,
      ROUND(n * 100 / SUM(n) OVER (PARTITION BY patient_ethn, "group"), 6) AS percent FROM c""",
)
def summary_within_strata(spark, sf_dir):
    form = view(spark, sf_dir, "patient").withColumn("race_1", F.col("patient_race___1"))
    out = summary.categorical(
        form, ["race_1"], by="site_type", strata=["patient_ethn"], overall=False
    )
    return rounded(out).select(
        "patient_ethn", "variable", "group", "level", "n", "total", "percent"
    )


_VALENCE = ["extra_time", "satisfying"]


@query(
    "collapsed_responses",
    f"""WITH {cte('staff_text')}, l AS (SELECT pcc_or_mdc,
        UNNEST(['prefer_not', 'irritate', 'extra_time', 'satisfying']) AS item,
        UNNEST([prefer_not, irritate, extra_time, satisfying]) AS level FROM staff_text),
      c AS (SELECT pcc_or_mdc, item, CASE WHEN level IN ('SD (1)', 'D (2)') THEN 'Disagree'
          WHEN level IN ('A (4)', 'SA (5)') THEN 'Agree' WHEN level = 'N (3)' THEN 'Neutral'
          ELSE 'Unknown' END AS response, COUNT(*) AS n FROM l GROUP BY ALL),
      d AS (SELECT pcc_or_mdc, COUNT(*) AS total FROM staff_text GROUP BY ALL)
    SELECT c.*, total, ROUND(n * 100 / total, 6) AS percent,
      CASE WHEN item IN ('extra_time', 'satisfying') THEN 'positive' ELSE 'negative' END AS valence
    FROM c JOIN d USING (pcc_or_mdc)""",
)
def collapsed_responses(spark, sf_dir):
    out = summary.collapsed(
        view(spark, sf_dir, "staff_text"),
        ["prefer_not", "irritate", *_VALENCE],
        fixed.AGREEMENT_GROUPS,
        by="pcc_or_mdc",
        positive=_VALENCE,
    )
    return rounded(out)


@query(
    "endorsement_by_frequency",
    "WITH " + cte("patient") + ", e AS (" + " UNION ALL ".join(
        f"SELECT 'patient_race___{j}' AS item, SUM(patient_race___{j}) AS n, COUNT(*) AS total FROM patient"
        for j in range(1, 8)
    ) + ") SELECT item, CAST(n AS BIGINT) AS n, total, ROUND(n * 100 / total, 6) AS percent FROM e",
)
def endorsement_by_frequency(spark, sf_dir):
    out = summary.endorsement(view(spark, sf_dir, "patient"), list(fixed.RACES))
    return rounded(out).orderBy(F.desc("n"), "item")


_SYMPTOM_FLAGS = ["ps_cough", "ps_pain"]


@query(
    "endorsement_with_branched_items",
    "WITH " + cte("symptoms") + ", e AS (" + " UNION ALL ".join(
        [
            f"SELECT site_type, '{s}' AS item, COUNT(*) FILTER ({s} LIKE '%Yes%') AS n, COUNT(*) AS total "
            "FROM symptoms GROUP BY ALL"
            for s in _SYMPTOM_FLAGS
        ]
        + [
            f"SELECT site_type, '{s}' AS item, COUNT(*) FILTER ({s} = 1) AS n, COUNT(*) FILTER "
            "(patient_gender IS NULL OR patient_gender NOT IN ('Male', 'Transgender Female')) AS total "
            "FROM symptoms GROUP BY ALL"
            for s in fixed.BRANCHED_SYMPTOMS
        ]
    ) + ") SELECT *, ROUND(n * 100 / total, 6) AS percent FROM e",
)
def endorsement_with_branched_items(spark, sf_dir):
    form = view(spark, sf_dir, "symptoms").withColumns(
        {s: flag(F.col(s).rlike("Yes")) for s in _SYMPTOM_FLAGS}
    )
    asked = ~F.coalesce(F.col("patient_gender").isin(fixed.BRANCH_EXCLUDED_GENDERS), F.lit(False))
    out = summary.endorsement(
        form,
        [*_SYMPTOM_FLAGS, *fixed.BRANCHED_SYMPTOMS],
        {s: asked for s in fixed.BRANCHED_SYMPTOMS},
        ["site_type"],
    )
    return rounded(out)


@query(
    "group_means_and_errors",
    """SELECT l_returnflag, l_linestatus, COUNT(*) AS n, ROUND(AVG(l_quantity), 6) AS mean_l_quantity,
      ROUND(STDDEV_SAMP(l_quantity) / SQRT(COUNT(*)), 6) AS se_l_quantity
    FROM lineitem GROUP BY l_returnflag, l_linestatus""",
)
def group_means_and_errors(spark, sf_dir):
    out = summary.group_means(
        table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"], ["l_quantity"]
    )
    return rounded(out, 6, ("mean_l_quantity", "se_l_quantity"))


@query(
    "group_means_strict_on_missing",
    f"""WITH {cte('patient')}, v AS (SELECT site_name, months_symps AS m FROM patient)
    SELECT site_name, COUNT(*) AS n, CASE WHEN COUNT(m) = COUNT(*) THEN ROUND(AVG(m), 4) END AS strict_mean,
      ROUND(AVG(m), 4) AS open_mean FROM v GROUP BY site_name""",
)
def group_means_strict_on_missing(spark, sf_dir):
    form = view(spark, sf_dir, "patient").withColumn("open", F.col("months_symps"))
    strict = summary.group_means(form, ["site_name"], ["months_symps"])
    open_ = summary.group_means(form, ["site_name"], ["open"], na_rm=True)
    return strict.join(open_.select("site_name", "mean_open"), "site_name").select(
        "site_name", "n", F.round("mean_months_symps", 4).alias("strict_mean"),
        F.round("mean_open", 4).alias("open_mean"),
    )


@query(
    "monthly_mean_count",
    """WITH m AS (SELECT STRFTIME(o_orderdate, '%Y-%m') AS month, COUNT(*) AS n FROM orders GROUP BY 1)
    SELECT ROUND(AVG(n), 6) AS mean, COUNT(*) AS months FROM m""",
)
def monthly_mean_count(spark, sf_dir):
    out = summary.mean_of_monthly_counts(table(spark, sf_dir, "orders"), "o_orderdate")
    return rounded(out, 6, ("mean",))


@query(
    "distinct_counts",
    """SELECT COUNT(DISTINCT l_partkey) AS n_persons, COUNT(DISTINCT l_suppkey) AS n_questions FROM lineitem""",
)
def distinct_counts(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").agg(
        F.countDistinct("l_partkey").alias("n_persons"),
        F.countDistinct("l_suppkey").alias("n_questions"),
    )


@query(
    "free_text_frequency",
    """SELECT 'p_name' AS variable, p_name AS level, COUNT(*) AS n, (SELECT COUNT(*) FROM part WHERE
        p_type = 'PROMO') AS total, ROUND(COUNT(*) * 100 / (SELECT COUNT(*) FROM part WHERE p_type = 'PROMO'), 6)
      AS percent FROM part WHERE p_type = 'PROMO' GROUP BY p_name""",
)
def free_text_frequency(spark, sf_dir):
    out = summary.frequency(table(spark, sf_dir, "part"), "p_name", F.col("p_type") == "PROMO")
    return rounded(out).select("variable", "level", "n", "total", "percent")


@query(
    "free_text_of_documents",
    """WITH c AS (SELECT lang, text, COUNT(*) AS n FROM documents GROUP BY lang, text)
    SELECT lang, n AS copies, COUNT(*) AS texts FROM c GROUP BY ALL""",
)
def free_text_of_documents(spark, sf_dir):
    texts = table(spark, sf_dir, "documents").groupBy("lang", "text").agg(
        F.count(F.lit(1)).alias("copies")
    )
    return texts.groupBy("lang", "copies").agg(F.count(F.lit(1)).alias("texts"))


@query(
    "free_text_of_several_columns",
    """WITH t AS (SELECT 'p_name' AS variable, p_name AS level FROM part WHERE p_size > 25
      UNION ALL SELECT 'p_type', p_type FROM part WHERE p_size <= 25),
      c AS (SELECT variable, level, COUNT(*) AS n FROM t GROUP BY ALL)
    SELECT *, CAST(SUM(n) OVER (PARTITION BY variable) AS BIGINT) AS total,
      ROUND(n * 100 / SUM(n) OVER (PARTITION BY variable), 6) AS percent FROM c""",
)
def free_text_of_several_columns(spark, sf_dir):
    out = summary.frequencies(
        table(spark, sf_dir, "part"),
        {"p_name": F.col("p_size") > 25, "p_type": F.col("p_size") <= 25},
    )
    return rounded(out).select("variable", "level", "n", "total", "percent")


@query(
    "group_headers",
    """WITH g AS (SELECT o_orderpriority AS "group", COUNT(*) AS n FROM orders GROUP BY 1
      UNION ALL SELECT 'Overall', COUNT(*) FROM orders)
    SELECT "group", n, "group" || ', N = ' || FORMAT('{:,}', n) AS header FROM g""",
)
def group_headers(spark, sf_dir):
    return summary.group_sizes(table(spark, sf_dir, "orders"), "o_orderpriority")


_DECILES = ", ".join(f"ROUND(QUANTILE_CONT(v, {i / 10}), 4) AS p{i * 10}" for i in range(11))


@query(
    "deciles",
    f"SELECT {_DECILES.replace('(v,', '(o_totalprice,')} FROM orders",
)
def deciles(spark, sf_dir):
    out = ranks.deciles(table(spark, sf_dir, "orders"), "o_totalprice")
    return rounded(out, 4, out.columns)


@query(
    "deciles_by_group",
    f"SELECT o_orderstatus, {_DECILES.replace('(v,', '(o_totalprice,')} FROM orders GROUP BY o_orderstatus",
)
def deciles_by_group(spark, sf_dir):
    out = ranks.deciles(table(spark, sf_dir, "orders"), "o_totalprice", ["o_orderstatus"])
    return rounded(out, 4, out.columns[1:])


@query(
    "low_tail_of_score",
    f"""WITH {cte('staff')}, s AS (SELECT pcc_or_mdc, {STIGMA_SQL} AS stigma FROM staff),
      q AS (SELECT QUANTILE_CONT(stigma, 0.1) AS cut FROM s)
    SELECT pcc_or_mdc, COUNT(*) FILTER (stigma <= cut + 1e-9) AS n_low, COUNT(stigma) AS n FROM s, q
    GROUP BY pcc_or_mdc""",
)
def low_tail_of_score(spark, sf_dir):
    scored = add_scores(view(spark, sf_dir, "staff"), {"stigma": staff.stigma()})
    # The cut is one row of one number, read once and put into the filter.
    cut = ranks.percentiles(scored, "stigma", {"cut": 0.1}, few_values=True).first()["cut"]
    return scored.groupBy("pcc_or_mdc").agg(
        F.count_if(F.col("stigma") <= cut + 1e-9).alias("n_low"), F.count("stigma").alias("n")
    )


_RANKED = """SELECT {k}, {v}, (RANK() OVER ({p} ORDER BY {v}) * 2 + COUNT(*) OVER ({q}) - 1) / 2 AS rank
  FROM {t} WHERE {v} IS NOT NULL"""


@query(
    "tie_averaged_ranks",
    _RANKED.format(k="event_id", v="value", p="", q="PARTITION BY value", t="events"),
)
def tie_averaged_ranks(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", "value")
    return ranks.with_ranks(rows, "value")


@query(
    "tie_averaged_ranks_by_group",
    _RANKED.format(
        k="event_id, event_type", v="value", p="PARTITION BY event_type",
        q="PARTITION BY event_type, value", t="events",
    ),
)
def tie_averaged_ranks_by_group(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    return ranks.with_ranks(rows, "value", ["event_type"])


@query(
    "visit_gated_items",
    f"""WITH {cte('patient')}, g AS (SELECT redcap_event_name AS "group", explain_pcc, listen_pcc FROM patient
      WHERE timepoint IN (2, 3, 4) AND appt_pcc = 'Yes'), {_counted('g', ['explain_pcc', 'listen_pcc'])}
    SELECT * FROM counted""",
)
def visit_gated_items(spark, sf_dir):
    asked = view(spark, sf_dir, "patient").where(
        F.col("timepoint").isin(2, 3, 4) & (F.col("appt_pcc") == "Yes")
    )
    out = summary.categorical(
        asked, ["explain_pcc", "listen_pcc"], by="redcap_event_name", overall=False
    )
    return rounded(out).select("variable", "level", "group", "n", "total", "percent")


@query(
    "need_domains_by_segment",
    f"""WITH {DOMAINS_CTE}, j AS (SELECT p_type AS "group", d.* FROM domains d JOIN part ON
        arb_person_id = 'P' || p_partkey), g AS (SELECT * FROM j UNION ALL
        SELECT 'Overall' AS "group", * EXCLUDE ("group") FROM j)
    """ + " UNION ALL ".join(
        f"""SELECT "group", '{d}' AS variable, COUNT(*) FILTER ({d} = 1) AS n, COUNT({d}) AS total,
        ROUND(COUNT(*) FILTER ({d} = 1) * 100 / COUNT({d}), 6) AS percent FROM g GROUP BY ALL"""
        for d in records.DOMAINS
    ),
)
def need_domains_by_segment(spark, sf_dir):
    groups = table(spark, sf_dir, "part").select(
        F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("arb_person_id"), "p_type"
    )
    joined = person_domains(spark, sf_dir).join(groups, "arb_person_id")
    out = summary.dichotomous(joined, {d: 1 for d in records.DOMAINS}, by="p_type")
    return rounded(out).select("group", "variable", "n", "total", "percent")


REPORT = report.Report(
    categorical=["patient_gender", "patient_ethn"],
    dichotomous={"lcdiagnosis": "Yes"},
    continuous=["months_symps"],
    template="{mean} ({sd}); [{min}, {median}, {max}]",
    levels=["MDC", "PCC"],
    digits=6,
)


def report_check(column, where):
    """The report rows without test results, which have checks of their own."""
    return f"""WITH {cte('patient')}, f AS (SELECT * FROM patient WHERE {where}),
      g AS (SELECT {column} AS "group", * FROM f UNION ALL SELECT 'Overall', * FROM f),
      {_counted('g', ['patient_gender', 'patient_ethn'])}
    SELECT variable, level, "group", n, total, percent, NULL AS stat FROM counted
    UNION ALL SELECT 'lcdiagnosis', 'Yes', "group", COUNT(*) FILTER (lcdiagnosis = 'Yes'), COUNT(lcdiagnosis),
      ROUND(COUNT(*) FILTER (lcdiagnosis = 'Yes') * 100 / NULLIF(COUNT(lcdiagnosis), 0), 6), NULL
      FROM g GROUP BY "group"
    UNION ALL SELECT 'months_symps', NULL, "group", COUNT(months_symps), COUNT(months_symps), NULL,
      COALESCE(FORMAT('{{:,.6f}}', ROUND(AVG(months_symps), 6)), 'NA') || ' (' ||
      COALESCE(FORMAT('{{:,.6f}}', ROUND(STDDEV_SAMP(months_symps), 6)), 'NA') || '); [' ||
      COALESCE(FORMAT('{{:,.6f}}', ROUND(MIN(months_symps), 6)), 'NA') || ', ' ||
      COALESCE(FORMAT('{{:,.6f}}', ROUND(MEDIAN(months_symps), 6)), 'NA') || ', ' ||
      COALESCE(FORMAT('{{:,.6f}}', ROUND(MAX(months_symps), 6)), 'NA') || ']'
      FROM g GROUP BY "group" """


def _report(by_variable):
    def run(spark, sf_dir):
        out = report.run(view(spark, sf_dir, "patient"), REPORT, by_variable)
        return rounded(out).drop("test", "p_value")

    return run


query(
    "report_by_clinic",
    report_check(
        "site_name",
        "timepoint = 1 AND site_name IN (SELECT site_name FROM patient WHERE timepoint = 1 "
        "GROUP BY site_name HAVING COUNT(*) >= 5)",
    ),
)(_report("by_clinic"))
query("report_by_timepoint", report_check("redcap_event_name", "TRUE"))(_report("by_timepoint"))
