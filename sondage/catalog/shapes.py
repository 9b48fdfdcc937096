"""Sources, columns, joins and pivots."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import nulls, recode
from ..operators import cohort, columns, reshape
from ..session import shared_folder
from ..sources import tables
from .registry import query
from .standins import EVENTS, cte, table, view, visits, visits_cte


@query(
    "csv_sink_and_source",
    "SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer",
)
def csv_sink_and_source(spark, sf_dir):
    cols = ["c_custkey", "c_name", "c_acctbal", "c_mktsegment"]
    path = f"{shared_folder(spark)}/export-{uuid.uuid4().hex}"
    tables.write_table(columns.pick(table(spark, sf_dir, "customer"), cols), path, "csv")
    return tables.read_csv(
        spark, path, "c_custkey bigint, c_name string, c_acctbal double, c_mktsegment string"
    )


@query(
    "export_with_schema",
    "SELECT o_orderkey AS record_id, o_orderstatus, o_totalprice FROM orders",
)
def export_with_schema(spark, sf_dir):
    return tables.read_export(
        spark,
        f"{sf_dir}/orders.parquet",
        "o_orderkey bigint, o_orderstatus string, o_totalprice double",
        record="o_orderkey",
    )


@query(
    "merge_encodings",
    f"""WITH {cte('patient')} SELECT record_id, site_type, patient_race___1 + 0 AS race_1,
    patient_race___2 + 0 AS race_2, patient_gender FROM patient""",
)
def merge_encodings(spark, sf_dir):
    form = view(spark, sf_dir, "patient")
    shown = form.select(
        "record_id",
        "site_type",
        *[
            F.when(F.col(f"patient_race___{j}") == 1, "Checked").otherwise("Unchecked").alias(f"race_{j}")
            for j in (1, 2)
        ],
        "patient_gender",
    )
    codes = form.select("record_id", *[F.col(f"patient_race___{j}").alias(f"race_{j}") for j in (1, 2)])
    return tables.merge_encodings(shown, codes, ["record_id"], ["race_1", "race_2"])


@query(
    "select_and_apply_across",
    """SELECT l_orderkey, CASE WHEN l_discount > 0.05 THEN 1 ELSE 0 END AS l_discount,
    CASE WHEN l_tax > 0.05 THEN 1 ELSE 0 END AS l_tax, COUNT(*) AS n FROM lineitem GROUP BY ALL""",
)
def select_and_apply_across(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    names = columns.span(lines, "l_discount", "l_tax")
    kept = columns.pick(lines, ["l_orderkey", *names])
    high = columns.across(kept, names, lambda c: recode.flag(c > 0.05))
    return high.groupBy(*high.columns).agg(F.count(F.lit(1)).alias("n"))


@query(
    "rename_headers",
    'SELECT p_partkey AS "partkey", p_name AS "name of part", p_brand AS "brand", p_size AS "size" FROM part',
)
def rename_headers(spark, sf_dir):
    parts = columns.leave_out(table(spark, sf_dir, "part"), ["p_type", "p_retailprice"])
    short = columns.rename_by_pattern(parts, r"^p_", "")
    return columns.label_header(short, {"name": "name of part"})


@query(
    "filters",
    f"""WITH {cte('patient')} SELECT record_id, patient_age, patient_gender FROM patient
    WHERE patient_age BETWEEN 18 AND 64
      AND (patient_gender IS NULL OR patient_gender NOT IN ('Male', 'Non-binary'))""",
)
def filters(spark, sf_dir):
    form = view(spark, sf_dir, "patient")
    return form.where(
        F.col("patient_age").between(18, 64)
        & nulls.not_in("patient_gender", ["Male", "Non-binary"])
    ).select("record_id", "patient_age", "patient_gender")


@query(
    "null_rules_of_patterns",
    f"""WITH {cte('patient')} SELECT patient_gender,
      CASE WHEN patient_gender IS NULL THEN 0 WHEN patient_gender LIKE '%ale%' THEN 1 ELSE 0 END AS found,
      CASE WHEN patient_gender IS NULL THEN 'unknown' WHEN patient_gender LIKE '%ale%' THEN 'yes'
           ELSE 'no' END AS detected, COUNT(*) AS n FROM patient GROUP BY ALL""",
)
def null_rules_of_patterns(spark, sf_dir):
    found = nulls.matches("patient_gender", "ale").cast("int").alias("found")
    seen = F.coalesce(nulls.if_else(nulls.detects("patient_gender", "ale"), "yes", "no"), F.lit("unknown"))
    return (
        view(spark, sf_dir, "patient")
        .groupBy("patient_gender", found, seen.alias("detected"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query(
    "drop_missing",
    f"WITH {cte('patient')} SELECT record_id, patient_age FROM patient WHERE patient_age IS NOT NULL",
)
def drop_missing(spark, sf_dir):
    return view(spark, sf_dir, "patient").select("record_id", "patient_age").dropna(subset=["patient_age"])


@query(
    "distinct_sites",
    f"WITH {cte('patient')} SELECT DISTINCT site_name, site_type FROM patient",
)
def distinct_sites(spark, sf_dir):
    return view(spark, sf_dir, "patient").select("site_name", "site_type").distinct()


@query(
    "coalesce_instruments",
    f"""WITH {cte('patient')} SELECT record_id, COALESCE(serious_pcc, serious_mdc, talk_pcc, 'none')
    AS answer FROM patient""",
)
def coalesce_instruments(spark, sf_dir):
    return view(spark, sf_dir, "patient").select(
        "record_id", F.coalesce("serious_pcc", "serious_mdc", "talk_pcc", F.lit("none")).alias("answer")
    )


@query(
    "left_joins",
    """SELECT o_orderkey, c_mktsegment, n_name, r_name FROM orders
    LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
    LEFT JOIN region ON n_regionkey = r_regionkey""",
)
def left_joins(spark, sf_dir):
    orders, customer, nation, region = (
        table(spark, sf_dir, t) for t in ("orders", "customer", "nation", "region")
    )
    return (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"), "left")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
        .select("o_orderkey", "c_mktsegment", "n_name", "r_name")
    )


@query(
    "left_join_two_keys",
    f"""WITH {visits_cte()}, late AS (SELECT record_id, timepoint, n AS n_late FROM visits
      WHERE timepoint IN (4, 5)) SELECT v.record_id, v.timepoint, v.n, CAST(l.n_late AS DOUBLE) AS n_late
    FROM visits v LEFT JOIN late l ON v.record_id = l.record_id AND v.timepoint = l.timepoint""",
)
def left_join_two_keys(spark, sf_dir):
    rows = visits(spark, sf_dir).select("record_id", "timepoint", "n")
    late = rows.where("timepoint in (4, 5)").withColumnRenamed("n", "n_late")
    return reshape.bind_by_key(rows, late, ["record_id", "timepoint"]).withColumn(
        "n_late", F.col("n_late").cast("double")
    )


_VISIT_ROWS = f"""WITH {visits_cte()} SELECT record_id,
  MAX(status) FILTER (timepoint = 1) AS t1_status, MAX(status) FILTER (timepoint = 2) AS t2_status,
  MAX(status) FILTER (timepoint = 3) AS t3_status, MAX(status) FILTER (timepoint = 4) AS t4_status,
  MAX(status) FILTER (timepoint = 5) AS t5_status FROM visits GROUP BY record_id"""


@query("visit_statuses_in_one_row", _VISIT_ROWS)
def visit_statuses_in_one_row(spark, sf_dir):
    names = {k: f"t{k}_status" for k in range(1, 6)}
    return reshape.wider(
        visits(spark, sf_dir), ["record_id"], "timepoint", list(names), F.max("status"), rename=names
    )


@query(
    "semi_and_anti_join",
    """SELECT c_custkey, CASE WHEN c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority =
    '1-URGENT') THEN 'urgent' ELSE 'other' END AS kind FROM customer""",
)
def semi_and_anti_join(spark, sf_dir):
    people = table(spark, sf_dir, "customer").select("c_custkey")
    urgent = (
        table(spark, sf_dir, "orders")
        .where(F.col("o_orderpriority") == "1-URGENT")
        .select(F.col("o_custkey").alias("c_custkey"))
    )
    hit = cohort.semi(people, urgent, "c_custkey").withColumn("kind", F.lit("urgent"))
    miss = cohort.anti(people, urgent, "c_custkey").withColumn("kind", F.lit("other"))
    return hit.unionByName(miss)


@query(
    "membership_flag",
    """SELECT c_custkey, CASE WHEN c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')
    THEN 1 ELSE 0 END AS has_closed FROM customer""",
)
def membership_flag(spark, sf_dir):
    people = table(spark, sf_dir, "customer").select("c_custkey")
    closed = (
        table(spark, sf_dir, "orders")
        .where(F.col("o_orderstatus") == "F")
        .select(F.col("o_custkey").alias("c_custkey"))
    )
    return cohort.mark_ids(people, closed, "c_custkey", "has_closed")


@query(
    "stack_different_shapes",
    """SELECT c_name AS name, c_acctbal AS balance, c_mktsegment AS segment FROM customer
    UNION ALL SELECT s_name, s_acctbal, NULL FROM supplier""",
)
def stack_different_shapes(spark, sf_dir):
    buyers = table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"),
        F.col("c_mktsegment").alias("segment"),
    )
    sellers = table(spark, sf_dir, "supplier").select(
        F.col("s_acctbal").alias("balance"), F.col("s_name").alias("name")
    )
    return reshape.stack([buyers, sellers])


@query(
    "bind_columns_by_key",
    f"""WITH {cte('patient')} SELECT p.record_id, CAST(p.patient_age AS DOUBLE) AS patient_age,
      CAST(q.lonely AS DOUBLE) AS lonely FROM patient p
    JOIN patient q ON p.record_id = q.record_id""",
)
def bind_columns_by_key(spark, sf_dir):
    form = view(spark, sf_dir, "patient")
    return reshape.bind_by_key(
        form.select("record_id", F.col("patient_age").cast("double").alias("patient_age")),
        form.select("record_id", F.col("lonely").cast("double").alias("lonely")),
        ["record_id"],
    )


@query(
    "unpivot_items",
    f"""WITH {cte('staff')} SELECT pcc_or_mdc, item, CAST(value AS DOUBLE) AS value, COUNT(*) AS n FROM (
      SELECT pcc_or_mdc, UNNEST(['prefer_not', 'irritate', 'extra_time']) AS item,
             UNNEST([prefer_not, irritate, extra_time]) AS value FROM staff) GROUP BY ALL""",
)
def unpivot_items(spark, sf_dir):
    long = reshape.longer(
        view(spark, sf_dir, "staff"), ["pcc_or_mdc"], ["prefer_not", "irritate", "extra_time"]
    )
    return long.groupBy("pcc_or_mdc", "item", F.col("value").cast("double").alias("value")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    "answers_to_columns",
    """WITH a AS (SELECT user_id, event_type, value, ROW_NUMBER() OVER (PARTITION BY user_id, event_type
        ORDER BY ts, event_id) AS rn FROM events)
    SELECT user_id, MAX(value) FILTER (event_type = 'signup') AS signup,
      MAX(value) FILTER (event_type = 'view') AS view, MAX(value) FILTER (event_type = 'error') AS error
    FROM a WHERE rn = 1 GROUP BY user_id""",
)
def answers_to_columns(spark, sf_dir):
    return reshape.answers_wide(
        table(spark, sf_dir, "events"), ["user_id"], "event_type", "value",
        ["signup", "view", "error"], order=["ts", "event_id"],
    )


@query(
    "presence_matrix",
    f"""WITH {visits_cte()} SELECT record_id, """
    + ", ".join(
        f"CAST(COALESCE(MAX(CASE WHEN redcap_event_name = '{e}' THEN 1 END), 0) AS INT) AS {e}"
        for e in EVENTS
    )
    + " FROM visits GROUP BY record_id",
)
def presence_matrix(spark, sf_dir):
    return reshape.wider(visits(spark, sf_dir), ["record_id"], "redcap_event_name", EVENTS, F.max(F.lit(1)), fill=0)


@query(
    "visit_dates",
    f"""WITH {visits_cte()}, w AS (SELECT record_id, """
    + ", ".join(f"CAST(MIN(first_ts) FILTER (timepoint = {k}) AS DATE) AS d{k}" for k in range(1, 6))
    + """ FROM visits GROUP BY record_id) SELECT record_id, CAST(d1 AS VARCHAR) AS t1_date, """
    + ", ".join(f"CAST(DATE_DIFF('day', d1, d{k}) AS DOUBLE) AS days_to_t{k}" for k in range(2, 6))
    + " FROM w",
)
def visit_dates(spark, sf_dir):
    names = {k: f"t{k}_date" for k in range(1, 6)}
    wide = reshape.wider(
        visits(spark, sf_dir), ["record_id"], "timepoint", list(names),
        F.to_date(F.min("first_ts")), rename=names,
    )
    return wide.select(
        "record_id",
        F.col("t1_date").cast("string").alias("t1_date"),
        *[
            F.datediff(f"t{k}_date", "t1_date").cast("double").alias(f"days_to_t{k}")
            for k in range(2, 6)
        ],
    )


@query(
    "harmonise_visits",
    f"""WITH {cte('patient')} SELECT record_id, timepoint,
    CASE timepoint WHEN 1 THEN serious_pcc WHEN 5 THEN serious_mdc END AS serious,
    CASE timepoint WHEN 1 THEN talk_pcc WHEN 5 THEN talk_mdc END AS talk FROM patient""",
)
def harmonise_visits(spark, sf_dir):
    form = view(spark, sf_dir, "patient").select(
        "record_id", "timepoint", "serious_pcc", "talk_pcc", "serious_mdc", "talk_mdc"
    )
    return reshape.harmonise(
        form,
        ["record_id"],
        "timepoint",
        {
            1: {"serious_pcc": "serious", "talk_pcc": "talk"},
            5: {"serious_mdc": "serious", "talk_mdc": "talk"},
        },
    )
