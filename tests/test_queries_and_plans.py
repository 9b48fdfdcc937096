"""The registry, a few queries against their checks, and the shape of plans."""

import os
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from sondage.operators import cohort, ranks, stats, summary
from sondage.plans import report

ROOT = Path(__file__).resolve().parent.parent
SF = "/root/testdata/sf0.001"
SOME = [
    "keyword_exclusion",
    "fill_up_then_down",
    "visit_window_states",
    "answers_to_columns",
    "understanding_scores",
    "summary_by_group",
    "continuous_summary",
    "likert_grid",
    "kruskal_wallis_test",
]
needs_data = pytest.mark.skipif(not Path(SF).is_dir(), reason="test tables are not here")


def test_registry_loads_without_a_session():
    code = "import __spark_entry__ as e; assert set(e.oracle_sql()) <= set(e.queries())"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=ROOT)


def test_tests_run_from_another_folder(tmp_path):
    """Python workers find the package though the session starts elsewhere."""
    code = f"""
import sys
sys.path.insert(0, {str(ROOT)!r})
from sondage.session import local_session
from sondage.operators import stats
spark = local_session(2)
rows = [("ab"[k % 2], "xyz"[k % 3]) for k in range(60)]
found = stats.categorical_test(spark.createDataFrame(rows, "g string, v string"), ["v"], "g").first()
assert found["p_value"] > 0.99, found
"""
    subprocess.run([sys.executable, "-c", code], check=True, cwd=tmp_path)


@needs_data
def test_entry(spark):
    assert entry.entry(spark).count() > 0


@needs_data
@pytest.mark.parametrize(
    "name", sorted(entry.queries()) if os.environ.get("ALL_QUERIES") else SOME
)
def test_query_agrees_with_its_check(spark, name):
    pytest.importorskip("duckdb")
    from tools.compare import compare, connect

    assert compare(spark, connect(SF), SF, name) is None


def executed(df):
    """The physical plan after the run, without the plan it started from."""
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan")[0]


@pytest.fixture
def stored(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(4000).select(
        "id",
        (F.col("id") % 3).cast("string").alias("g"),
        (F.col("id") % 7).cast("string").alias("a"),
        F.when(F.col("id") % 5 > 0, F.col("id") % 2).cast("string").alias("b"),
        (F.col("id") * 37 % 1009).cast("double").alias("v"),
    ).write.parquet(path)
    return spark.read.parquet(path)


def test_summary_reads_the_survey_once(stored):
    plan = executed(summary.categorical(stored, ["a", "b"], by="g", values={"b": "1"}))
    assert plan.count("FileScan") == 1
    assert "id" not in plan.split("ReadSchema:")[1].split("\n")[0]


def test_tests_read_the_survey_once(stored):
    assert executed(stats.categorical_test(stored, ["a", "b"], "g")).count("FileScan") == 1
    assert executed(stats.t_test(stored, ["v"], "g", ("0", "1"))).count("FileScan") == 1


def test_ranks_read_the_survey_once(stored):
    assert executed(ranks.percentiles(stored, "v", {"m": 0.5}, ["g"])).count("FileScan") == 1
    # A third of the rows share one group; no window may be over the group alone.
    plan = ranks.ranked_counts(stored, "v", ["g"])._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.split("\n") if "Window [" in line and "sum(n" in line]
    assert windows and all("_slice" in line for line in windows)


def test_report_shares_counts_between_table_and_tests(stored):
    spec = report.Report(categorical=["a"], dichotomous={"b": "1"}, levels=["0", "1", "2"])
    rules = {"x": report.Rule("g", show_p=True, first_visit=False)}
    assert executed(report.run(stored, spec, "x", rules)).count("FileScan") == 1


def test_filters_reach_the_scan(stored):
    plan = executed(cohort.until(stored.where("v > 1000"), "g", "2020-01-01").select("id"))
    assert "GreaterThan(v,1000.0)" in plan
