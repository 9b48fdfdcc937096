"""Reshaping, filling and cohort rules against plain Python on small frames."""

import random

import pytest
from pyspark.sql import functions as F

from sondage.operators import cohort, columns, fill, reshape
from sondage.sources import tables
from tests.conftest import rows


def brute_fill(values, direction):
    def prev(i):
        return next((values[j] for j in range(i, -1, -1) if values[j] is not None), None)

    def nxt(i):
        return next((v for v in values[i:] if v is not None), None)

    pick = {
        "down": lambda i: prev(i),
        "up": lambda i: nxt(i),
        "updown": lambda i: nxt(i) if nxt(i) is not None else prev(i),
        "downup": lambda i: prev(i) if prev(i) is not None else nxt(i),
    }[direction]
    return [pick(i) for i in range(len(values))]


@pytest.mark.parametrize("direction", ["down", "up", "updown", "downup"])
@pytest.mark.parametrize("chunk", [None, 1, 7, 1000])
def test_fill_matches_brute_force(frame, direction, chunk):
    rng = random.Random(7)
    # Record 0 owns most rows, record 3 has no value at all, one record has no id.
    sizes = {0: 60, 1: 5, 2: 1, 3: 4, None: 12}
    data = {
        r: [None if r == 3 or rng.random() < 0.8 else rng.randint(1, 9) for _ in range(n)]
        for r, n in sizes.items()
    }
    # The first row of each record has no time: it comes before all others.
    shuffled = [(r, i or None, v) for r, vs in data.items() for i, v in enumerate(vs)]
    rng.shuffle(shuffled)
    df = frame("r int, t int, v int", *shuffled)
    options = {"chunk": F.floor(F.col("t") / chunk)} if chunk else {}
    out = fill.fill_within(df, ["r"], ["t"], ["v"], direction, **options)
    assert out.columns == ["r", "t", "v"]
    want = [(r, i or None, v) for r, vs in data.items() for i, v in enumerate(brute_fill(vs, direction))]
    assert rows(out) == sorted(want, key=repr)


def test_record_first_equals_fill_and_first_row(frame):
    df = frame("r int, t int, v string, w int", (1, 1, None, 5), (1, 2, "b", 6), (1, 3, "c", None),
               (2, 1, None, None))
    filled = fill.fill_within(df, ["r"], ["t"], ["v", "w"])
    first = cohort.first_row(filled, ["r"], ["t"], ["v", "w"])
    assert rows(cohort.record_first(df, "r", ["t"], ["v", "w"])) == rows(first)
    assert rows(first) == [(1, "b", 5), (2, None, None)]


def test_exclusion_removes_whole_records(frame):
    df = frame("r int, name string, note string", (1, "Test A", None), (1, None, "x"),
               (2, "Ann", "DUPLICATE of 1"), (3, None, None), (None, "Bob", None))
    kept = cohort.exclude_flagged(df, "r", {"name": "test"}, {"note": "duplicate"})
    assert rows(kept, "r") == [(3,), (None,)]


def test_group_of_four_is_dropped_and_of_five_kept(frame):
    df = frame("g string", *[("a",)] * 4, *[("b",)] * 5, (None,))
    assert rows(cohort.large_groups(df, "g", 5)) == [("b",)] * 5


@pytest.mark.parametrize(
    "days, status, want",
    [
        (89, None, "Not due for T2"),
        (90, None, "Incomplete (within window)"),
        (103, None, "Incomplete (within window)"),
        (104, None, "Incomplete (past window)"),
        (103, "Incomplete", "Incomplete"),
        (104, "Incomplete", "Incomplete (past window)"),
        (200, "Complete", "Complete"),
        (None, None, None),
    ],
)
def test_visit_window_edges(frame, days, status, want):
    df = frame("days int, s string, blocked boolean", (days, status, False), (days, status, True))
    out = df.select(cohort.visit_status("s", "days", 90, 14, "T2", F.col("blocked"))).collect()
    assert [r[0] for r in out] == [want, "Incomplete T1 PASC"]


def test_last_completed_is_per_record(frame):
    df = frame("r int, t int, a string, b string, e string", (1, 1, "Complete", None, "t1"),
               (1, 2, None, "Complete", "t2"), (1, 3, "Incomplete", None, "t3"),
               (2, 1, "Complete", None, "t1"), (2, None, "Complete", None, "pre"))
    assert rows(cohort.last_completed(df, "r", "t", ["a", "b"], "e")) == [(1, "t2"), (2, "t1")]


def test_checks_fail_the_run(frame):
    df = frame("r int, n string, s string", (1, None, "Complete"), (2, "x", "Complete"))
    broken = cohort.violations(df, {"no name": F.col("n").isNull()}, ["r"])
    assert rows(broken) == [(1, "no name")]
    with pytest.raises(cohort.CheckFailed, match="no name"):
        cohort.require_none(broken, "no name")
    cohort.require_none(broken.where("r > 5"), "fine")
    assert rows(cohort.repeated(df, ["s"])) == [("Complete", 2)]


def test_funnel_is_nested(frame):
    df = frame("c string, d string", ("y", "Complete"), (None, "Complete"), ("y", None))
    out = cohort.funnel(df, {"consented": F.col("c").isNotNull(), "done": F.col("d") == "Complete"})
    got = out.first()
    assert (got["n_records"], got["n_consented"], got["n_done"]) == (3, 2, 1)
    assert got["rate_done"] == 0.5


def test_unpivot_pivot_round_trip(frame):
    df = frame("r int, a int, b double", (1, 2, 3.5), (2, None, 1.0))
    long = reshape.longer(df, ["r"], ["a", "b"])
    assert rows(long) == [(1, "a", 2.0), (1, "b", 3.5), (2, "a", None), (2, "b", 1.0)]
    wide = reshape.wider(long, ["r"], "item", ["a", "b"], F.first("value"))
    assert rows(wide) == [(1, 2.0, 3.5), (2, None, 1.0)]


def test_answers_wide_keeps_one_row_per_person(frame):
    df = frame("p string, q string, v string, t int", ("x", "Q A", "1", 1), ("x", "Q A", "2", 2),
               ("x", "Q B", "3", 1), ("y", "Q B", "4", 1))
    last = reshape.answers_wide(df, ["p"], "q", "v", ["Q A", "Q B"], "last", ["t"])
    assert last.columns == ["p", "Q_A", "Q_B"]
    assert rows(last) == [("x", "2", "3"), ("y", None, "4")]


def test_harmonise_takes_each_rows_own_block(frame):
    df = frame("r int, t int, a string, a_t5 string, z int", (1, 1, "x", None, 0), (1, 5, None, "y", 0),
               (1, 2, "lost", None, 0))
    out = reshape.harmonise(df, ["r"], "t", {1: {"a": "a"}, 5: {"a_t5": "a"}})
    assert rows(out, "t", "a") == [(1, "x"), (2, None), (5, "y")]
    assert "a_t5" not in out.columns and "z" in out.columns


def test_stack_and_bind(frame):
    a, b = frame("r int, x int", (1, 1)), frame("r int, y int", (2, 2))
    assert rows(reshape.stack([a, b])) == [(1, 1, None), (2, None, 2)]
    c = frame("r int, y int", (1, 9))
    assert rows(reshape.bind_by_key(a, c, ["r"])) == [(1, 1, 9)]


def test_column_helpers(frame):
    df = frame("ps_a_burden int, ps_b int, z int", (1, 2, 3))
    assert columns.starting(df, "ps_") == ["ps_a_burden", "ps_b"]
    assert columns.ending(df, "_burden") == ["ps_a_burden"]
    assert columns.span(df, "ps_b", "z") == ["ps_b", "z"]
    assert columns.rename_by_pattern(df, "_[^_]*$", "").columns == ["ps_a", "ps", "z"]
    assert columns.rename_in_order(df, ["a", "b", "c"]).columns == ["a", "b", "c"]
    assert columns.dictionary(df, df.toDF("A", "B", "C")) == {
        "ps_a_burden": "A", "ps_b": "B", "z": "C",
    }
    assert columns.label_header(df, {"z": "Zed"}).columns[-1] == "Zed"
    entries = frame("`Row Name` string, `Row Display Name` string", ("z", "Zed"), ("q", "Cue"))
    assert columns.labels_for(entries, ["z"], "Row Name", "Row Display Name") == {"z": "Zed"}


def test_merge_encodings_restores_order(frame):
    label = frame("r int, a string, b string, c string", (1, "x", "Checked", "y"))
    raw = frame("b int, r int", (1, 1))
    merged = tables.merge_encodings(label, raw, ["r"], ["b"])
    assert merged.columns == ["r", "a", "b", "c"]
    assert rows(merged) == [(1, "x", 1, "y")]


def test_csv_round_trip_keeps_text(spark, frame, tmp_path):
    text = 'says "hi", and\nleaves'
    df = frame("r int, t string", (1, text), (2, None))
    tables.write_table(df, str(tmp_path / "out"), "csv")
    back = tables.read_csv(spark, str(tmp_path / "out"), "r int, t string")
    assert rows(back) == [(1, text), (2, None)]
    wrong = tables.read_csv(spark, str(tmp_path / "out"), "r int, other string")
    with pytest.raises(Exception):
        wrong.collect()


def test_partitioned_parquet_sink(spark, frame, tmp_path):
    df = frame("r int, g string", (1, "a"), (2, "b"))
    tables.write_table(df, str(tmp_path / "p"), partition_by=["g"])
    assert rows(tables.read_export(spark, str(tmp_path / "p"), record="r"), "record_id") == [(1,), (2,)]
    assert (tmp_path / "p" / "g=a").is_dir()
