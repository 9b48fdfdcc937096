"""Spans of expressions: positions, merging and masking against plain versions, short and long."""

import re
import time

import pytest
from pyspark.sql import functions as F

from sondage.llm import spans

PATTERN = r"[a-z0-9]+@[a-z]+"
SPANS = "array<struct<start:int,rank:int,kind:string,end:int>>"


def text_of(n):
    return "é x" + "".join(f" ab{k}@cd, 🙂" for k in range(n))


def found(spark, text):
    d = spark.createDataFrame([(text,)], "t string")
    hits = spans.find(F.col("t"), PATTERN, before=2, after=2)
    row = d.select("t", hits.alias("f")).select("f", spans.masked(F.col("t"), spans.as_spans(F.col("f"), "e", 1), "[M]").alias("m")).first()
    return [tuple(x) for x in row["f"]], row["m"]


@pytest.mark.parametrize("n", [0, 1, 255, 256, 257, 1500])
def test_find_and_mask(spark, n):
    t = text_of(n)
    hits, out = found(spark, t)
    assert hits == [(m.start(), m.end(), m.group(), t[max(0, m.start() - 2) : m.start()], t[m.end() : m.end() + 2]) for m in re.finditer(PATTERN, t)]
    assert out == re.sub(PATTERN, "[M]", t)


def test_merging(spark):
    pairs = [(0, 5), (3, 4), (5, 9), (12, 14), (13, 20), (30, 31)]
    many = [(k * 3, k * 3 + (9 if k % 100 == 0 else 2)) for k in range(700)]
    for some in (pairs, many, []):
        wanted = []
        for a, b in some:
            if wanted and a <= wanted[-1][1]:
                wanted[-1][1] = max(b, wanted[-1][1])
            else:
                wanted.append([a, b])
        d = spark.createDataFrame([([(a, 0, "k", b) for a, b in some],)], f"s {SPANS}")
        assert [list(x) for x in d.select(spans.merged(F.col("s")).alias("m")).first()["m"]] == wanted


def test_time_grows_with_the_matches(spark):
    def seconds(n):
        began = time.perf_counter()
        assert len(found(spark, text_of(n))[0]) == n
        return time.perf_counter() - began

    seconds(2500)
    assert seconds(40_000) < 8 * 2.2 * max(seconds(5000), 0.3)
