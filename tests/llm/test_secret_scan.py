"""Secret scans against a plain search of every text."""

import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sondage.llm import secret_scan as S
from sondage.llm import spans

KEY = "AbCd+/012345=_.-xyz"
SAMPLES = [
    "password = 'hunter2hunter2'",
    'API_KEY:"abcdefghijklmnop"',
    "token = short; token=abcdefghijkl",
    "password: token: abcdefghijklmnop",
    "AKIAAKIA" + "Z" * 20,
    "AKIA" + "A" * 13,
    "0123456789abcdef0",
    "0123456789abcde",
    "secret\x20\x20=\x20\x20" + KEY,
    "Passwd=" + "f" * 40,
    "ghp_" + "a1" * 18,
    "é🙂 token=" + "9" * 12 + " é",
    "-----BEGIN RSA PRIVATE KEY-----",
    "https://user:pa55word@example.org/",
]


def plain(text):
    out = [("assign", m.start(), m.end()) for m in re.finditer(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text) if len(m[2]) >= 12]
    out += [("access", m.start(), m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    out += [("hex", m.start(), m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 16]
    out += [(r.kind, m.start(), m.end()) for r in S.MORE for m in re.finditer(r.pattern, text, re.A)]
    kinds = [r.kind for r in (*S.BASE, *S.MORE)]
    return sorted(out, key=lambda s: (s[1], kinds.index(s[0])))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(9)
    out = ["", None, *SAMPLES]
    for _ in range(60):
        out.append(" ".join(rng.choice([*SAMPLES, "plain", "words", "ünïcode", "tok en", "pass word"]) for _ in range(rng.randint(1, 12))))
    return out


@pytest.mark.parametrize("most", [S.BROADCAST_IDS, 0])
def test_spans_equal_a_plain_search(spark, texts, monkeypatch, most):
    monkeypatch.setattr(S, "BROADCAST_IDS", most)
    monkeypatch.setattr(S, "BLOCK", 7)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    for r in S.scan(docs).collect():
        assert [(s["kind"], s["start"], s["end"]) for s in r["found"]] == plain(texts[r["doc_id"]] or "")


@settings(max_examples=100, deadline=None)
@given(st.data())
def test_every_match_meets_the_trigram_query(data):
    rule = data.draw(st.sampled_from([*S.BASE, *S.MORE]))
    match = data.draw(st.from_regex(re.compile(rule.pattern, re.A)))

    def holds(query, text):
        if query is None or isinstance(query, str):
            return query is None or query in text
        return (all if query[0] == "and" else any)(holds(q, text) for q in query[1])

    assert holds(S.trigram_query(rule.pattern), match.lower())


def test_queries_of_expressions():
    assert S.trigram_query("[0-9a-f]{16,}") is None
    assert S.trigram_query("AKIA[A-Z0-9]+") == ("and", ("aki", "kia"))
    assert S.trigram_query("(abc|ab)d?") is None
    assert S.trigram_query("(abc|xyz)[0-9]+") == ("or", ("abc", "xyz"))


def test_odd_documents_and_masks(odd_docs, no_docs, spark):
    found = S.scan(odd_docs)
    assert found.count() == odd_docs.count()
    assert S.scan(no_docs).count() == 0
    masked = S.mask_secrets(odd_docs)
    assert masked.columns == odd_docs.columns
    assert sorted(map(repr, masked.collect())) == sorted(map(repr, odd_docs.collect()))
    docs = spark.createDataFrame([(None, "x é token=" + "a" * 20 + "! y"), (1, "AKIA" + "A" * 16 + " and password=" + "0" * 30)], "doc_id bigint, text string")
    assert sorted(r["text"] for r in S.mask_secrets(docs).collect()) == ["[SECRET] and [SECRET]", "x é [SECRET]! y"]


def test_overlapping_spans_are_masked_once(spark):
    from pyspark.sql import functions as F

    frame = spark.createDataFrame([("0123456789", [(1, 0, "a", 4), (3, 0, "b", 6), (6, 0, "c", 7), (9, 0, "d", 10)])], f"t string, s {spans.SPAN}")
    assert frame.select(spans.masked(F.col("t"), F.col("s"), "#")).first()[0] == "0#78#"
