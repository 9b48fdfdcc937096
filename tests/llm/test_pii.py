"""Personal data: base spans against a plain search, and what the trees add."""

import random
import re

import pytest
from pyspark.sql import functions as F

from sondage.llm import pii as P

PARTS = [
    "mail a.b+c@ex-ample.co.uk.", "x@y", "a@b.c_d@e.f", "@@", "1.2.3.4.5", "256.1.1.1", "001.02.3.255", "1.2.3", "4111 1111 1111 1111",
    "4111-1111-1111-1112", "4111111111111111 0", "+1 (212) 555-0199", "+49 30 1234567x", "+1 2", "+12345678901234567", "call (212) 555-0199", "é🙂",
    "word", "in 1999", "call +44 20 7946 0958 now", "192.168.0.1:80", "joe (at) example (dot) org",
]


def luhn(s):
    total = 0
    for i, d in enumerate([int(c) for c in s if c.isdigit()][::-1]):
        d = d * 2 if i % 2 else d
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def n_digits(s):
    return sum("0" <= c <= "9" for c in s)


def plain(text):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 12 <= n_digits(m[0]) <= 19 and luhn(m[0])]
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= n_digits(m[0]) <= 15]
    return sorted(out, key=lambda s: (s[1], ["email", "ip", "card", "phone"].index(s[0])))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(11)
    out = ["", None, *PARTS]
    for _ in range(150):
        out.append(rng.choice([" ", "", ", "]).join(rng.choice(PARTS) for _ in range(rng.randint(1, 8))))
    return out


def base_of(found):
    return [(s["kind"], s["start"], s["end"]) for s in found if s["rank"] < 4]


def test_base_spans_equal_a_plain_search(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    for learn in (False, True):
        added = 0
        for r in P.find(docs, learn=learn).collect():
            assert base_of(r["found"]) == plain(texts[r["doc_id"]] or "")
            base = base_of(r["found"])
            more = [s for s in r["found"] if s["rank"] >= 4]
            added += len(more)
            assert not any(s["start"] < e and b < s["end"] for s in more for _, b, e in base)
        assert learn or not added


def test_trees_select_looser_forms_that_look_like_the_rules(spark):
    """Phone numbers that differ from the rule in nothing the features see are added; dates are not."""
    rng = random.Random(12)
    tail = lambda: f"({rng.randint(200, 999)}) {rng.randint(200, 999)}-{rng.randint(1000, 9999)}"
    rows = [(k, f"please call tel +1 {tail()} today") for k in range(300)] + [(k, f"on {rng.randint(10, 28)}/{rng.randint(10, 12)} we had {rng.randint(10, 99)}.{rng.randint(10, 99)} left") for k in range(300, 600)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    selector = P.train(docs)
    assert selector and len(selector.trees) > 1 and selector.threshold < 1
    found = P.find(docs, selector=selector)
    assert found.where("doc_id >= 300 and size(found) > 0").count() == 0
    assert found.where("doc_id < 300 and size(found) = 0").count() == 0


def test_pieces_of_personal_data_are_no_negatives(spark):
    """Loose candidates on a span that meets its rule are left out; the looser forms stated here are selected."""
    rng = random.Random(13)
    tail = lambda: f"({rng.randint(200, 999)}) {rng.randint(200, 999)}-{rng.randint(1000, 9999)}"
    name = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(4, 8)))
    texts = [f"please call tel +1 {tail()} today" for _ in range(200)] + [f"mail me: {name()}.{name()}@{name()}.com now" for _ in range(200)]
    texts += [f"host ip {rng.randint(1, 255)}.{rng.randint(1, 255)}.{rng.randint(1, 255)}.{rng.randint(1, 255)} is up" for _ in range(200)]
    negatives = [f"on {rng.randint(10, 28)}/{rng.randint(10, 12)} we had {rng.randint(10, 99)}.{rng.randint(10, 99)} left" for _ in range(200)]
    docs = spark.createDataFrame(list(enumerate(texts + negatives)), "doc_id bigint, text string")
    rows = P.training_rows(docs, "doc_id", "text", 1000, 100_000)
    assert {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()} == {1.0: 600, 0.0: 400}
    assert not {"plus", "at", "luhn"} & set(rows.columns)
    looser = ["please call tel (212) 555-0199 today", "mail me: joe.smith (at) example (dot) org now", "on 12/11 we had 45.67 left"]
    found = P.find(spark.createDataFrame(list(enumerate(looser)), "doc_id bigint, text string"), selector=P.train(docs))
    kinds = {r["doc_id"]: {s["kind"] for s in r["found"]} for r in found.collect()}
    assert "phone_like" in kinds[0] and kinds[1] == {"email_like"} and kinds[2] == set()


def test_trees_are_trained_on_all_documents(spark, monkeypatch):
    """Each candidate of 24,000 documents counts, and what few of them hold is learnt."""
    docs = spark.range(24_000).selectExpr(
        "id as doc_id", "CASE WHEN id % 12 = 0 THEN concat('on 1', id % 10, '/12 left') WHEN id % 12 = 1 THEN 'joe (at) example (dot) org' ELSE concat('host ip 10.0.', id % 200, '.7 up') END as text"
    )
    seen, keep = [], P.kept_table
    monkeypatch.setattr(P, "kept_table", lambda frame, name: seen.append(keep(frame, name)) or seen[-1])
    assert P.train(docs)
    (rows,) = seen
    assert {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.sum("weight").alias("n")).collect()} == {1.0: 20_000, 0.0: 4_000}
    assert rows.count() < 100


def test_counted_candidates_grow_the_trees_of_single_ones(spark, texts):
    """Weights stand for repeated rows: documents three times over give the same trees and threshold."""
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    once, often = P.train(docs), P.train(docs.union(docs).union(docs))
    names = lambda node: (node[0], node[1], names(node[2]), names(node[3])) if isinstance(node, tuple) else None
    assert [names(t) for t in once.trees] == [names(t) for t in often.trees]


@pytest.mark.parametrize(
    "text,expected",
    [
        ("1-" * 200_000 + "1", []),
        ("a" * 300_000, []),
        ("a@" + "b." * 150_000 + "c", [("email", 0, 300_003)]),
        ("a@b.c " * 5_000, [("email", 6 * k, 6 * k + 5) for k in range(5_000)]),
        ("+" * 100_000 + "1" * 100_000, []),
        ("(12) " * 60_000, []),
        ("12 " * 60_000 + "x 4111 1111 1111 1111", [("card", 180_002, 180_021)]),
    ],
)
def test_very_long_texts(spark, text, expected):
    """Text whose plain search would take quadratic time."""
    docs = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    assert base_of(P.find(docs, learn=False).first()["found"]) == expected


def test_odd_documents(odd_docs, no_docs, spark):
    assert P.find(odd_docs).count() == odd_docs.count()
    assert P.find(no_docs).count() == 0
    docs = spark.createDataFrame([(None, "x é a@b.cd! +1 212 555 0199.")], "doc_id bigint, text string")
    assert P.redact(docs, learn=False).first()["text"] == "x é [PII]! [PII]."
    assert P.redact(odd_docs, learn=False).columns == odd_docs.columns
