"""Decontamination against a plain search, on both paths."""

import random
import re

import pytest

from sondage.llm import decontamination as D
from tests.llm.conftest import prose


def plain_words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def plain_hits(text, items):
    words, hit, found = plain_words(text), set(), set()
    for name, item in items:
        w = plain_words(item)
        size = min(13, len(w))
        for k in range(len(w) - size + 1 if w and name is not None else 0):
            for at in range(len(words) - size + 1):
                if words[at : at + size] == w[k : k + size]:
                    hit |= set(range(at, at + size))
                    found.add(str(name))
    return len(words), sorted(hit), sorted(found)


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(3)
    items = [(k, prose(rng, n)) for k, n in enumerate([20, 40, 13, 14, 5, 2])] + [(7, None), (None, prose(rng, 15)), (9, "..."), (10, "Été, NAÏVE")]
    items.append((11, items[0][1]))
    docs = [(k, prose(rng, 100)) for k in range(6)]
    for k in range(6):
        a, b = prose(rng, 30).split(), items[k][1].upper().split()
        docs.append((10 + k, ", ".join(a[:15] + b[: rng.choice([12, 13, 50])] + a[15:])))
    docs += [(20, items[2][1] + " " + items[2][1]), (21, "x Été; naïve-y"), (22, None), (23, ""), (22, None), (None, items[0][1])]
    return docs, items, spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")


@pytest.mark.parametrize("most", [D.BROADCAST_BYTES, 0])
def test_hits_equal_a_plain_search(tables, most):
    docs, items, d, i = tables
    expected = sorted((k is None, k, *plain_hits(t, items)) for k, t in docs)
    got = sorted(
        (r["doc_id"] is None, r["doc_id"], r["n_words"], [w for h in r["hits"] for w in range(h["first"], h["last"] + 1)], r["items"])
        for r in D.find_hits(d, i, broadcast_bytes=most).collect()
    )
    assert got == expected
    assert any(x[3] for x in got)


@pytest.mark.parametrize("most", [D.BROADCAST_BYTES, 0])
def test_odd_documents(odd_docs, no_docs, tables, most):
    found = D.find_hits(odd_docs, tables[3], broadcast_bytes=most)
    assert found.count() == odd_docs.count()
    assert {r["n_words"] for r in found.where("doc_id in (2, 3, 4)").collect()} == {0}
    assert D.find_hits(no_docs, tables[3], broadcast_bytes=most).count() == 0
    assert D.find_hits(odd_docs, tables[3].where("false"), broadcast_bytes=most).where("size(hits) > 0").count() == 0


def test_removal_of_documents_and_spans(tables, odd_docs):
    docs, items, d, i = tables
    kept = D.remove_documents(d, i).collect()
    bad = {k for k, t in docs for n, h, _ in [plain_hits(t, items)] if h and 20 * len(h) >= n}
    assert sorted(str(r["doc_id"]) for r in kept) == sorted(str(k) for k, _ in docs if k not in bad)
    cut = {r["doc_id"]: r["text"] for r in D.remove_spans(d, i).collect()}
    for k, t in docs:
        n, hit, _ = plain_hits(t, items)
        if not hit:
            assert cut[k] == t
        elif k is not None:
            assert plain_words(cut[k]) == [w for at, w in enumerate(plain_words(t)) if at not in hit]
    assert D.remove_documents(odd_docs, i).columns == odd_docs.columns
