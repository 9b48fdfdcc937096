"""Languages: n-grams and scores against a plain version, held-out accuracy, odd rows."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from sondage.llm import language_id
from sondage.llm.language_id import Bayes, Model, _Letters, predict, text_buckets, totals, train

SF = "/root/testdata/sf0.01"


def plain_grams(text, sizes):
    """n-grams of a text by str methods alone."""
    words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    line = " " + " ".join(words) + " " if words else ""
    return Counter(line[k : k + n] for n in sizes for k in range(len(line) - n + 1) if line[k : k + n] != " ")


def bucket(gram, buckets):
    (b,) = language_id.buckets_of(np.array([ord(c) for c in gram], np.uint32), (len(gram),), buckets, 0)
    return int(b)


TEXTS = ["", " 12 !", "Hé, l'été 3x", "a", "漢字かな ÀÉ ß İstanbul", "x" * 40 + " yz. " * 30]


@pytest.mark.parametrize("piece", [1 << 19, 7, 1])
def test_grams_are_those_of_the_plain_version(monkeypatch, piece):
    monkeypatch.setattr(language_id, "PIECE", piece)
    for text in [t.replace("İ", "I") for t in TEXTS]:
        found = Counter(b for part in text_buckets(text.encode(), (1, 2, 3), 1 << 16, _Letters()) for b in part.tolist())
        wanted = Counter()
        for gram, n in plain_grams(text, (1, 2, 3)).items():
            wanted[bucket(gram, 1 << 16)] += n
        assert found == wanted, text[:20]


def plain_model(rows, p):
    """Priors and log-probabilities by counting every n-gram in a dictionary."""
    langs = sorted({y for _, y in rows})
    counts = {y: Counter() for y in langs}
    for text, y in rows:
        for gram, n in plain_grams(text, p.sizes).items():
            counts[y][bucket(gram, 1 << p.bits)] += n
    size = {y: sum(c.values()) + p.smoothing * (1 << p.bits) for y, c in counts.items()}
    prior = {y: math.log(sum(z == y for _, z in rows) / len(rows)) for y in langs}
    return langs, prior, lambda y, b: math.log((counts[y][b] + p.smoothing) / size[y])


def test_whole_result_against_the_plain_version(spark):
    p = Bayes(bits=10)
    rows = [(k, t, y) for k, (t, y) in enumerate([("the hat and cat", "en"), ("le chat et la", "fr"), ("that is this", "en"), ("der die und", "de"), ("où est été", "fr")])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    new = ["that hat", "la la été", "und der", "12", "", None, "zzz"]
    asked = spark.createDataFrame(list(enumerate(new)), "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in predict(asked, train(docs, p)).collect()}
    langs, prior, weight = plain_model([(t, y) for _, t, y in rows], p)
    for k, text in enumerate(new):
        grams = plain_grams(text or "", p.sizes)
        if not grams:
            assert (got[k]["lang_pred"], got[k]["score"]) == ("und", 0.0)
            continue
        total = {y: prior[y] + sum(n * weight(y, bucket(g, 1 << p.bits)) for g, n in grams.items()) for y in langs}
        best = max(langs, key=lambda y: total[y])
        assert got[k]["lang_pred"] == best
        assert got[k]["score"] == pytest.approx(1 / sum(math.exp(total[y] - total[best]) for y in langs), rel=1e-4)


def test_held_out_accuracy_and_contract(spark):
    from sondage.llm.queries import QUERIES

    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang", "text").collect()}
    got = QUERIES["op13_language_id"](spark, SF).collect()
    assert len(got) == len(docs)
    right = total = 0
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1
        has_letter = any(c.isalpha() for c in docs[r["doc_id"]]["text"] or "")
        assert (r["lang_pred"] == "und") == (not has_letter)
        if r["held_out"] and has_letter:
            total += 1
            right += r["lang_pred"] == docs[r["doc_id"]]["lang"]
    assert total > 150 and right / total > 0.97


def test_labels_of_held_out_rows_do_not_matter(spark):
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    held = language_id.held_out(F.col("doc_id"), 4, 2)
    other = docs.withColumn("lang", F.when(held, F.lit("xx")).otherwise(F.col("lang")))
    pick = lambda d: sorted(tuple(r) for r in language_id.learn_and_predict(d).collect())
    assert pick(docs) == pick(other)


def test_odd_rows(spark, odd_docs, no_docs):
    model = Model(("aa", "bb"), np.zeros(2, np.int64), np.zeros((256, 2), np.int64), (1, 2, 3))
    got = predict(odd_docs, model)
    assert got.count() == odd_docs.count()
    tied = {r["doc_id"]: r for r in got.collect()}
    assert tied[6]["lang_pred"] == "aa" and tied[6]["score"] == 0.5  # a tie goes to the first
    assert tied[2]["lang_pred"] == tied[3]["lang_pred"] == tied[4]["lang_pred"] == "und"
    assert predict(no_docs, model).count() == 0
    assert train(no_docs.selectExpr("doc_id", "text", "'x' lang")) is None
    assert {r["lang_pred"] for r in predict(odd_docs, None).collect()} == {"und"}
    one = odd_docs.selectExpr("doc_id", "text", "if(doc_id = 1, 'aa', null) lang", "hits")
    assert train(one).languages == ("aa",)


def test_one_token_of_many_megabytes():
    model = Model(("aa", "bb"), np.zeros(2, np.int64), np.stack([np.arange(256), np.ones(256)], 1).astype(np.int64), (1, 2, 3))
    sums, grams = totals([b"x" * 5_000_000], model, _Letters())
    assert grams[0] == 5_000_000 + 5_000_001 + 5_000_000
    assert sums[0, 1] == grams[0]


def test_matrix_stays_within_its_cells():
    assert Bayes().buckets(4) == 1 << 16 and Bayes().buckets(200) * 200 <= Bayes().cells
    with pytest.raises(ValueError):
        Bayes().buckets(100_000)
