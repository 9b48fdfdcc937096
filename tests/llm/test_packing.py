"""Packing: ids as the tokenizer gives them, no gaps, least cost."""

import random
import zlib
from itertools import combinations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sondage.llm import packing
from sondage.llm.queries import tokenizer_path

pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


def plain_ids(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


def check(pieces, texts, tokenizer, length=4096):
    """Pieces cover each text's ids once, and sequences are gapless and not too long."""
    expected = sorted((d is None, d, plain_ids(tokenizer, t)) for d, t in texts)
    by_doc = {}
    for p in pieces:
        by_doc.setdefault((p["doc_id"], p["doc_tokens"]), []).append((p["start"], np.frombuffer(p["ids"], "<u4").tolist(), p["length"]))
    got = []
    for (d, n), parts in by_doc.items():
        parts.sort(key=lambda x: x[0])
        ids = [i for _, part, _ in parts for i in part]
        assert all(len(part) == size for _, part, size in parts)
        # rows that repeat an id and text stand side by side
        got += [(d is None, d, ids[k : k + n]) for k in range(0, len(ids), n)] if len(parts) == 1 or len(ids) == n else []
    sequences = {}
    for p in pieces:
        sequences.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    for parts in sequences.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at <= length
    return expected, sorted(got)


def test_pieces_are_the_tokenizers_ids(spark, tokenizer):
    rng = random.Random(1)
    texts = [(k, " ".join(rng.choice(["It's", "Ünïcode", "naïve,", "a.b", "12,5", "don't.", "word", "x" * 30, "!!", "漢字。"]) for _ in range(rng.choice([0, 3, 50, 900])))) for k in range(60)]
    pieces = packing.pack(spark.createDataFrame(texts, "doc_id bigint, text string").repartition(3), tokenizer_path(), packing.Packing(length=256)).collect()
    expected, got = check(pieces, texts, tokenizer, 256)
    assert got == expected


def test_odd_documents(odd_docs, no_docs, tokenizer):
    texts = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    pieces = packing.pack(odd_docs.coalesce(1), tokenizer_path()).collect()
    assert sum(p["length"] for p in pieces) == sum(len(plain_ids(tokenizer, t)) for _, t in texts)
    long = next(t for d, t in texts if d == 5)
    parts = sorted((p["start"], bytes(p["ids"])) for p in pieces if p["doc_id"] == 5)
    assert len(parts) > 10
    assert np.frombuffer(b"".join(b for _, b in parts), "<u4").tolist() == plain_ids(tokenizer, long)
    assert packing.pack(no_docs, tokenizer_path()).count() == 0


def test_padding_is_small(spark):
    rng = random.Random(2)
    texts = [(k, ". ".join("some plain words here" for _ in range(rng.randint(1, 120)))) for k in range(300)]
    pieces = packing.pack(spark.createDataFrame(texts, "doc_id bigint, text string").coalesce(1), tokenizer_path()).collect()
    sizes = {}
    for p in pieces:
        sizes[p["sequence_id"]] = sizes.get(p["sequence_id"], 0) + p["length"]
    padding = sum(0 if n & (n - 1) == 0 else 4096 - n for n in sizes.values())
    assert padding < 0.01 * sum(sizes.values())


WORDS = packing.WordIds(tokenizer_path())


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("abC'sreve .,\n\t!?-<|>éÉ́ßİ漢12  "), max_size=40), min_size=1, max_size=4))
def test_words_give_the_same_ids_as_whole_texts(texts):
    texts = [*texts, "<|endoftext|> and <|ENDOFTEXT|>"]
    ids, sizes = WORDS.encode([t.encode() for t in texts], 2)
    expected = [[*WORDS.tokenizer.encode(t, add_special_tokens=False).ids, 2] for t in texts]
    assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == expected


@pytest.mark.parametrize("seed", range(8))
def test_cuts_have_the_least_cost(seed):
    rng = random.Random(seed)
    p = packing.Packing(length=16, sequence_cost=1.0)
    total = rng.randint(20, 40)
    position = np.array(sorted({0, total, *range(0, total, 16), *rng.sample(range(1, total), 9)}))
    penalty = np.array([0.0, *(rng.choice([0, 3, 24]) for _ in position[1:-1]), 0.0])
    cost_at = dict(zip(position.tolist(), penalty.tolist(), strict=True))

    def cost(cuts):
        sizes = np.diff(cuts)
        if (sizes > 16).any():
            return np.inf
        return sum((0 if n & (n - 1) == 0 else 16 - n) + p.sequence_cost for n in sizes.tolist()) + sum(cost_at[c] for c in cuts[1:])

    inner = position[1:-1].tolist()
    best = min(cost([0, *c, total]) for k in range(len(inner) + 1) for c in combinations(inner, k))
    assert cost(packing.best_cuts(position, penalty, True, p).tolist()) == pytest.approx(best)


def test_crc_in_the_query(spark):
    text = "One sentence. Another one"
    docs = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    from pyspark.sql import functions as F

    row = packing.pack(docs, tokenizer_path()).select(F.crc32("ids").alias("c"), "ids").first()
    assert row["c"] == zlib.crc32(bytes(row["ids"]))


def test_long_texts_are_encoded_in_pieces(tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "TEXT_BYTES", 64)
    rng = random.Random(3)
    texts = ["", *(" ".join(rng.choice(["It's", "Ünïcode", "x1y2", "漢字。", "don't.", "İx", "<|endoftext|>"]) for _ in range(n)) for n in (3, 40, 7, 200)), "y" * 500]
    ids, sizes = WORDS.encode([t.encode() for t in texts], 2)
    assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == [plain_ids(tokenizer, t) for t in texts]
    assert b"".join(packing.pieces(b"ab cd  ef", 2)) == b"ab cd  ef"


def test_bytes_that_are_no_text_and_a_long_token(tokenizer):
    long = "1+Ab/" * 400_000
    ids, sizes = WORDS.encode([b"ab\xffcd", long.encode()], 2)
    assert ids[: sizes[0]].tolist() == plain_ids(tokenizer, "ab\ufffdcd")
    assert ids[sizes[0] :].tolist() == plain_ids(tokenizer, "1+Ab/" * 10)[:-1] * 40_000 + [2]


def test_blocks_are_carried_on(spark, tokenizer):
    """Documents planned in many small blocks are covered like those planned at once."""
    rng = random.Random(4)
    texts = [(k, " ".join(rng.choice(["alpha", "beta.", "gamma", "x1"]) for _ in range(rng.choice([0, 1, 30, 700, 3000])))) for k in range(40)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string").coalesce(1)
    pieces = packing.pack(docs, tokenizer_path(), packing.Packing(length=128, block=500)).collect()
    expected, got = check(pieces, texts, tokenizer, 128)
    assert got == expected
