"""Near-duplicate groups against all pairs, with groups of copies of every size."""

import random
import re

import numpy as np
import pytest

from sondage.llm import near_dedup as N
from tests.llm.conftest import prose


def plain_sets(texts, size):
    out = []
    for t in texts:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        w = re.findall(r"[^\x20\x09-\x0D]+", low)
        k = min(size, len(w))
        out.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set())
    return out


def plain_groups(docs, size):
    """Smallest id reachable for each row, by all pairs."""
    sets = plain_sets([t for _, t in docs], size)
    root = list(range(len(docs)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(docs)):
        for b in range(a):
            shared = len(sets[a] & sets[b])
            if docs[a][0] is not None and docs[b][0] is not None and shared and 100 * shared >= 80 * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    least = {}
    for k, (d, _) in enumerate(docs):
        if d is not None:
            least[find(k)] = min(d, least.get(find(k), d))
    return [(d, len(sets[k]), None if d is None else least[find(k)]) for k, (d, _) in enumerate(docs)]


def edited(rng, text, n):
    words = text.split(" ")
    for _ in range(n):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
    return " ".join(words)


@pytest.fixture(scope="module")
def docs():
    rng = random.Random(7)
    texts = [prose(rng, rng.randint(1, 120)) for _ in range(60)]
    hot = prose(rng, 150)
    texts += [hot] * 40 + [hot.upper().replace(" ", "\n ") for _ in range(10)]
    texts += [edited(rng, hot, rng.randint(1, 6)) for _ in range(80)]
    chain = prose(rng, 100)
    for _ in range(25):
        chain = edited(rng, chain, 2)
        texts.append(chain)
    texts += [edited(rng, texts[rng.randrange(60)], 1) for _ in range(60)]
    texts += ["a b c d e f g h", "h g f e d c b a", "same", "SAME", "", None, " ", "same "]
    ids = list(range(100, 100 + len(texts)))
    rng.shuffle(ids)
    return list(zip(ids, texts, strict=True))


@pytest.mark.parametrize("size", [4, 5])
def test_groups_equal_all_pairs(spark, docs, size):
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4)
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in N.group(frame, N.Hamming(words=size)).collect())
    assert got == sorted((d, n, c, d == c) for d, n, c in plain_groups(docs, size))


def test_odd_documents(odd_docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in N.group(odd_docs).collect()), key=repr)
    assert got == sorted(plain_groups(rows, 5), key=repr)
    assert N.group(no_docs).count() == 0
    one = N.keep_one(odd_docs)
    assert one.columns == odd_docs.columns
    assert sorted((str(r["doc_id"]) for r in one.collect())) == ["1", "2", "3", "4", "5", "6", "6", "7", "None", "None"]


def test_a_pair_within_the_distance_always_meets():
    """By the pigeonhole principle, for any signatures."""
    p = N.Hamming()
    rng = np.random.default_rng(1)
    for _ in range(500):
        a = rng.integers(0, 1 << p.bits, p.symbols)
        b = a.copy()
        b[rng.choice(p.symbols, p.distance, replace=False)] += 1
        chunks = (a != b).reshape(p.chunks, p.width).sum(axis=1)
        assert chunks.min() <= 1


def test_components_of_stars_chains_and_rings(spark):
    rng = random.Random(8)
    links = [(0, k) for k in range(1, 200)] + [(k, k + 1) for k in range(300, 420)] + [(k, (k - 500 + 1) % 40 + 500) for k in range(500, 540)]
    links += [(600 + rng.randrange(30), 600 + rng.randrange(30)) for _ in range(20)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    expected = sorted((k, find(k)) for k in {x for a, b in links if a != b for x in (a, b)})
    got = sorted(map(tuple, N.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()))
    assert got == expected


def test_rounds_lose_no_link_of_large_groups(spark, monkeypatch):
    """Two groups of near copies and texts at their edge give the components of all pairs, whatever is tried first."""
    rng = random.Random(11)
    base = [f"w{k}" for k in range(60)]

    def edited(words, n):
        words = list(words)
        for k in rng.sample(range(len(words)), n):
            words[k] = f"e{rng.randrange(10**9)}"
        return " ".join(words)

    half = base[:45] + [f"v{k}" for k in range(15)]
    rows = [(k, edited(base if k % 2 else half, rng.choice([0, 1, 2, 3]))) for k in range(120)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    sets = {k: {tuple(w[i : i + 4]) for i in range(len(w) - 3)} for k, w in ((k, t.split()) for k, t in rows)}
    group = {k: k for k in sets}
    for a in sets:
        for b in sets:
            if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) and group[a] != group[b]:
                old, new = sorted((group[a], group[b]), reverse=True)
                group = {k: new if g == old else g for k, g in group.items()}
    for rounds in ((16, 64, 256), (1,)):
        monkeypatch.setattr(N, "ROUNDS", rounds)
        got = {r["doc_id"]: r["component_id"] for r in N.group(docs, N.Hamming(words=4, chunks=2)).collect()}
        assert got == group


def test_one_of_each_group_stays_whatever_columns_are_called(spark):
    docs = spark.createDataFrame([(1, "a b c d e f", 7), (2, "a b c d e f", 8), (None, None, 9)], "doc_id bigint, text string, _dropped_id bigint")
    kept = N.keep_one(docs)
    assert kept.columns == docs.columns and sorted(r["_dropped_id"] for r in kept.collect()) == [7, 9]
