import random

import pytest

#: Names that operators use for their own columns or inside; they must not disturb them.
CLASHING = ["hits", "items", "found", "kept", "score", "component_id", "n_words", "node", "rule", "_id", "n_shingles"]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Null ids and texts, empty and blank texts, repeated rows, one very long text, clashing columns."""
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(3000)]
    long = " ".join(rng.choice(words) for _ in range(60_000)) + "."
    plain = " ".join(words[:120]) + "."
    rows = [(1, plain), (2, None), (3, ""), (4, " \n\t "), (None, plain), (None, None), (5, long), (6, "one"), (6, "one"), (7, "é ü 漢字 🙂 x"), (8, plain)]
    schema = "doc_id bigint, text string, " + ", ".join(f"`{c}` string" for c in CLASHING)
    return spark.createDataFrame([(*r, *["clash"] * len(CLASHING)) for r in rows], schema)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))
