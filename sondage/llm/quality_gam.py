"""Quality classifier: a generalised additive model with pairwise interactions.

Features of a text fall into bins. Boosting goes round the features, fitting a shallow
tree to the gradient of the log loss on one feature's bins at a time and adding a share of
it to that feature's lookup table; the strongest pairs, ranked by how much one split in
each of two features still lowers the loss, then get tables of their own. The model is
those tables: a score is the sum of one entry per feature and pair, read for all rows of a
batch at once.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sondage.llm.quality_rules import SPACES, SYMBOLS, repeated_lines, repeated_words
from sondage.llm.texts import remainder_of_id, rows_of, schema_with, smallest_hashes, with_text_bytes

FEATURES = (
    "words",
    "bytes_per_word",
    "symbols",
    "bars",
    "repeated_words",
    "repeated_lines",
    "commonest_word",
    "distinct_words",
    "short_words",
    "long_words",
    "capitals",
    "digits",
    "sentence_ends",
    "commas",
    "other_marks",
    "words_per_line",
    "lines_ended",
    "marked_word_ends",
)
_CAPITALS, _DIGITS, _MARKS = bytes(range(65, 91)), bytes(range(48, 58)), b"\"'()[]{}/\\@^_`~+=:;-"
_MARKED_END = re.compile(rb"[#*$%&|<>=~^]+(?=[ \t\n\r\x0b\x0c]|\Z)")


def features(text: bytes) -> list[float]:
    """Shares and sizes of a text; an empty text has zeros."""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    size = len(text)
    without = lambda cls: size - len(text.translate(None, cls))
    low = text.lower().split()
    counts = Counter(low)
    lengths = np.fromiter(map(len, words), np.int64, n)
    lines = [line for line in text.split(b"\n") if line.strip(SPACES)]
    return [
        np.log1p(n),
        float(lengths.mean()),
        without(SYMBOLS) / n,
        without(b"|") / n,
        repeated_words(words) / n,
        repeated_lines(text) / len(lines),
        max(counts.values()) / n,
        len(counts) / n**0.75,
        float((lengths <= 2).mean()),
        float((lengths >= 12).mean()),
        without(_CAPITALS) / n,
        without(_DIGITS) / n,
        without(b".!?") / n,
        without(b",") / n,
        without(_MARKS) / n,
        n / len(lines),
        sum(line.rstrip(SPACES)[-1:] in b".!?\"'" for line in lines) / len(lines),
        len(_MARKED_END.findall(text)) / n,
    ]


@dataclass(frozen=True)
class Boosting:
    """``sample``: labelled rows the model is fitted on at most; ``bins`` per feature;
    rounds over all features, then over the ``pairs`` strongest pairs; ``rate`` of each
    tree; ``least`` rows on each side of a split."""

    sample: int = 20_000
    bins: int = 32
    rounds: int = 80
    pairs: int = 8
    pair_rounds: int = 30
    rate: float = 0.15
    least: int = 10
    ridge: float = 1.0


@dataclass(frozen=True)
class Model:
    edges: tuple[np.ndarray, ...]
    base: float
    tables: tuple[np.ndarray, ...]
    pairs: tuple[tuple[int, int], ...]
    pair_tables: tuple[np.ndarray, ...]

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of rows of features, by additions of table entries."""
        b = [np.searchsorted(e, x[:, k], side="right") for k, e in enumerate(self.edges)]
        total = np.full(len(x), self.base)
        for k, table in enumerate(self.tables):
            total += table[b[k]]
        for (i, j), table in zip(self.pairs, self.pair_tables, strict=True):
            total += table[b[i], b[j]]
        return 1 / (1 + np.exp(-total))


def _cut(g: np.ndarray, h: np.ndarray, n: np.ndarray, p: Boosting) -> tuple[float, int]:
    """Best gain of one split of a row of bins, and the first bin on its right."""
    gl, hl, nl = np.cumsum(g)[:-1], np.cumsum(h)[:-1], np.cumsum(n)[:-1]
    if not len(gl):
        return 0.0, 0
    gt, ht, nt = g.sum(), h.sum(), n.sum()
    gain = gl**2 / (hl + p.ridge) + (gt - gl) ** 2 / (ht - hl + p.ridge) - gt**2 / (ht + p.ridge)
    gain[(nl < p.least) | (nt - nl < p.least)] = 0
    k = int(gain.argmax())
    return float(gain[k]), k + 1


def _tree(g: np.ndarray, h: np.ndarray, n: np.ndarray, p: Boosting, depth: int = 2) -> np.ndarray:
    """Leaf values per bin of a tree of the given depth on one feature."""
    gain, k = _cut(g, h, n, p) if depth else (0.0, 0)
    if gain <= 0:
        return np.full(len(g), g.sum() / (h.sum() + p.ridge))
    return np.concatenate([_tree(g[:k], h[:k], n[:k], p, depth - 1), _tree(g[k:], h[k:], n[k:], p, depth - 1)])


def _pair_tree(g: np.ndarray, h: np.ndarray, n: np.ndarray, p: Boosting) -> tuple[float, np.ndarray]:
    """Leaf values of a split in the first feature and one in the second on each side, or the other way round."""
    best, leaf = 0.0, np.zeros_like(g)
    for turn in (False, True):
        a, b, c = (g.T, h.T, n.T) if turn else (g, h, n)
        gain, k = _cut(a.sum(1), b.sum(1), c.sum(1), p)
        if gain <= 0:
            continue
        out = np.empty_like(a)
        for part in (slice(0, k), slice(k, None)):
            more, at = _cut(a[part].sum(0), b[part].sum(0), c[part].sum(0), p)
            gain += more
            for side in (slice(0, at), slice(at, None)) if more > 0 else (slice(None),):
                out[part, side] = a[part, side].sum() / (b[part, side].sum() + p.ridge)
        if gain > best:
            best, leaf = gain, out.T if turn else out
    return best, leaf


def fit(x: np.ndarray, y: np.ndarray, p: Boosting = Boosting()) -> Model:
    """Fits the tables on rows of features and 0/1 labels."""
    quantiles = np.linspace(0, 1, p.bins + 1)[1:-1]
    edges = tuple(np.unique(np.quantile(x[:, k], quantiles)) for k in range(x.shape[1]))
    b = [np.searchsorted(e, x[:, k], side="right") for k, e in enumerate(edges)]
    sizes = [len(e) + 1 for e in edges]
    share = (y.sum() + 1) / (len(y) + 2)
    base = float(np.log(share / (1 - share)))
    total = np.full(len(y), base)
    tables = [np.zeros(s) for s in sizes]
    counts = [np.bincount(b[k], minlength=s) for k, s in enumerate(sizes)]

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        q = 1 / (1 + np.exp(-total))
        return y - q, q * (1 - q)

    for _ in range(p.rounds):
        for k, size in enumerate(sizes):
            g, h = slopes()
            step = p.rate * _tree(np.bincount(b[k], g, size), np.bincount(b[k], h, size), counts[k], p)
            tables[k] += step
            total += step[b[k]]

    def grid(i: int, j: int, w: np.ndarray | None = None) -> np.ndarray:
        return np.bincount(b[i] * sizes[j] + b[j], w, sizes[i] * sizes[j]).reshape(sizes[i], sizes[j])

    g, h = slopes()
    ranked = sorted(((_pair_tree(grid(i, j, g), grid(i, j, h), grid(i, j), p)[0], i, j) for i, j in combinations(range(len(sizes)), 2)), reverse=True)
    pairs = [(i, j) for gain, i, j in ranked[: p.pairs] if gain > 0]
    pair_tables = [np.zeros((sizes[i], sizes[j])) for i, j in pairs]
    pair_counts = [grid(i, j) for i, j in pairs]
    for _ in range(p.pair_rounds):
        for table, n, (i, j) in zip(pair_tables, pair_counts, pairs, strict=True):
            g, h = slopes()
            step = p.rate * _pair_tree(grid(i, j, g), grid(i, j, h), n, p)[1]
            table += step
            total += step[b[i], b[j]]
    return Model(edges, base, tuple(tables), tuple(pairs), tuple(pair_tables))


def measured(docs: DataFrame, keep: list[str], text: str) -> DataFrame:
    """The columns ``keep`` and ``x``, the features of each text."""
    read = with_text_bytes(docs, keep, text)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in rows_of(batches):
            x = pa.array([features(t) for t in texts], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], x], names=[*keep, "x"])

    return read.mapInArrow(measure, schema_with(read, "x array<double>"))


def train(docs: DataFrame, labels: DataFrame, label: str, params: Boosting = Boosting(), doc_id: str = "doc_id", text: str = "text") -> Model | None:
    """A model from at most ``params.sample`` labelled documents, those of smallest hash of the id; None without both labels.

    An id with several labels takes the greatest; null ids and labels are left out.
    """
    known = labels.where(F.col(doc_id).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(doc_id).alias("_id")).agg(F.max(label).cast("double").alias("y"))
    some = smallest_hashes(known, params.sample, "_id")
    read = docs.select(F.col(doc_id).alias("_doc"), F.col(text).alias("_text")).join(F.broadcast(some), F.col("_doc") == F.col("_id"))
    rows = measured(read, ["_doc", "y"], "_text").orderBy(F.xxhash64("_doc"), "_doc", "x").limit(params.sample).collect()
    if len({r["y"] for r in rows}) < 2:
        return None
    return fit(np.array([r["x"] for r in rows]), np.array([r["y"] for r in rows]), params)


def score(docs: DataFrame, model: Model | None, keep: list[str] = ["doc_id"], text: str = "text") -> DataFrame:
    """The columns ``keep`` of each document and its ``score`` from 0 to 1.

    A null text is empty; an empty text scores as the tables have zeros. Without a model
    every score is 0.5. Repeated rows and null ids are scored like any other; no rows, no
    result; other columns are not read.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    read = with_text_bytes(docs, keep, text)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in rows_of(batches):
            x = np.array([features(t) for t in texts])
            found = sent.value.score(x) if sent.value else np.full(len(x), 0.5)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(found)], names=[*keep, "score"])

    return read.mapInArrow(judge, schema_with(read, "score double"))


def learn_and_score(docs: DataFrame, labels: DataFrame, label: str = "quality", divisor: int = 5, held: int = 0, params: Boosting = Boosting()) -> DataFrame:
    """doc_id, held_out and score: the model sees only labels whose id's crc32 modulo ``divisor`` is not ``held``."""
    seen = labels.where(remainder_of_id(F.col("doc_id"), divisor) != held)
    scored = score(docs, train(docs, seen, label, params))
    out = F.coalesce(remainder_of_id(F.col("doc_id"), divisor) == held, F.lit(False))
    return scored.select("doc_id", out.alias("held_out"), "score")
