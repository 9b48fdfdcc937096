"""Toxicity by compression distance.

Two zstandard dictionaries are made, one from windows of toxic text and one from windows of
ordinary text. A window of a new text is compressed with each, and the bytes that the toxic
dictionary saves over the ordinary one are its distance. Weights of the distances and the
threshold on their sum are calibrated on labelled documents neither dictionary has seen.

Toxic documents are mostly ordinary prose, so the windows for the toxic dictionary are those
with a run of bytes (within a word and its edges) that far more toxic than ordinary documents
have. Windows are single words: a match saves three to six bytes, which drowns in wider
windows of prose. Each window is followed by bytes that both dictionaries end with, because
the compressor does not look for matches in the last bytes of its input and because the cost
of a block then is the same for all windows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sondage.llm.texts import kept_table, remainder_of_id, rows_of, schema_with, smallest_hashes, space_words, with_text_bytes

WINDOWS_KEPT = 500_000
GRAM = 5
#: Ends both dictionaries and every window; no UTF-8 text contains it.
TAIL = bytes(range(128, 152))
#: Distances that have a weight, the last for itself and all above.
STEPS = (3, 4, 5, 6, 7)


@dataclass(frozen=True)
class Distance:
    """``toxic`` and ``ordinary``: labelled documents of each class that are learned from,
    at most; ``toxic_bytes`` and ``ordinary_bytes``: sizes of the dictionaries; ``share``,
    ``least`` and ``lift``: a run of bytes marks toxic words if it is in this share of toxic
    documents, in at least so many, and this many times as common there; ``counted``:
    windows of one distance beyond which a document is no more toxic."""

    toxic: int = 4000
    ordinary: int = 6000
    toxic_bytes: int = 16_384
    ordinary_bytes: int = 32_768
    share: float = 0.02
    least: int = 8
    lift: float = 16.0
    counted: int = 3


@dataclass(frozen=True)
class Model:
    toxic: bytes
    ordinary: bytes
    base: float
    weights: tuple[float, ...]
    counted: int


def grams(word: bytes) -> set[bytes]:
    """Runs of bytes of a word between spaces."""
    x = b" " + word + b" "
    return {x[k : k + GRAM] for k in range(max(1, len(x) - GRAM + 1))}


def dictionary(windows: Counter, size: int) -> bytes:
    """All windows, the commonest last, where they are nearest; if they are too many, those zstandard's training picks."""
    ranked = [w for w, _ in sorted(windows.items(), key=lambda x: (x[1], x[0]))]
    if sum(map(len, ranked)) > size:
        total = sum(windows.values())
        samples = [w for w, n in sorted(windows.items()) for _ in range(max(1, round(100_000 * n / total)))]
        return zstandard.train_dictionary(size, samples, k=16, d=6).as_bytes() + TAIL
    return b"".join(w[:-1] for w in ranked) + TAIL


class Distances(dict):
    """Bytes saved by the toxic dictionary, by word; forgets all when full."""

    def __init__(self, toxic: bytes, ordinary: bytes) -> None:
        super().__init__()
        shape = zstandard.ZstdCompressionParameters(
            window_log=17, hash_log=15, chain_log=15, search_log=6, min_match=5, strategy=zstandard.STRATEGY_LAZY2,
            format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=0, write_dict_id=0, write_checksum=0,
        )
        kind = zstandard.DICT_TYPE_RAWCONTENT
        self.packers = [
            zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(d, dict_type=kind), compression_params=shape) for d in (ordinary, toxic)
        ]

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WINDOWS_KEPT:
            self.clear()
        window = b" " + word + b" " + TAIL
        plain, toxic = (len(p.compress(window)) for p in self.packers)
        self[word] = saved = plain - toxic
        return saved

    def steps(self, text: bytes) -> list[int]:
        """Windows of a text at each distance that counts."""
        found = [0] * len(STEPS)
        for word in space_words(text):
            d = self[word] - STEPS[0]
            if d >= 0:
                found[min(d, len(STEPS) - 1)] += 1
        return found


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> tuple[float, tuple[float, ...]]:
    """Intercept and weights, none below zero, by Newton steps."""
    free = list(range(x.shape[1]))
    while True:
        z = np.column_stack([np.ones(len(x)), x[:, free]])
        w = np.zeros(z.shape[1])
        keep = np.full(z.shape[1], ridge)
        keep[0] = 1e-6
        for _ in range(50):
            q = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            step = np.linalg.solve((z.T * (q * (1 - q))) @ z + np.diag(keep), z.T @ (y - q) - keep * w)
            w += step
            if np.abs(step).max() < 1e-8:
                break
        bad = [k for k, value in zip(free, w[1:], strict=True) if value < 0]
        if not bad:
            out = np.zeros(x.shape[1])
            out[free] = w[1:]
            return float(w[0]), tuple(out.tolist())
        free = [k for k in free if k not in bad]


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Toxic and ordinary documents of a task by run of bytes and by word."""
    found: dict[tuple[bool, bytes], list[int]] = {}
    known: dict[bytes, set[bytes]] = {}

    def out() -> pa.RecordBatch:
        keys = list(found)
        columns = [[k for k, _ in keys], [w for _, w in keys], [found[k][1] for k in keys], [found[k][0] for k in keys]]
        kinds = [pa.bool_(), pa.binary(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["word", "key", "toxic", "ordinary"])

    for batch, texts in rows_of(batches):
        for text, y in zip(texts, batch.column("y").to_pylist(), strict=True):
            words = set(space_words(text))
            some: set[bytes] = set()
            for w in words:
                if w not in known:
                    known[w] = grams(w)
                some |= known[w]
            for key in [*((True, w) for w in words), *((False, g) for g in some)]:
                found.setdefault(key, [0, 0])[y] += 1
        if len(found) > 300_000:
            yield out()
            found.clear()
            known.clear()
    if found:
        yield out()


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, p: Distance, doc_id: str, text: str) -> DataFrame:
    """y, half and whole text of the sampled documents of each class, those of smallest hash of the id, in a table of its own.

    An id with several labels takes the greatest; null ids and labels are left out.
    """
    known = labels.where(F.col(doc_id).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(doc_id).alias("_id")).agg(F.max(label).cast("int").alias("y"))
    some = smallest_hashes(known.where("y = 1"), p.toxic, "_id").unionByName(smallest_hashes(known.where("y = 0"), p.ordinary, "_id"))
    some = kept_table(some, "labelled")
    read = docs.select(F.col(doc_id).alias("_doc"), F.col(text).alias("_text")).join(F.broadcast(some), F.col("_doc") == F.col("_id"))
    half = F.pmod(F.xxhash64("_doc", F.lit("half")), F.lit(2)).cast("int").alias("half")
    return kept_table(with_text_bytes(read.select("y", half, "_text"), ["y", "half"], "_text"), "sample")


def train(docs: DataFrame, labels: DataFrame, label: str, params: Distance = Distance(), doc_id: str = "doc_id", text: str = "text") -> Model | None:
    """A model from a bounded sample of labelled documents; None unless each half of it has both labels and some toxic word.

    Words and runs of bytes are counted on the executors; what reaches the driver are the
    toxic words, the commonest ordinary ones, and a row of counts for each sampled document.
    """
    p = params
    sample = labelled_sample(docs, labels, label, p, doc_id, text)
    sizes = {(r["half"], r["y"]): r["n"] for r in sample.groupBy("half", "y").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 4:
        return None
    n, m = sizes[0, 1], sizes[0, 0]
    counted = sample.where("half = 0").drop("half").mapInArrow(_counts, "word boolean, key binary, toxic bigint, ordinary bigint")
    counted = kept_table(counted.groupBy("word", "key").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary")), "counts")
    common = (F.col("toxic") + 0.5) / (n + 1) >= p.lift * (F.col("ordinary") + 0.5) / (m + 1)
    marks = {bytes(r["key"]) for r in counted.where(~F.col("word") & common & (F.col("toxic") >= max(p.least, p.share * n))).select("key").collect()}
    most = F.col("word") & (F.length("key") <= 64)
    bad = counted.where(most & common & (F.col("toxic") >= 3)).orderBy(F.desc("toxic"), "key").limit(20_000).collect()
    toxic = Counter({b" " + bytes(r["key"]) + b" ": r["toxic"] for r in bad if marks & grams(bytes(r["key"]))})
    usual = counted.where(most & (F.col("ordinary") > 0)).orderBy(F.desc("ordinary"), "key").limit(20_000).collect()
    ordinary = Counter({b" " + bytes(r["key"]) + b" ": r["ordinary"] for r in usual})
    if not toxic:
        return None
    made = Model(dictionary(toxic, p.toxic_bytes), dictionary(ordinary, p.ordinary_bytes), 0.0, (), p.counted)

    def steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        saved = Distances(made.toxic, made.ordinary)
        for batch, texts in rows_of(batches):
            yield pa.RecordBatch.from_arrays([batch.column("y"), pa.array([saved.steps(t) for t in texts], pa.list_(pa.int64()))], names=["y", "x"])

    rows = sample.where("half = 1").drop("half").mapInArrow(steps, "y int, x array<bigint>").orderBy("y", "x").collect()
    x = np.minimum(np.array([r["x"] for r in rows], float), p.counted)
    base, weights = logistic(x, np.array([r["y"] for r in rows], float))
    return Model(made.toxic, made.ordinary, base, weights, p.counted)


def score(docs: DataFrame, model: Model | None, keep: list[str] = ["doc_id"], text: str = "text") -> DataFrame:
    """The columns ``keep`` of each document, ``flagged`` (windows at a distance that counts) and ``score`` from 0 to 1.

    Every word of the whole text is compared. A null or empty text has no windows and the
    score of none flagged. Without a model every score is 0.5. Repeated rows and null ids
    are scored like any other; no rows, no result; other columns are not read.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    read = with_text_bytes(docs, keep, text)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = sent.value
        saved = Distances(found.toxic, found.ordinary) if found else None
        for batch, texts in rows_of(batches):
            x = np.array([saved.steps(t) for t in texts], float) if found else np.zeros((len(texts), len(STEPS)))
            q = 1 / (1 + np.exp(-(found.base + np.minimum(x, found.counted) @ np.array(found.weights)))) if found else np.full(len(texts), 0.5)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in keep], pa.array(x.sum(axis=1).astype(np.int64)), pa.array(q)], names=[*keep, "flagged", "score"]
            )

    return read.mapInArrow(judge, schema_with(read, "flagged bigint, score double"))


def learn_and_score(docs: DataFrame, labels: DataFrame, label: str = "toxic", divisor: int = 3, held: int = 1, params: Distance = Distance()) -> DataFrame:
    """doc_id, held_out, score and flagged: the model sees only labels whose id's crc32 modulo ``divisor`` is not ``held``."""
    seen = labels.where(remainder_of_id(F.col("doc_id"), divisor) != held)
    scored = score(docs, train(docs, seen, label, params))
    out = F.coalesce(remainder_of_id(F.col("doc_id"), divisor) == held, F.lit(False))
    return scored.select("doc_id", out.alias("held_out"), "score", "flagged")
