"""Language of texts by multinomial naive Bayes over hashed character n-grams.

Letters are lower-cased and every run of other characters becomes one space, so n-grams
see words and their edges. An n-gram is hashed to one of ``2 ** bits`` buckets. The model
is a matrix of log-probabilities, a row for each bucket and a column for each language, in
whole numbers of 2 ** -20: sums of it are exact in any order, so a text has the same score
however it is batched. Texts of a batch are laid end to end, their buckets look up rows of
the matrix, and the rows are summed by text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sondage.llm.texts import remainder_of_id, rows_of, schema_with, with_text_bytes

UNKNOWN = "und"
#: Characters looked at together; longer texts are read in pieces that overlap.
PIECE = 1 << 19
_UNIT = 1 << 20
_SPACE = 32


@dataclass(frozen=True)
class Bayes:
    """``sizes``: lengths of n-grams; ``bits``: of a bucket number; ``smoothing``: added to
    every count; ``per_language``: labelled documents of a language learned from, about (each
    document is taken by a hash of its id); ``cells``: entries of the matrix at most, beyond
    which buckets are halved (and beyond 256 buckets an error is raised)."""

    sizes: tuple[int, ...] = (1, 2, 3)
    bits: int = 16
    smoothing: float = 0.5
    per_language: int = 20_000
    cells: int = 1 << 22

    def buckets(self, languages: int) -> int:
        n = 1 << self.bits
        while n * languages > self.cells:
            n //= 2
        if n < min(256, 1 << self.bits):
            raise ValueError(f"{languages} languages are too many for a matrix of {self.cells} entries")
        return n


@dataclass(frozen=True)
class Model:
    """``weights``: buckets by languages, in units of 2 ** -20; ``prior``: one for each language."""

    languages: tuple[str, ...]
    prior: np.ndarray
    weights: np.ndarray
    sizes: tuple[int, ...]


class _Letters:
    """Which of the 1,114,112 code points are letters, found out as they are met."""

    def __init__(self) -> None:
        self.state = np.zeros(0x110000, np.int8)

    def __call__(self, codes: np.ndarray) -> np.ndarray:
        found = self.state[codes]
        if (found == 0).any():
            for c in np.unique(codes[found == 0]).tolist():
                self.state[c] = 1 if chr(c).isalpha() else -1
            found = self.state[codes]
        return found > 0


def letters_of(text: str, letters: _Letters) -> np.ndarray:
    """Code points of the lower-cased letters with one space for each run of others, and at both ends; empty without a letter."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    known = letters(codes)
    if not known.any():
        return np.zeros(0, np.uint32)
    codes = np.where(known, codes, np.uint32(_SPACE))
    codes = np.concatenate([[_SPACE], codes, [_SPACE]]).astype(np.uint32)
    keep = np.ones(len(codes), bool)
    keep[1:] = (codes[1:] != _SPACE) | (codes[:-1] != _SPACE)
    return codes[keep]


def pieces(text: str, letters: _Letters, longest: int) -> Iterator[np.ndarray]:
    """The letters of a text in pieces, each repeating the last ``longest`` - 1 characters of the one before."""
    if len(text) <= PIECE:
        yield letters_of(text, letters)
        return
    tail = np.zeros(0, np.uint32)
    for k in range(0, len(text), PIECE):
        own = letters_of(text[k : k + PIECE], letters)
        if not len(own):
            continue
        # a piece begins and ends with a space; a word cut in two is joined again
        inside = own[0 if k == 0 or not text[k - 1].isalpha() or not text[k].isalpha() else 1 :]
        if k + PIECE < len(text) and text[k + PIECE - 1].isalpha() and text[k + PIECE].isalpha():
            inside = inside[:-1]
        if len(tail) and len(inside) and tail[-1] == _SPACE and inside[0] == _SPACE:
            inside = inside[1:]
        joined = np.concatenate([tail, inside])
        yield joined
        tail = joined[-(longest - 1) :] if longest > 1 else joined[:0]


def buckets_of(codes: np.ndarray, sizes: tuple[int, ...], buckets: int, fresh: int) -> np.ndarray:
    """Buckets of all n-grams that end at place ``fresh`` or later; a space alone is none."""
    out = []
    for n in sizes:
        first = max(0, fresh - n + 1)
        if len(codes) - n + 1 <= first:
            continue
        h = np.full(len(codes) - n + 1 - first, n, np.uint64)
        for k in range(n):
            h = (h ^ codes[first + k : len(codes) - n + 1 + k].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        if n == 1:
            h = h[codes[first:] != _SPACE]
        out.append((h >> np.uint64(7)).astype(np.int64) & (buckets - 1))
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def text_buckets(text: bytes, sizes: tuple[int, ...], buckets: int, letters: _Letters) -> Iterator[np.ndarray]:
    """Buckets of a text, each n-gram once for each occurrence, in bounded pieces."""
    longest, fresh = max(sizes), 0
    for codes in pieces(text.decode("utf-8", "replace"), letters, longest):
        if len(codes):
            yield buckets_of(codes, sizes, buckets, fresh)
            fresh = min(len(codes), longest - 1)


def train(labelled: DataFrame, params: Bayes = Bayes(), doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> Model | None:
    """A model from rows with text and language; None without any.

    Rows are counted by language over all of ``labelled`` (the priors); n-grams are counted
    on the executors over about ``per_language`` documents of each language, and only the
    summed counts, no more than ``cells``, come to the driver. Rows with a null text or
    language teach nothing. Rows that repeat an id are taken or left together.
    """
    p = params
    rows = labelled.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    known = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).limit(p.cells).collect()}
    if not known:
        return None
    languages = tuple(sorted(known))
    buckets = p.buckets(len(languages))
    share = [min(1.0, p.per_language / known[x]) for x in languages]
    number = {x: k for k, x in enumerate(languages)}
    code = F.element_at(F.create_map(*[v for x, k in number.items() for v in (F.lit(x), F.lit(k))]), F.col("lang"))
    uniform = F.pmod(F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("language")), F.lit(1 << 40)) / F.lit(float(1 << 40))
    some = rows.withColumn("y", code).where(uniform < F.element_at(F.array(*map(F.lit, share)), F.col("y") + 1))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, found = _Letters(), {}
        for batch, texts in rows_of(batches):
            for t, y in zip(texts, batch.column("y").to_pylist(), strict=True):
                if y not in found:
                    found[y] = np.zeros(buckets, np.int64)
                for b in text_buckets(t, p.sizes, buckets, letters):
                    found[y] += np.bincount(b, minlength=buckets)
        for y, n in found.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), y, np.int32)), pa.array(at.astype(np.int32)), pa.array(n[at])], names=["y", "bucket", "n"])

    counted = with_text_bytes(some, ["y"], "text").mapInArrow(count, "y int, bucket int, n bigint")
    table = counted.groupBy("y", "bucket").agg(F.sum("n").alias("n")).toArrow()
    n = np.full((buckets, len(languages)), p.smoothing)
    n[table.column("bucket").to_numpy(), table.column("y").to_numpy()] += table.column("n").to_numpy()
    whole = float(sum(known.values()))
    prior = np.log(np.array([known[x] for x in languages]) / whole)
    fixed = lambda x: np.round(x * _UNIT).astype(np.int64)
    return Model(languages, fixed(prior), fixed(np.log(n / n.sum(axis=0))), p.sizes)


def totals(texts: list[bytes], model: Model, letters: _Letters) -> tuple[np.ndarray, np.ndarray]:
    """Summed weights of each text by language, and its number of n-grams."""
    sums = np.tile(model.prior, (len(texts), 1))
    grams = np.zeros(len(texts), np.int64)
    gathered: list[np.ndarray] = []
    owners: list[int] = []
    held = 0

    def add() -> None:
        nonlocal gathered, owners, held
        size = np.array([len(b) for b in gathered])
        if held:
            edges = np.cumsum(size) - size
            rows = np.add.reduceat(model.weights[np.concatenate(gathered)], edges, axis=0)
            np.add.at(sums, owners, rows)
            np.add.at(grams, owners, size)
        gathered, owners, held = [], [], 0

    for k, t in enumerate(texts):
        for b in text_buckets(t, model.sizes, len(model.weights), letters):
            if len(b):
                gathered.append(b)
                owners.append(k)
                held += len(b)
            if held * len(model.languages) > 1 << 21:
                add()
    add()
    return sums, grams


def predict(docs: DataFrame, model: Model | None, keep: list[str] = ["doc_id"], text: str = "text") -> DataFrame:
    """The columns ``keep`` with ``lang_pred`` and ``score``, the posterior probability of that language.

    Every n-gram of the whole text counts. A null text or one without a letter is ``und``
    with score 0, as are all texts without a model. Of equal languages the first by name
    is taken. Repeated rows and null ids are answered like any other; no rows, no result;
    other columns are not read.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    read = with_text_bytes(docs, keep, text)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, letters = sent.value, _Letters()
        for batch, texts in rows_of(batches):
            if found is None:
                names, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
            else:
                sums, grams = totals(texts, found, letters)
                best = sums.argmax(axis=1)
                odds = np.exp((sums - sums.max(axis=1, keepdims=True)) / _UNIT)
                score = np.where(grams > 0, 1 / odds.sum(axis=1), 0.0)
                names = [found.languages[b] if g else UNKNOWN for b, g in zip(best.tolist(), grams.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(names, pa.string()), pa.array(score)], names=[*keep, "lang_pred", "score"])

    return read.mapInArrow(judge, schema_with(read, "lang_pred string, score double"))


def held_out(doc_id: Column, divisor: int, held: int) -> Column:
    return F.coalesce(remainder_of_id(doc_id, divisor) == held, F.lit(False))


def learn_and_predict(docs: DataFrame, divisor: int = 4, held: int = 2, params: Bayes = Bayes()) -> DataFrame:
    """doc_id, held_out, lang_pred and score: learned from documents whose id's crc32 modulo ``divisor`` is not ``held``.

    A row with a null id has no remainder: it is not held out and teaches nothing.
    """
    model = train(docs.where(remainder_of_id(F.col("doc_id"), divisor) != held), params)
    scored = predict(docs, model)
    return scored.select("doc_id", held_out(F.col("doc_id"), divisor, held).alias("held_out"), "lang_pred", "score")
