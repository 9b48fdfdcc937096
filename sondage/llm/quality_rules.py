"""Quality rules: counts of words, symbols and repeats, and bands of zstandard ratios.

The method's verdict is the compression band. A text is compressed whole and in fixed
chunks that cover it to its end; repetitive text compresses far better than prose of its length and noise far
worse, and both limits depend on the length because longer prose compresses better.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sondage.llm.texts import found_in, unpacked, whole_rows

SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\r\x0b\x0c"
_CONTINUATION = bytes(range(0x80, 0xC0))


@dataclass(frozen=True)
class Bands:
    """Ratios of plain to compressed bytes that prose keeps to.

    ``whole``: (bytes, least ratio, greatest ratio) in rising order of size; between two
    sizes the limits follow the logarithm of the size, beyond the last they stay. Texts
    under the first size have no least ratio, as the frame alone can outweigh them.
    Chunks of ``chunk_bytes`` keep to the limits of their size; ``chunks_outside`` is the
    share of bytes in chunks that may lie outside.

    The limits come from the texts of sf0.1 that are labelled quality 1 and meet the base
    rules, cut to each size (from 3,243 of them at 256 bytes to 19 at 16,384): nine tenths
    of the least and thirteen tenths of the greatest ratio found. From 4,096 bytes on the
    least ratio stays at nine tenths of 2.08, the least of 60 cuts of 16,384 bytes from
    these texts joined; the last greatest ratio is that of whole texts of 16 to 32 kB.
    Random base64, CJK and printable ASCII lay under the least at the 11 sizes tried,
    256 bytes to 100 kB.
    """

    level: int = 3
    whole: tuple[tuple[int, float, float], ...] = (
        (256, 1.12, 2.13),
        (512, 1.25, 2.30),
        (1024, 1.49, 2.59),
        (2048, 1.70, 2.76),
        (4096, 1.87, 2.93),
        (8192, 1.87, 3.04),
        (16384, 1.87, 3.16),
        (32768, 1.87, 3.22),
    )
    chunk_bytes: int = 2048
    chunks_outside: float = 0.25

    def limits(self, size: int) -> tuple[float, float]:
        """Least and greatest ratio of a text of ``size`` bytes."""
        sizes, least, most = zip(*self.whole, strict=True)
        at, known = math.log(max(size, 1)), [math.log(n) for n in sizes]
        return 0.0 if size < sizes[0] else float(np.interp(at, known, least)), float(np.interp(at, known, most))


def repeated_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that occur at least twice."""
    n = len(words)
    if n < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    code = ids[:-2] * len(number) + ids[1:-1]
    if len(number) >= 1 << 20:
        code = np.unique(code, return_inverse=True)[1].astype(np.int64)
    code = code * len(number) + ids[2:]
    order = np.argsort(code, kind="stable")
    same = np.diff(code[order]) == 0
    twice = order[np.concatenate([same, [False]]) | np.concatenate([[False], same])]
    inside = np.zeros(n, bool)
    for k in range(3):
        inside[twice + k] = True
    return int(inside.sum())


def repeated_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split(b"\n") if line.strip(SPACES)]
    return len(lines) - len(set(lines))


def band_verdict(text: bytes, pack: zstandard.ZstdCompressor, bands: Bands) -> tuple[float, float, bool]:
    """Ratio of the whole text, share of its bytes in chunks outside their band, and whether both are in bounds.

    What full chunks leave at the end is judged by the last full chunk that the text
    holds, and counts with its own bytes; a text shorter than a chunk is one chunk.
    """
    if not text:
        return 0.0, 0.0, False
    ratio = len(text) / len(pack.compress(text))
    least, most = bands.limits(len(text))
    size = bands.chunk_bytes
    low, high = bands.limits(size)
    full = range(0, len(text) - size + 1, size)
    weights = [size] * len(full)
    chunks = [size / len(pack.compress(text[k : k + size])) for k in full]
    if rest := len(text) % size:
        weights.append(rest)
        chunks.append(size / len(pack.compress(text[-size:])) if full else ratio)
    if not full:
        low, high = least, most
    outside = sum(w for c, w in zip(chunks, weights, strict=True) if not low <= c <= high) / len(text)
    return ratio, outside, least <= ratio <= most and outside <= bands.chunks_outside


def measure(text: bytes, pack: zstandard.ZstdCompressor, bands: Bands) -> tuple:
    words = text.split()
    ratio, outside, in_band = band_verdict(text, pack, bands)
    return (
        len(words),
        len(text.translate(None, SPACES + _CONTINUATION)),
        len(text) - len(text.translate(None, SYMBOLS)),
        repeated_lines(text),
        repeated_words(words),
        ratio,
        outside,
        in_band,
    )


MEASURES = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
    "ratio double, chunks_outside double, in_band boolean"
)


def score_rules(
    docs: DataFrame, keep: list[str] = ["doc_id"], text: str = "text", bands: Bands = Bands(), least_words: int = 50, most_repeated: int = 50
) -> DataFrame:
    """The columns ``keep`` with counts, compression figures, ``base_failed`` and ``kept``.

    Counted: words between white space, characters in words, symbols, lines equal to an
    earlier line, and words in repeated 3-word windows. A text fails the base rules with
    fewer than ``least_words`` words or more than ``most_repeated`` percent repeated
    words; otherwise it is kept if its compression ratios lie in ``bands``. A null text is
    empty and fails. Rows are judged one by one: ties, repeated rows and null ids change
    nothing, and an empty table gives an empty result.
    """
    names = [n.split(" ")[0] for n in MEASURES.split(", ")]

    def make():
        packer = zstandard.ZstdCompressor(level=bands.level)
        return lambda texts: [dict(zip(names, measure(t, packer, bands), strict=True)) for t in texts]

    scored = docs.select(*[F.col(c) for c in keep], found_in(F.col(text), MEASURES, make).alias("_found"))
    scored = scored.select(*[F.col(c) for c in keep], *[F.col("_found")[n].alias(n) for n in names])
    failed = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > most_repeated * F.col("n_words"))
    return scored.withColumn("base_failed", failed).withColumn("kept", ~failed & F.col("in_band"))


def keep_good(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """The documents that pass, with all their columns as they were."""
    return unpacked(score_rules(whole_rows(docs, text), keep=["_row"], text="_text", **options).where("kept"), docs.columns)
