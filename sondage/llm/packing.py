"""Packing of token sequences by dynamic programming in document order.

Every partition packs the documents it holds, in their order, so nothing is shuffled.
Cuts are chosen by the recurrence

    best[j] = penalty[j] + min(best[i] + padding(position[j] - position[i]))

over cut points i < j no more than one sequence apart. The minimum over a sliding
window is kept in a monotone queue; a sequence whose length is a power of two needs no
padding, and those few predecessors are looked up by position. Cut points are the ends
of documents (no penalty) and of sentences, and single tokens where a sentence is longer
than the grid allows or the partition ends.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sondage.llm.texts import with_text_bytes

#: Punctuation after which a sentence may end.
SENTENCE_ENDS = (".", "!", "?", ";", ":", "。", "！", "？", "…")
#: Bytes of text encoded at once.
TEXT_BYTES = 3 << 20
#: Bytes that remembered units may take, at some ``UNIT_BYTES`` each besides their characters.
KEPT_BYTES, UNIT_BYTES = 48 << 20, 150


@dataclass(frozen=True)
class Packing:
    """Parameters: lengths in tokens, penalties in tokens of padding."""

    length: int = 4096
    end_id: int = 2
    grid: int = 16  # at most one sentence end per so many tokens is a cut point
    forced: int = 512  # a token cut is offered where so many tokens have no other
    sequence_cost: float = 2.0
    sentence_cut: float = 3.0
    token_cut: float = 24.0
    block: int = 1 << 20  # tokens planned at once


class WordIds:
    """Ids of texts by way of their distinct units, each of which is encoded once for all texts at hand.

    The tokenizer drops white space and merges only inside units: a run of letters, a
    single digit, a run of other characters, or an English ending after an apostrophe. To
    which of these a character belongs is asked of the tokenizer when the character is
    first met. Texts for which that is not enough go to the tokenizer whole: those with the
    opening of a special token, with characters that are not composed, or with some that
    become several when lower-cased. Units are remembered until they take ``KEPT_BYTES``. A
    unit's memory in the tokenizer is some 80 bytes for each character.
    """

    SPACE, LETTER, DIGIT, OTHER, ODD = 1, 2, 3, 4, 5

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.plain = Tokenizer(self.tokenizer.model)
        self.plain.normalizer = normalizers.Lowercase()
        self.plain.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        self.ends = np.array(
            [str(self.tokenizer.id_to_token(i)).endswith("</w>") for i in range(self.tokenizer.get_vocab_size())]
        )
        self.sentence_ends = np.zeros(len(self.ends), bool)
        for mark in SENTENCE_ENDS:
            ids = self._whole(mark)
            if len(ids) == 1:
                self.sentence_ends[ids] = True
        self.kinds = np.zeros(0x110000, np.int8)
        self._forget()

    def _forget(self) -> None:
        self.number: dict[str, int] = {}
        self.bytes_kept = 0
        self.flat, self.size = np.zeros(0, np.uint32), np.zeros(0, np.int64)

    def _numbers(self, units: list[str]) -> np.ndarray:
        """Places of the units in ``size``; those not known yet are encoded."""
        if self.bytes_kept > KEPT_BYTES:
            self._forget()
        get = self.number.get
        number = np.fromiter((get(w, -1) for w in units), np.int64, len(units))
        new = np.flatnonzero(number < 0)
        if len(new):
            words = [units[k] for k in new.tolist()]
            flat, size = self._encoded(words)
            number[new] = np.arange(len(self.size), len(self.size) + len(words))
            self.number.update(zip(words, number[new].tolist(), strict=True))
            self.flat, self.size = np.concatenate([self.flat, flat]), np.concatenate([self.size, size])
            self.bytes_kept += sum(map(len, words)) + UNIT_BYTES * len(words)
        return number

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def _kind(self, code: int) -> int:
        one = self.tokenizer.normalizer.normalize_str(chr(code))
        if one == " ":
            return self.SPACE
        if len(one) != 1:
            return self.ODD
        units = lambda x: len(self.tokenizer.pre_tokenizer.pre_tokenize_str(x))
        return self.LETTER if units(f"a{one}a") == 1 else self.OTHER if units(f"!{one}!") == 1 else self.DIGIT

    def _kinds_of(self, codes: np.ndarray) -> np.ndarray:
        found = self.kinds[codes]
        if not found.all():
            for code in np.unique(codes[found == 0]).tolist():
                self.kinds[code] = self._kind(code)
            found = self.kinds[codes]
        return found

    def _unit_starts(self, codes: np.ndarray, kind: np.ndarray) -> np.ndarray:
        """Whether a unit, or white space, begins at each character (lower case in A-Z)."""
        new = np.append(True, (kind[1:] != kind[:-1]) | (kind[1:] == self.DIGIT))
        at = np.flatnonzero((codes == ord("'")) & new)
        at = at[at + 3 < len(codes)]  # the text ends with a separator
        at = at[kind[at + 1] == self.LETTER]
        if len(at):
            first, second = codes[at + 1], codes[at + 2]
            one = np.isin(first, [ord(c) for c in "stmd"])
            two = np.zeros(len(at), bool)
            for pair in ("re", "ve", "ll"):
                two |= (first == ord(pair[0])) & (second == ord(pair[1]))
            new[at[one | two] + 1] = False
            for some, size in ((one, 2), (two, 3)):
                after = at[some] + size
                new[after] |= kind[after] == self.LETTER
        return new

    def _encoded(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the units laid end to end, and the number of each."""
        lines = [words[k : k + 1000] for k in range(0, len(words), 1000)]
        flat, sizes = [], []
        for line, e in zip(lines, self.plain.encode_batch_fast([" ".join(x) for x in lines], add_special_tokens=False), strict=True):
            ids = np.array(e.ids, np.uint32)
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) == len(line):
                flat.append(ids)
                sizes.append(np.diff(ends, prepend=0))
            else:
                each = [self._whole(w) for w in line]
                flat += each
                sizes.append(np.array([len(x) for x in each]))
        return np.concatenate(flat), np.concatenate(sizes)

    def _some(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts laid end to end, and the number of each."""
        blob = (b"\n".join(texts) + b"\n").lower()
        edges = np.cumsum([len(t) + 1 for t in texts])
        text = blob.decode()
        codes = np.frombuffer(blob, np.uint8) if len(text) == len(blob) else np.frombuffer(text.encode("utf-32-le"), np.uint32)
        kind = self._kinds_of(codes)
        new = self._unit_starts(codes, kind)
        solid = kind != self.SPACE
        if len(text) == len(blob):
            begin, kept = np.flatnonzero(new), solid
        else:
            width = (codes >= 0x80).astype(np.int8) + (codes >= 0x800) + (codes >= 0x10000) + np.int8(1)
            after = np.cumsum(width, dtype=np.int32)
            begin, kept = after[new] - width[new], np.repeat(solid, width)
        inside = solid[new]
        size = np.diff(begin, append=len(blob))[inside]
        begin = begin[inside]
        data = np.frombuffer(blob, np.uint8)[kept]
        offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
        units = pa.StringArray.from_buffers(len(size), pa.py_buffer(offsets), pa.py_buffer(data)).dictionary_encode()
        number = self._numbers(units.dictionary.to_pylist())
        n = number[units.indices.to_numpy()] if len(number) else number
        size = self.size[n]
        ends = np.cumsum(size)
        first = np.cumsum(self.size) - self.size
        ids = self.flat[np.repeat(first[n] - ends + size, size) + np.arange(ends[-1])] if len(n) else np.zeros(0, np.uint32)
        cuts = np.concatenate([[0], ends])[np.searchsorted(begin, edges)]
        odd = set(np.searchsorted(edges, after[kind == self.ODD]).tolist()) if len(text) != len(blob) else set()
        if b"<|" in blob:
            odd |= {k for k, t in enumerate(texts) if b"<|" in t}
        if len(text) != len(blob) and not is_normalized("NFC", text):
            odd |= {k for k, t in enumerate(texts) if not is_normalized("NFC", t.decode())}
        if odd:
            parts = np.split(ids, cuts[:-1])
            for k in odd:
                parts[k] = self._whole(texts[k].decode())
            return np.concatenate(parts), np.array([len(x) for x in parts])
        return ids, np.diff(cuts, prepend=0)

    def encode(self, texts: list[bytes], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, each text's followed by ``end_id``, and the number of ids of each text.

        Bytes that are no UTF-8 count as U+FFFD. A text longer than ``TEXT_BYTES`` is
        encoded in pieces between spaces.
        """
        done: list[tuple[np.ndarray, np.ndarray]] = []
        few: list[bytes] = []
        held = 0
        for t in texts:
            if not t.isascii():
                t = t.decode("utf-8", "replace").encode()
            if held + len(t) > TEXT_BYTES and few:
                done.append(self._some(few))
                few, held = [], 0
            if len(t) > TEXT_BYTES:
                parts = [self._some([piece])[0] for piece in pieces(t, TEXT_BYTES)]
                done.append((np.concatenate(parts), np.array([sum(map(len, parts))])))
            else:
                few.append(t)
                held += len(t)
        if few:
            done.append(self._some(few))
        if not done:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        ids, sizes = (np.concatenate(x) for x in zip(*done, strict=True))
        return np.insert(ids, np.cumsum(sizes), end_id), sizes + 1


def pieces(text: bytes, size: int) -> Iterator[bytes]:
    """A text in pieces of about ``size`` bytes, cut after spaces."""
    at = 0
    while at < len(text):
        end = text.find(b" ", at + size) + 1 or len(text)
        yield text[at:end]
        at = end


_TOKENIZERS: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """One tokenizer per Python worker; what it holds does not grow."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordIds(path)
    return _TOKENIZERS[path]


def cut_points(ends: np.ndarray, sentence: np.ndarray, total: int, last: bool, p: Packing) -> tuple[np.ndarray, np.ndarray]:
    """Positions where a sequence may begin or end, with their penalties.

    ``ends``: positions after each document's last token; ``sentence``: after a sentence;
    ``last``: the stream ends at ``total``, where single tokens may be cut to meet powers
    of two.
    """
    cell = sentence // p.grid
    sentence = sentence[np.concatenate([cell[1:] != cell[:-1], [True]])] if len(sentence) else sentence
    penalty = {}
    known = np.unique(np.concatenate([[0], ends, sentence, [total]]))
    gaps = np.flatnonzero(np.diff(known) > p.forced)
    extra = [np.arange(known[g] + p.forced, known[g + 1], p.forced) for g in gaps]
    if last:
        extra.append(np.arange(max(1, total - 2 * p.length), total))
    position = np.unique(np.concatenate([known, *extra])) if extra else known
    penalty = np.full(len(position), p.token_cut)
    penalty[np.searchsorted(position, sentence)] = p.sentence_cut
    penalty[np.searchsorted(position, ends)] = 0
    penalty[0] = 0
    penalty[-1] = 0 if last else penalty[-1]
    return position, penalty


def best_cuts(position: np.ndarray, penalty: np.ndarray, last: bool, p: Packing) -> np.ndarray:
    """Cut positions, from the first to the last, of least total cost.

    Without ``last`` the end is open: the cheapest state within one sequence of the end
    is taken, and what follows it is left to the next block.
    """
    at, pen = position.tolist(), penalty.tolist()
    exact: dict[int, list[int]] = {}
    power = 1
    while power < p.length:
        before = np.searchsorted(position, position - power)
        for j in np.flatnonzero((position >= position[0] + power) & (position[np.minimum(before, len(at) - 1)] == position - power)).tolist():
            exact.setdefault(j, []).append(int(before[j]))
        power *= 2
    n = len(at)
    best, back, length = [0.0] * n, [0] * n, p.length
    queue: deque[tuple[float, int, int]] = deque([(float(at[0]), at[0], 0)])  # best + position, position, index
    none: list[int] = []
    for j in range(1, n):
        x = at[j]
        least = x - length
        while queue[0][1] < least:
            queue.popleft()
        cost, i = queue[0][0] + length - x, queue[0][2]
        for k in exact.get(j, none):
            if best[k] < cost:
                cost, i = best[k], k
        cost += pen[j] + p.sequence_cost
        best[j], back[j] = cost, i
        key = cost + x
        while queue and queue[-1][0] >= key:
            queue.pop()
        queue.append((key, x, j))
    j = n - 1
    if not last:
        near = np.searchsorted(position, position[-1] - length)
        j = min(range(int(near), n), key=lambda k: best[k] + (at[-1] - at[k]) * p.sequence_cost / length)
    cuts = [at[j]]
    while j:
        j = back[j]
        cuts.append(at[j])
    return np.array(cuts[::-1])


def _pack(batches: Iterator[pa.RecordBatch], path: str, p: Packing, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    words = word_ids(path)
    task = TaskContext.get()
    number = ((task.partitionId() if task else 0) << 40) - 1
    ids, sizes, doc_ids, totals, starts = np.zeros(0, np.uint32), [], [], [], []

    def planned(last: bool) -> Iterator[pa.RecordBatch]:
        """Plans what has been gathered, hands out its pieces and keeps the rest."""
        nonlocal ids, sizes, doc_ids, totals, starts, number
        size = np.array(sizes, np.int64)
        ends = np.cumsum(size)
        sentence = np.flatnonzero(words.sentence_ends[ids]) + 1
        position, penalty = cut_points(ends, sentence, len(ids), last, p)
        cuts = best_cuts(position, penalty, last, p)
        edges = np.unique(np.concatenate([cuts, ends[ends <= cuts[-1]]]))
        left, right = edges[:-1], edges[1:]
        doc = np.searchsorted(ends, left, side="right")
        sequence = np.searchsorted(cuts, left, side="right") - 1
        first = np.array(starts, np.int64)[doc] + left - (ends - size)[doc]
        raw = ids.astype("<u4", copy=False).tobytes()
        for k in range(0, len(left), 20_000):
            s = slice(k, k + 20_000)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([doc_ids[d] for d in doc[s]], schema.field("doc_id").type),
                    pa.array(first[s]),
                    pa.array(right[s] - left[s]),
                    pa.array([raw[4 * a : 4 * b] for a, b in zip(left[s].tolist(), right[s].tolist(), strict=True)], pa.binary()),
                    pa.array(np.array(totals, np.int64)[doc[s]]),
                    pa.array(number + 1 + sequence[s]),
                    pa.array(left[s] - cuts[sequence[s]]),
                ],
                schema=schema,
            )
        number += len(cuts) - 1
        keep = int(np.searchsorted(ends, cuts[-1], side="right"))
        done = int(cuts[-1] - (ends[keep] - size[keep])) if keep < len(size) else 0
        ids, sizes, doc_ids, totals, starts = ids[cuts[-1] :], sizes[keep:], doc_ids[keep:], totals[keep:], starts[keep:]
        if sizes:
            sizes[0] -= done
            starts[0] += done

    gathered, held = [], 0
    for batch in batches:
        names = batch.column("doc_id").to_pylist()
        texts = batch.column("text")
        size = np.cumsum(pc.binary_length(texts).to_numpy())
        cuts = np.flatnonzero(np.diff(size // TEXT_BYTES)) + 1  # many texts at once: fewer distinct units
        for k, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(texts)], strict=True):
            new, count = words.encode(texts[k:end].to_pylist(), p.end_id)
            gathered.append(new)
            held += len(new)
            sizes += count.tolist()
            totals += count.tolist()
            starts += [0] * len(count)
            doc_ids += names[k:end]
            if held >= p.block:
                ids = np.concatenate([ids, *gathered])
                gathered = []
                yield from planned(last=False)
                held = len(ids)
    ids = np.concatenate([ids, *gathered])
    if len(ids):
        yield from planned(last=True)


def pack(docs: DataFrame, tokenizer: str, params: Packing = Packing(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Pieces of documents laid end to end in sequences of at most ``params.length`` tokens.

    Columns: doc_id, start, length, ids (binary, little-endian unsigned 32-bit),
    doc_tokens, sequence_id, offset. Each document is its ids and ``params.end_id``, so a
    null or empty text is one token. Repeated rows and null or equal ids are packed like
    any other row. Texts of any length are cut as needed. No rows, no pieces; columns
    beyond the two named are not read. ``tokenizer`` is the path of a tokenizer file that
    every executor can open.
    """
    read = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = dict(read.dtypes)["doc_id"]
    ddl = f"doc_id {kind}, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    schema = to_arrow_schema(_parse_datatype_string(ddl))
    return with_text_bytes(read, ["doc_id"], "text").mapInArrow(lambda batches: _pack(batches, tokenizer, params, schema), ddl)
