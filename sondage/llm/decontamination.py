"""Benchmark decontamination by a broadcast hash set of word n-grams.

The windows of the test items become a set of 64-bit hashes that goes to every task; a
document's words are numbered by the items' vocabulary, all its windows are hashed at
once and looked up, and each hit is verified on the words themselves. The set is
broadcast only while the items' texts stay under ``broadcast_bytes``; larger test sets
go through a join on the windows, with the same result.
"""

from __future__ import annotations


import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sondage.llm.texts import alphanumeric_words, found_in, lower_ascii, unpacked, whole_rows, with_text_bytes

WINDOW = 13
#: Texts of test items up to this many bytes are collected and broadcast.
BROADCAST_BYTES = 16_000_000
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: A word before lower-casing: the same characters and A-Z.
_ANY_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
HITS = "n_words bigint, hits array<struct<first:bigint,last:bigint>>, items array<string>"


class ItemWindows:
    """Vocabulary, window hashes and windows of the test items."""

    def __init__(self, items: list[tuple[str, bytes]], width: int) -> None:
        self.vocabulary: dict[bytes, int] = {}
        self.owners: dict[int, dict[bytes, set[str]]] = {}
        number = self.vocabulary.setdefault
        for name, text in items:
            ids = np.array([number(w, len(self.vocabulary) + 1) for w in alphanumeric_words(text)], np.uint32)
            size = min(width, len(ids))
            for k in range(len(ids) - size + 1 if size else 0):
                self.owners.setdefault(size, {}).setdefault(ids[k : k + size].tobytes(), set()).add(name)
        self.hashes = {
            size: np.unique(window_hashes(np.frombuffer(b"".join(found), np.uint32).reshape(-1, size)))
            for size, found in self.owners.items()
        }


def window_hashes(windows: np.ndarray) -> np.ndarray:
    """A 64-bit polynomial hash of each row of word numbers."""
    total = np.zeros(len(windows), np.uint64)
    for column in windows.T:
        total = total * np.uint64(0x9E3779B97F4A7C15) + column.astype(np.uint64) * np.uint64(0xBF58476D1CE4E5B9) + np.uint64(1)
    return total


def find_in_batch(texts: list[bytes], index: ItemWindows) -> tuple[list[int], list[list[tuple[int, int]]], list[list[str]]]:
    """For each text its number of words, its hit spans of words (last inclusive) and the items hit."""
    words = [alphanumeric_words(t) for t in texts]
    counts = [len(w) for w in words]
    get = index.vocabulary.get
    # a zero after each text keeps windows inside it
    flat = np.fromiter((n for w in words for n in (*[get(x, 0) for x in w], 0)), np.uint32, sum(counts) + len(counts))
    first = np.concatenate([[0], np.cumsum(np.array(counts) + 1)])
    unknown = np.concatenate([[0], np.cumsum(flat == 0)])
    covered = np.zeros(len(flat) + 1, np.int64)
    items: list[set[str]] = [set() for _ in texts]
    for size, hashes in index.hashes.items():
        if len(flat) < size:
            continue
        start = np.flatnonzero(unknown[size:] == unknown[:-size])
        start = start[np.isin(window_hashes(np.lib.stride_tricks.sliding_window_view(flat, size)[start]), hashes)]
        owner = np.searchsorted(first, start, side="right") - 1
        for at, k in zip(start.tolist(), owner.tolist(), strict=True):
            found = index.owners[size].get(flat[at : at + size].tobytes())
            if found:
                items[k] |= found
                covered[at] += 1
                covered[at + size] -= 1
    inside = np.cumsum(covered) > 0
    change = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]])))
    spans: list[list[tuple[int, int]]] = [[] for _ in texts]
    for a, b in change.reshape(-1, 2).tolist():
        k = int(np.searchsorted(first, a, side="right") - 1)
        spans[k].append((a - int(first[k]), b - 1 - int(first[k])))
    return counts, spans, [sorted(s) for s in items]


def _broadcast_hits(docs: DataFrame, items: list[tuple[str, bytes]], width: int) -> DataFrame:
    index = docs.sparkSession.sparkContext.broadcast(ItemWindows(items, width))
    names = [c for c in docs.columns if c != "text"]

    def make():
        def find(texts: list[bytes]) -> list[dict]:
            out = []
            for k in range(0, len(texts), 512):
                for count, spans, found in zip(*find_in_batch(texts[k : k + 512], index.value), strict=True):
                    out.append({"n_words": count, "hits": [{"first": a, "last": b} for a, b in spans], "items": found})
            return out

        return find

    found = docs.select(*names, found_in(F.col("text"), HITS, make).alias("_found"))
    return found.select(*names, *[F.col("_found")[c].alias(c) for c in ("n_words", "hits", "items")])


def _windows(words: Column, size: Column) -> Column:
    """Structs of the first word's number and the joined words, for each window."""
    count = F.size(words) - size + 1
    return F.transform(
        F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>")),
        lambda i: F.struct(i.alias("at"), F.array_join(F.slice(words, i + 1, size), " ").alias("window")),
    )


def _joined_hits(docs: DataFrame, items: DataFrame, width: int) -> DataFrame:
    """The same by a join on windows, for test sets of any size."""
    names = [c for c in docs.columns if c != "text"]
    words = F.regexp_extract_all(lower_ascii(F.col("text").cast("string")), F.lit(WORD), 0)
    items = items.select("item", words.alias("words")).where(F.size("words") > 0)
    items = items.withColumn("size", F.least(F.lit(width), F.size("words")))
    sizes = items.select("size").distinct()
    grams = items.select("item", "size", F.explode(_windows(F.col("words"), F.col("size"))).alias("w"))
    grams = grams.groupBy(F.col("w.window").alias("window"), "size").agg(F.collect_set("item").alias("owners"))
    # equal rows are found once and handed to each of them afterwards
    key = F.sha2(F.to_json(F.struct(*[F.col(n) for n in names], F.base64("text").alias("text")), {"ignoreNullFields": "false"}), 256)
    keyed = docs.withColumn("row_key", key)
    rows = keyed.dropDuplicates(["row_key"]).select("row_key", words.alias("words"))
    cut = rows.crossJoin(F.broadcast(sizes))  # at most ``width`` sizes
    cut = cut.select("row_key", "size", F.explode(_windows(F.col("words"), F.col("size"))).alias("w"))
    found = cut.select("row_key", "size", F.col("w.at").alias("at"), F.col("w.window").alias("window")).join(grams, ["window", "size"])
    # a window's items are taken once per document, however often it occurs there
    once = found.groupBy("row_key", "window", "size").agg(F.first("owners").alias("owners"))
    items_of = once.select("row_key", F.explode("owners").alias("item")).groupBy("row_key").agg(F.sort_array(F.collect_set("item")).alias("items"))
    covered = (
        found.select("row_key", F.explode(F.sequence("at", F.col("at") + F.col("size") - 1)).alias("at"))
        .groupBy("row_key")
        .agg(F.sort_array(F.collect_set(F.col("at").cast("bigint"))).alias("covered"))
    )
    starts = F.filter("covered", lambda x, i: F.coalesce(F.get("covered", i - 1) != x - 1, F.lit(True)))
    lasts = F.filter("covered", lambda x, i: F.coalesce(F.get("covered", i + 1) != x + 1, F.lit(True)))
    covered = covered.select("row_key", F.arrays_zip(starts.alias("first"), lasts.alias("last")).alias("hits"))
    return (
        keyed.withColumn("n_words", F.size(words).cast("bigint"))
        .join(covered, "row_key", "left")
        .join(items_of, "row_key", "left")
        .select(
            *names,
            "n_words",
            F.coalesce("hits", F.array().cast("array<struct<first:bigint,last:bigint>>")).alias("hits"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        )
    )


def find_hits(
    docs: DataFrame,
    items: DataFrame,
    keep: list[str] = ["doc_id"],
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    width: int = WINDOW,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """The columns ``keep`` of each document with its n_words, hits and items.

    Words are lower-cased runs of letters, digits and characters outside ASCII. A window
    is ``width`` consecutive words of an item, or all words of a shorter one. ``hits`` are
    spans of word numbers (first and last) inside windows that occur, merged where they
    touch; ``items`` are the ids, as sorted strings, of the items they come from. Items
    that are null or have no words or no id never hit; a null document has no words.
    Equal items are all named; repeated documents are all answered. No items: no hits.
    """
    read = with_text_bytes(docs, keep, text)
    tests = items.where(F.col(item_id).isNotNull() & F.col(item_text).isNotNull())
    tests = tests.select(F.col(item_id).cast("string").alias("item"), F.col(item_text).cast("binary").alias("text"))
    size = tests.agg(F.sum(F.length("text") + F.length("item"))).first()[0] or 0
    if size > broadcast_bytes:
        return _joined_hits(read, tests, width)
    return _broadcast_hits(read, [(r["item"], bytes(r["text"])) for r in tests.collect()], width)


def n_hit(hits: Column) -> Column:
    return F.aggregate(hits, F.lit(0).cast("bigint"), lambda n, h: n + h["last"] - h["first"] + 1)


def contaminated(hits: Column, n_words: Column, one_in: int = 20) -> Column:
    """True where words inside hits are at least one in ``one_in`` of the words."""
    return (n_hit(hits) > 0) & (F.lit(one_in) * n_hit(hits) >= n_words)


def remove_documents(docs: DataFrame, items: DataFrame, text: str = "text", **options) -> DataFrame:
    """The documents that are not contaminated, with all their columns as they were."""
    marked = find_hits(whole_rows(docs, text), items, keep=["_row"], text="_text", **options)
    return unpacked(marked.where(~contaminated(F.col("hits"), F.col("n_words"))), docs.columns)


def remove_spans(docs: DataFrame, items: DataFrame, text: str = "text", **options) -> DataFrame:
    """The documents without the words inside hits; what lies between removed words goes too.

    The text is cut at word edges; characters before the first and after the last word
    stay. Texts without a hit are unchanged.
    """
    marked = find_hits(whole_rows(docs, text), items, keep=["_row"], text="_text", **options)
    # pieces[2k] lies before word k, pieces[2k + 1] is word k
    whole = F.col("_row")[text]
    parts = F.arrays_zip(F.split(whole, _ANY_WORD, -1).alias("gap"), F.regexp_extract_all(whole, F.lit(_ANY_WORD), 0).alias("word"))
    # what stays lies between one hit's last word and the next one's first, or the end
    starts = F.concat(F.array(F.lit(0)), F.transform("hits", lambda h: (h["last"] + 1).cast("int")))
    ends = F.concat(F.transform("hits", lambda h: h["first"].cast("int")), F.array(F.size("_parts") - 1))
    stays = F.transform(
        F.arrays_zip(starts.alias("start"), ends.alias("end")),
        lambda s: F.concat(
            F.array_join(F.transform(F.slice("_parts", s["start"] + 1, s["end"] - s["start"]), lambda x: F.concat(x["gap"], x["word"])), ""),
            F.get("_parts", s["end"])["gap"],
        ),
    )
    marked = marked.withColumn("_parts", F.when(F.size("hits") > 0, parts))
    return unpacked(marked, docs.columns, **{text: F.when(F.size("hits") > 0, F.array_join(stays, "")).otherwise(whole)})
