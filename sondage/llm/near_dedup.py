"""Near-duplicate groups by a multi-index Hamming join of b-bit MinHash signatures.

A document is the set of its distinct word shingles. Its signature has ``chunks`` chunks
of ``width`` symbols, each the low ``bits`` bits of one minimum. By the pigeonhole
principle two signatures that differ in at most ``2 * chunks - 1`` symbols agree in all
but at most one symbol of some chunk, so every chunk is indexed once per symbol left out:
no pair within that distance is missed. Two sets of similarity 0.8 have no chunk in common
with a probability near one in a million (8 chunks of 4).

Groups may hold a third of all documents, so pairs inside an index bucket are never all
emitted. Documents with the same words are first folded to one. Then each bucket links its
documents to the smallest, one pair per document; after confirmed links are merged, only
documents of buckets with several components go on: first with the bucket's smallest and
largest components, and those that remain through an exact prefix-filter join that meets
only pairs which can reach the overlap. Links are confirmed on the full shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sondage.llm.texts import kept_table, rows_of, space_words, with_text_bytes

#: Bytes that remembered words may take in a task, at some ``WORD_BYTES`` each besides their own.
KEPT_BYTES, WORD_BYTES = 24 << 20, 150


@dataclass(frozen=True)
class Hamming:
    """Shingle length in words, similarity in percent, and the shape of the signature."""

    words: int = 5
    percent: int = 80
    chunks: int = 8
    width: int = 4
    bits: int = 16

    @property
    def symbols(self) -> int:
        return self.chunks * self.width

    @property
    def distance(self) -> int:
        """Symbols two signatures may differ in and still be sure to meet."""
        return 2 * self.chunks - 1


class _WordHashes(dict):
    """64-bit hashes of words; forgets all when full."""

    held = 0

    def __missing__(self, word: bytes) -> int:
        if self.held > KEPT_BYTES:
            self.clear()
            self.held = 0
        self.held += len(word) + WORD_BYTES
        self[word] = found = xxhash.xxh3_64_intdigest(word)
        return found


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijective finalizer on 64 bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(words: list[bytes], size: int, known: _WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles; fewer words make one shingle."""
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter((known[w] for w in words), np.uint64, len(words))
    size = min(size, len(words))
    total = np.zeros(len(words) - size + 1, np.uint64)
    for k in range(size):
        total = _mixed(total + h[k : len(h) - size + 1 + k] + np.uint64(0x9E3779B97F4A7C15))
    return np.unique(total)


def minimums(shingles: np.ndarray, count: int) -> np.ndarray:
    """``count`` minima of a set, each under its own permutation of 64-bit numbers."""
    odd = (_mixed(np.arange(1, count + 1, dtype=np.uint64)) | np.uint64(1))[:, None]
    least = np.full(count, np.iinfo(np.uint64).max, np.uint64)
    for first in range(0, len(shingles), 2048):
        y = shingles[None, first : first + 2048] * odd
        y ^= y >> np.uint64(32)
        y *= odd
        least = np.minimum(least, y.min(axis=1))
    return least


def words_hash(words: list[bytes]) -> bytes:
    return xxhash.xxh3_128_digest(b" ".join(words))


def signatures(docs: DataFrame, p: Hamming, doc_id: str, text: str) -> DataFrame:
    """doc_id, words_hash (of the whole word sequence), n_shingles and signature (array of symbols)."""
    read = with_text_bytes(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), ["doc_id"], "text")

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low = np.uint64((1 << p.bits) - 1)  # the high bits of a minimum are nearly always zero
        known = _WordHashes()
        for batch, texts in rows_of(batches):
            folds, sizes, signs = [], [], []
            for t in texts:
                words = space_words(t)
                found = shingle_set(words, p.words, known)
                folds.append(words_hash(words) if words else None)
                sizes.append(len(found))
                signs.append((minimums(found, p.symbols) & low).astype(np.int32).tolist() if words else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(folds, pa.binary()), pa.array(sizes, pa.int64()), pa.array(signs, pa.list_(pa.int32()))],
                names=["doc_id", "words_hash", "n_shingles", "signature"],
            )

    kind = dict(read.dtypes)["doc_id"]
    return read.mapInArrow(sign, f"doc_id {kind}, words_hash binary, n_shingles bigint, signature array<int>")


def shingle_sets(texts: DataFrame, size: int) -> DataFrame:
    """words_hash and the set of shingle hashes of each text (bytes under ``text``)."""

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _WordHashes()
        for _, rows in rows_of(batches):
            for k in range(0, len(rows), 500):
                words = [space_words(t) for t in rows[k : k + 500]]
                sets = [shingle_set(w, size, known).view(np.int64) for w in words]
                edges = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
                values = pa.ListArray.from_arrays(pa.array(edges), pa.array(np.concatenate(sets)))
                yield pa.RecordBatch.from_arrays([pa.array(map(words_hash, words), pa.binary()), values], names=["node", "shingles"])

    return texts.select("text").mapInArrow(collect, "node binary, shingles array<bigint>")


def bucket_keys(nodes: DataFrame, p: Hamming) -> DataFrame:
    """One row per node, chunk and symbol left out: node, n_shingles, bucket."""
    chunk = lambda c: [F.col("signature")[c * p.width + s] for s in range(p.width)]
    keys = [
        F.xxhash64(F.lit(c * p.width + left), *[x for s, x in enumerate(chunk(c)) if s != left])
        for c in range(p.chunks)
        for left in range(p.width)
    ]
    return nodes.select("node", "n_shingles", F.explode(F.array(*keys)).alias("bucket"))


def near_in_size(p: Hamming, a: str, b: str) -> Column:
    """Sets whose sizes are further apart can't be similar enough."""
    return 100 * F.least(a, b) >= p.percent * F.greatest(a, b)


def distances(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) with the Jaccard distance of their sets, one less the similarity, and what it is made of."""
    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa")), "a").join(
        sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb")), "b"
    )
    both = both.withColumn("shared", F.size(F.array_intersect("sa", "sb"))).withColumn("either", F.size("sa") + F.size("sb") - F.col("shared"))
    return both.withColumn("distance", 1 - F.col("shared") / F.col("either")).drop("sa", "sb")


def confirmed(pairs: DataFrame, sets: DataFrame, p: Hamming, *keep: str) -> DataFrame:
    """The pairs (a, b) whose full sets reach the similarity, with other columns named."""
    return distances(pairs, sets).where(100 * F.col("shared") >= p.percent * F.col("either")).select("a", "b", *keep)


#: Nodes of a component that are paired in the first rounds; the last round takes all.
ROUNDS = (16, 64, 256)


def residue_links(nodes: DataFrame, sets: DataFrame, p: Hamming) -> DataFrame:
    """Links (a, b) that join all components of the nodes that any similar pair of nodes joins.

    No pair is missed: shingles are ordered from rare to common, and two sets whose overlap
    is large enough share a shingle so early in this order that as much of both is left
    (prefix and positional filters). Entries of one shingle are first grouped by component,
    size and position, so that a shingle of a whole component is one row of each kind. The
    Jaccard distance is a metric: nodes that are ``r`` and ``q`` from the leaders of their
    components are at least as far apart as the leaders less ``r + q``. The leaders of two
    components that meet are compared once, and only groups, and in them nodes, for which
    that bound leaves room are turned into pairs. Two components need one link: pairs of few
    nodes of each, drawn by hash, are confirmed first, and further pairs only of components
    without a link so far, in the end all of them.
    """
    bag = kept_table(sets.dropDuplicates(["node"]).join(nodes, "node"), "bags")
    leaders = kept_table(bag.groupBy("component").agg(F.min("node").alias("leader"), F.count("*").alias("members")), "leaders")
    place = (F.xxhash64("node", F.lit("turn")) / F.lit(2.0**64) + 0.5) * F.col("members")
    turn = sum((place >= n).cast("int") for n in ROUNDS)
    members = bag.select("node", "component").join(leaders, "component").select(F.col("node").alias("a"), F.col("leader").alias("b"), turn.alias("turn"))
    away = distances(members, bag.select("node", "shingles"))
    away = kept_table(away.select(F.col("a").alias("node"), F.col("distance").alias("r"), "turn"), "distances")
    shingles = bag.select("node", F.explode("shingles").alias("s"))
    holders = F.struct(F.bit_xor(F.xxhash64("node")), F.min(F.xxhash64(F.lit("least"), "node")))
    common = kept_table(shingles.groupBy("s").agg(F.count("*").alias("n"), holders.alias("holders")).where("n > 1"), "frequency")
    # shingles of the same nodes meet the same pairs: the first of them in the order stands for all
    lead = common.groupBy("n", "holders").agg(F.min("s").alias("s")).select("s", F.lit(True).alias("lead"))
    common = kept_table(common.drop("holders").join(lead, "s", "left"), "leading")
    known = shingles.join(common, "s", "left").groupBy("node")
    order = known.agg(F.sort_array(F.collect_list(F.struct(F.coalesce("n", F.lit(1)).alias("n"), "s", "lead"))).alias("order"))
    left = F.col("size") - F.col("at")  # shingles from this one on
    entry = order.join(bag.select("node", "component"), "node").withColumn("size", F.size("order"))
    entry = entry.select("node", "component", "size", F.posexplode(F.slice("order", 1, F.col("size") * (100 - p.percent) / 100 + 1)).alias("at", "o"))
    entry = entry.where(F.col("o.lead") & (100 * left >= p.percent * F.col("size"))).select("node", "component", "size", "at", F.col("o.s").alias("s"))
    entry = kept_table(entry.join(away, "node"), "entries")
    kind = entry.groupBy("s", "component", "size", "at").agg(F.max("r").alias("r"))
    several = kind.groupBy("s").agg(F.min("component").alias("least"), F.max("component").alias("most")).where("least <> most").select("s")
    kind = kept_table(kind.join(several, "s").select("s", "component", "size", "at", "r"), "kinds")
    small = kind.where((100 + p.percent) * left >= 2 * p.percent * F.col("size")).select("s", F.struct("component", "size", "at").alias("x"), F.col("r").alias("rx"))
    large = kind.select("s", F.struct("component", "size", "at").alias("y"), F.col("r").alias("ry"))
    overlap = F.least(F.col("x.size") - F.col("x.at"), F.col("y.size") - F.col("y.at"))
    may = (F.col("x.component") != F.col("y.component")) & (F.col("x.size") <= F.col("y.size"))
    may &= (100 + p.percent) * overlap >= p.percent * (F.col("x.size") + F.col("y.size"))
    met = kept_table(small.join(large, (small["s"] == large["s"]) & may).select(small["s"].alias("s"), "x", "y", "rx", "ry"), "met")
    lead_of = lambda end: leaders.select(F.col("component").alias(f"c{end}"), F.col("leader").alias(end))
    meeting = met.select(F.col("x.component").alias("ca"), F.col("y.component").alias("cb")).distinct()
    meeting = distances(meeting.join(lead_of("a"), "ca").join(lead_of("b"), "cb"), bag.select("node", "shingles")).drop("a", "b")
    # what the distance of the leaders leaves for the two nodes, with room for rounding
    meeting = kept_table(meeting.select("ca", "cb", (F.col("distance") - (1 - p.percent / 100) - 1e-9).alias("least")), "meeting")
    near = met.join(meeting, (F.col("x.component") == F.col("ca")) & (F.col("y.component") == F.col("cb")) & (F.col("rx") + F.col("ry") >= F.col("least")))
    near = kept_table(near.select("s", "x", "y", "least", "ry", "ca", "cb"), "near")

    def of(name: str, end: str, most: int) -> DataFrame:
        whole = F.struct("component", "size", "at").alias(end)
        return entry.where(F.col("turn") <= most).select("s", whole, F.col("node").alias(name), F.col("r").alias(f"r{name}"), F.col("turn").alias(f"t{name}"))

    links: DataFrame | None = None
    for k in range(len(ROUNDS) + 1):
        open_ = near
        if links is not None:
            open_ = near.join(links.select("ca", "cb").distinct(), ["ca", "cb"], "left_anti")
        pairs = open_.join(of("a", "x", k), ["s", "x"]).where(F.col("ra") + F.col("ry") >= F.col("least"))
        room = (F.col("ra") + F.col("rb") >= F.col("least")) & (F.greatest("ta", "tb") == k)
        pairs = pairs.join(of("b", "y", k), ["s", "y"]).where(room)
        pairs = pairs.groupBy(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).agg(F.first("ca").alias("ca"), F.first("cb").alias("cb"))
        found = kept_table(confirmed(pairs, sets, p, "ca", "cb"), "confirmed")
        links = found if links is None else links.unionByName(found)
    return links.select("a", "b")


def components(links: DataFrame) -> DataFrame:
    """node and the smallest node reachable over links (a, b), for nodes that have links.

    Alternates large-star and small-star steps, which keep each component connected while
    its members move to smaller nodes; the number of steps is logarithmic. A table of one
    row per node is written before it meets the links, so that adaptive execution can
    split the links of a node that has very many.
    """
    pointed = kept_table(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct(), "links")
    before = None
    while True:
        both = pointed.unionByName(pointed.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = kept_table(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least")), "least")
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).where("a > b").distinct()
        small = large.join(large.groupBy("a").agg(F.min("b").alias("least")), "a")
        moved = small.select(F.explode(F.array(F.struct("b", "least"), F.struct(F.col("a").alias("b"), "least"))).alias("m"))
        pointed = kept_table(moved.select(F.col("m.b").alias("a"), F.col("m.least").alias("b")).where("a > b").distinct(), "links")
        state = pointed.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if state == before:
            break
        before = state
    members = pointed.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return members.unionByName(members.select(F.col("component").alias("node"), "component").distinct())


def group(docs: DataFrame, params: Hamming = Hamming(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id and kept for each row.

    Words are lower-cased in A-Z only and lie between white space; a text of fewer words
    than a shingle is one shingle. Rows are linked when their sets' similarity is at least
    ``percent``; component_id is the smallest id reachable over links, kept marks the row
    that has it. A null text or one without words has no shingle and links with nothing,
    as does a row with a null id (component_id null, kept true). Rows that repeat an id
    are answered once each. No rows, no result; other columns are not read.
    """
    p = params
    read = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    signed = kept_table(signatures(read, p, "doc_id", "text"), "signatures")
    # a node is a sequence of words; its copies are folded before anything is compared
    nodes = kept_table(
        signed.where("doc_id is not null and words_hash is not null")
        .groupBy(F.col("words_hash").alias("node"))
        .agg(F.min("doc_id").alias("least_id"), F.first("n_shingles").alias("n_shingles"), F.first("signature").alias("signature")),
        "nodes",
    )
    keys = bucket_keys(nodes, p)
    ends = keys.groupBy("bucket").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low <> high")
    crowded = kept_table(keys.join(ends.drop("high"), "bucket"), "buckets")  # buckets of several nodes
    # only texts that met another are read again
    meeting = nodes.join(crowded.select("node").distinct(), "node", "left_semi").select(F.col("least_id").alias("doc_id"))
    sets = kept_table(shingle_sets(with_text_bytes(read.join(meeting, "doc_id", "left_semi"), [], "text"), p.words), "shingles")

    first = crowded.where("node > low").groupBy(F.col("node").alias("a")).agg(F.min("low").alias("b"))
    links = kept_table(confirmed(first, sets, p), "confirmed")
    for last in (False, True):
        found = kept_table(components(links), "components")
        labelled = crowded.select("bucket", "node", "n_shingles").join(found, "node", "left")
        labelled = labelled.withColumn("component", F.coalesce("component", "node"))
        member = F.struct("component", "node", "n_shingles")
        spread = labelled.groupBy("bucket").agg(F.min(member).alias("low"), F.max(member).alias("high"))
        split = labelled.join(spread.where("low.component <> high.component"), "bucket")
        if last:
            found = residue_links(kept_table(split.select("node", "component").distinct(), "residue"), sets, p)
        else:
            pairs = split.withColumn("end", F.explode(F.array("low", "high"))).where("component <> end.component")
            pairs = pairs.where(near_in_size(p, "n_shingles", "end.n_shingles"))
            pairs = pairs.select(F.greatest("node", "end.node").alias("a"), F.least("node", "end.node").alias("b")).distinct()
            found = kept_table(confirmed(pairs, sets, p), "confirmed")
        links = links.unionByName(found)
    found = components(links)
    named = nodes.select("node", "least_id").join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = named.groupBy("component").agg(F.min("least_id").alias("component_id"))
    of_node = kept_table(named.join(smallest, "component").select("node", "component_id"), "named")
    # rows are dealt out by node with their copies: few columns, and split where one node is hot
    rows = signed.select("doc_id", "n_shingles", F.col("words_hash").alias("node")).join(of_node, "node", "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return rows.select("doc_id", "n_shingles", own.alias("component_id"), F.coalesce(F.col("doc_id") == own, F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, params: Hamming = Hamming(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with one of each group, all columns as they were; rows of one id stay or go together."""
    dropped = group(docs, params, doc_id, text).where("not kept").select(F.col("doc_id").alias(doc_id)).distinct()
    return docs.join(dropped, docs[doc_id] == dropped[doc_id], "left_anti")
