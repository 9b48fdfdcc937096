"""Secret scans over a trigram inverted index.

Each rule's regular expression yields a Boolean query of trigrams that every match must
contain. The index holds, for each block of documents and each trigram that some rule
asks for, the documents whose lower-cased text has it; postings are intersected and
united as the queries say, and only the candidates meet the expression itself. A rule
without mandatory trigrams scans every text. Everything is DataFrame functions.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from re import _constants as op
from re import _parser as parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sondage.llm import spans
from sondage.llm.texts import kept_table, unpacked, whole_rows

#: Candidate ids up to this many are broadcast to the verifying scan; more are joined by shuffle.
BROADCAST_IDS = 100_000
#: Documents of one block of the index, on average.
BLOCK = 4096
#: Alternatives a run of literals may branch into before it is cut.
MOST_STRINGS = 64


@dataclass(frozen=True)
class Rule:
    """A kind of secret: expression, and the least length of one of its groups."""

    kind: str
    pattern: str
    least: int = 0
    group: int = 0


#: The kinds whose spans are always found, in their order.
BASE = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 12, 2),
    Rule("access", r"AKIA[A-Z0-9]{14,}"),
    Rule("hex", r"[0-9a-f]{16,}"),
)
#: Public formats of keys that the base kinds don't name.
MORE = (
    Rule("private_key", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"[rs]k_(?:live|test)_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("url_password", r"://[A-Za-z0-9._-]{1,64}:[^\s:@/]{6,128}@[A-Za-z0-9]"),
)


# A query is a trigram, ("and", queries), ("or", queries), or None: no condition.
def _all(queries: list) -> object:
    known = list(dict.fromkeys(q for q in queries if q is not None))
    return None if not known else known[0] if len(known) == 1 else ("and", tuple(known))


def _any(queries: list) -> object:
    known = list(dict.fromkeys(queries))
    return None if None in known or not known else known[0] if len(known) == 1 else ("or", tuple(known))


def _of_strings(strings: set[str]) -> object:
    """What a text has that contains one of the strings."""
    needs = {frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings}
    weakest = [n for n in needs if not any(other < n for other in needs)]
    return _any([_all(sorted(n)) for n in sorted(weakest, key=sorted)])


def _strings(node) -> set[str] | None:
    """All strings a node matches, lower-cased, if they are few."""
    kind, value = node
    if kind is op.LITERAL:
        return {chr(value).lower()}
    if kind is op.IN:
        if all(k is op.LITERAL for k, _ in value):
            return {chr(v).lower() for _, v in value}
        if all(k is op.RANGE for k, _ in value) and sum(v[1] - v[0] + 1 for _, v in value) <= 8:
            return {chr(c).lower() for _, v in value for c in range(v[0], v[1] + 1)}
        return None
    if kind is op.SUBPATTERN:
        return _sequence(value[3])
    if kind is op.BRANCH:
        found = [_sequence(x) for x in value[1]]
        return None if None in found else set().union(*found)
    if kind is op.MAX_REPEAT and value[1] <= 2:
        one = _sequence(value[2])
        if one is None:
            return None
        out = {""} if value[0] == 0 else set()
        power = {""}
        for n in range(1, int(value[1]) + 1):
            power = {a + b for a in power for b in one}
            out |= power if n >= value[0] else set()
        return out
    return None


def _sequence(nodes) -> set[str] | None:
    out = {""}
    for node in nodes:
        more = _strings(node)
        if more is None or len(out) * len(more) > MOST_STRINGS:
            return None
        out = {a + b for a in out for b in more}
    return out


def _query(nodes) -> object:
    parts, run = [], {""}
    for node in nodes:
        more = _strings(node)
        if more is not None and len(run) * len(more) <= MOST_STRINGS:
            run = {a + b for a in run for b in more}
            continue
        parts.append(_of_strings(run))
        run = {""} if more is None else more
        kind, value = node
        if more is None and kind is op.SUBPATTERN:
            parts.append(_query(value[3]))
        elif more is None and kind is op.BRANCH:
            parts.append(_any([_query(x) for x in value[1]]))
        elif more is None and kind in (op.MAX_REPEAT, op.POSSESSIVE_REPEAT) and value[0] > 0:
            parts.append(_query(value[2]))
    return _all([*parts, _of_strings(run)])


def trigram_query(pattern: str) -> object:
    """The Boolean trigram query of an expression, over lower-cased text; None if it has none."""
    return _query(parser.parse(pattern))


def trigrams(query: object) -> set[str]:
    if query is None:
        return set()
    return {query} if isinstance(query, str) else set().union(*map(trigrams, query[1]))


def build_index(docs: DataFrame, asked: list[str], doc_id: str, text: str) -> DataFrame:
    """Postings: block, trigram, and the ids of the block's documents that contain it."""
    blocks = max(1, -(-docs.count() // BLOCK))
    low = docs.where(F.col(doc_id).isNotNull()).select(F.col(doc_id).alias("doc_id"), F.lower(text).alias("low"))
    has = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in asked]))
    entries = low.select("doc_id", F.explode(has).alias("trigram"))
    block = F.pmod(F.xxhash64("doc_id"), F.lit(blocks)).alias("block")
    return entries.groupBy(block, "trigram").agg(F.collect_set("doc_id").alias("ids"))


def candidates(index: DataFrame, queries: dict[str, object]) -> DataFrame:
    """doc_id and the rules whose trigram query it meets."""
    kind = dict(index.dtypes)["ids"]
    postings = F.map_from_entries(F.collect_list(F.struct("trigram", "ids")))
    block = index.groupBy("block").agg(postings.alias("postings"))

    def ids(query: object) -> Column:
        if isinstance(query, str):
            return F.coalesce(F.try_element_at("postings", F.lit(query)), F.array().cast(kind))
        return reduce(F.array_intersect if query[0] == "and" else F.array_union, map(ids, query[1]))

    def named(rule: str) -> Callable[[Column], Column]:
        return lambda d: F.struct(d.alias("doc_id"), F.lit(rule).alias("rule"))

    met = [F.transform(ids(query), named(rule)) for rule, query in queries.items()]
    pairs = block.select(F.explode(F.flatten(F.array(*met))).alias("m")).select("m.doc_id", "m.rule")
    return pairs.groupBy("doc_id").agg(F.collect_set("rule").alias("rules"))


def _long_enough(rule: Rule) -> Callable[[Column], Column]:
    return lambda x: F.length(F.regexp_extract(x["match"], rule.pattern, rule.group)) >= rule.least


def scan(
    docs: DataFrame, keep: list[str] = ["doc_id"], text: str = "text", doc_id: str = "doc_id", rules: tuple[Rule, ...] = (*BASE, *MORE)
) -> DataFrame:
    """The columns ``keep`` of each document with ``found``: spans (start, rank, kind, end) by start, then rule.

    Positions are code points, ends exclusive. Matches of a rule are leftmost and do not
    overlap; one whose group is too short is dropped without a retry. Spans of different
    rules may overlap. A null text is empty. A row with a null id is verified against all
    rules; rows that repeat an id share its candidates, and the expressions decide for
    each. No rows, no result.
    """
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    indexed = {k: q for k, q in queries.items() if q is not None}
    read = docs.select(*[F.col(c) for c in keep], F.col(doc_id).alias("_scan_id"), F.coalesce(F.col(text), F.lit("")).alias("_scan_text"))
    if indexed:
        index = kept_table(build_index(read, sorted(set().union(*map(trigrams, indexed.values()))), "_scan_id", "_scan_text"), "trigrams")
        met = kept_table(candidates(index, indexed), "candidates").select(F.col("doc_id").alias("_met_id"), F.col("rules").alias("_met_rules"))
        met = F.broadcast(met) if met.count() <= BROADCAST_IDS else met
        read = read.join(met, F.col("_scan_id") == F.col("_met_id"), "left")
    found = []
    for rank, rule in enumerate(rules):
        asked = F.col("_scan_id").isNull() | F.coalesce(F.array_contains("_met_rules", rule.kind), F.lit(False)) if rule.kind in indexed else None
        matches = spans.find(F.col("_scan_text"), rule.pattern, asked)
        if rule.least:
            matches = F.filter(matches, _long_enough(rule))
        found.append(spans.as_spans(matches, rule.kind, rank))
    return read.select(*keep, spans.in_order(*found).alias("found"))


def mask_secrets(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", mask: str = "[SECRET]", **options) -> DataFrame:
    """The documents with every secret replaced by ``mask``; other columns as they were."""
    scanned = scan(whole_rows(docs, text, doc_id), keep=["_row"], text="_text", doc_id=f"_{doc_id}", **options)
    return unpacked(scanned, docs.columns, **{text: spans.masked(F.col("_row")[text], F.col("found"), mask)})
