"""Personal data: generators propose spans, boosted trees select them.

Generators propose candidates with high recall: the four base kinds by their rules, and
looser forms of each. Boosted trees, trained here, judge the looser candidates by their
format and the text around them. No table says which candidates are personal data, so the
training labels are the rules themselves: candidates that meet a base kind's rule are
positive, those that fail it and looser ones apart from all that meet one are taken as
negative, and the features leave out what the rules test by definition. A looser candidate that scores like those that meet a rule, above a
threshold calibrated on rows the trees have not seen, is selected as well. Base spans are
never dropped. The trees become one SQL expression over the candidates of a row, so
scoring needs no shuffle and no Python.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import isqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sondage.llm import spans
from sondage.llm.texts import kept_table, smallest_hashes, unpacked, whole_rows

BEFORE, AFTER = 24, 8


@dataclass(frozen=True)
class Kind:
    """A generator: expression, and the kind its candidates count as; ``base`` kinds have a rule."""

    name: str
    pattern: str
    base: bool = False


# The expressions match what their plain forms match; possessive quantifiers and a look
# behind (a run is entered at its start, or where the last match ended) keep the time
# linear on long runs of one class. Runs of digits that are no card by their number of
# digits are left out at once: a run is the same whether or not it is long enough.
_EMAIL_RUN = "A-Za-z0-9._%+-"
#: The kinds whose spans are always found, in their order.
BASE = (
    Kind("email", rf"(?:\G|(?<![{_EMAIL_RUN}]))[{_EMAIL_RUN}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", True),
    Kind("ip", r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}", True),
    Kind("card", r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){11,18}+(?![\x20-]?[0-9])", True),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", True),
)
LOOSE = (
    Kind("email_like", r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+\x20?(?:\(at\)|\[at\]|@)\x20?[A-Za-z0-9-]{1,63}+\x20?(?:\(dot\)|\[dot\]|\.)\x20?[A-Za-z]{2,24}"),
    Kind("ip_like", r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])"),
    Kind("number_like", r"(?<![0-9])[0-9]{2,6}(?:[\x20./-][0-9]{2,6}){1,5}(?![0-9])"),
    Kind("phone_like", r"(?<![0-9])\(?0{0,2}[0-9]{2,4}\)?[\x20./-][0-9]{3,4}[\x20./-][0-9]{3,5}(?![0-9])"),
    Kind("account_like", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"),
)


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(text: Column) -> Column:
    """True where the digits pass the Luhn check."""
    # digits from the right; every second one doubled, digits of the double added
    figures = F.reverse(F.split(digits(text), ""))
    doubled = F.transform(
        figures, lambda d, i: F.when(i % 2 == 0, d.try_cast("int")).otherwise(F.when(d.try_cast("int") > 4, d.try_cast("int") * 2 - 9).otherwise(d.try_cast("int") * 2))
    )
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + F.coalesce(d, F.lit(0))) % 10 == 0


def meets_rule(kind: str, match: Column) -> Column:
    """The base kinds' conditions on a whole match."""
    n = F.length(digits(match))
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return F.forall(F.split(match, r"\."), lambda x: x.rlike("^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    if kind == "card":
        return n.between(12, 19) & luhn(match)
    return n.between(9, 15)


#: Words near personal data, in the languages of the texts; fixed values.
CUES = "(?i)phone|tel|call|mobil|fax|mail|contact|contacto|kontakt|addr|adress|correo|courriel|card|karte|carte|tarjeta|iban|konto|account|cuenta|compte|ssn|ip"


def features(x: Column) -> dict[str, Column]:
    """Format and context of a candidate, all bounded integers."""
    match, before, after = x["match"], x["before"], x["after"]
    count = lambda c, cls: F.length(F.regexp_replace(c, f"[^{cls}]", ""))
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("int")
    return {
        "length": F.least(F.length(match), F.lit(64)),
        "digits": F.least(count(match, "0-9"), F.lit(32)),
        "letters": F.least(count(match, "A-Za-z"), F.lit(64)),
        "dots": F.least(count(match, "."), F.lit(8)),
        "blanks": F.least(count(match, " "), F.lit(8)),
        "dashes": F.least(count(match, "-"), F.lit(8)),
        "brackets": F.least(count(match, "()\\[\\]"), F.lit(4)),
        "groups": F.least(F.size(F.split(match, "[^A-Za-z0-9]+")), F.lit(12)),
        "word_before": flag(before.rlike(r"[A-Za-z]\W?\s?$")),
        "cue": flag(before.rlike(CUES)),
        "mark_before": flag(before.rlike(r"[:=#(]\s?$")),
        "joined": flag(before.rlike(r"[A-Za-z0-9_/]$")),
        "joined_after": flag(after.rlike(r"^[A-Za-z0-9_/@%]")),
        "figure_before": flag(before.rlike(r"[0-9]\s?$")),
    }


def candidates(text: Column) -> dict[str, Column]:
    """Candidates by generator; each is searched only where its rarest character occurs."""
    some_digit, at = text.rlike("[0-9]"), F.contains(text, F.lit("@"))
    needs = {"email": at, "phone": F.contains(text, F.lit("+")), "email_like": at | text.rlike(r"[(\[]at[)\]]"), "account_like": text.rlike("[A-Z]{2}[0-9]{2}")}
    return {k.name: spans.find(text, k.pattern, needs.get(k.name, some_digit), BEFORE, AFTER) for k in (*BASE, *LOOSE)}


@dataclass(frozen=True)
class Selector:
    """Trees as nested tuples (feature, threshold, left, right) or leaf values, with a threshold on their sum."""

    trees: tuple
    weights: tuple[float, ...]
    threshold: float

    def score(self, made: dict[str, Column]) -> Column:
        """Probability-like score from the features of a candidate."""

        def value(node) -> Column:
            if not isinstance(node, tuple):
                return F.lit(float(node))
            name, cut, left, right = node
            return F.when(made[name] <= cut, value(left)).otherwise(value(right))

        total = F.lit(0.0)
        for tree, weight in zip(self.trees, self.weights, strict=True):
            total = total + value(tree) * weight
        return F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-2.0) * total))


def training_rows(docs: DataFrame, doc_id: str, text: str, most_documents: int | None = None, most_rows: int | None = None) -> DataFrame:
    """Candidates of all documents, with features and labels, one row each.

    As in scoring, a candidate that a rule does not accept is left out where a base span
    that meets its rule overlaps it: it is personal data or a piece of it. ``train`` takes
    all of them; bounds are for trials, and keep what has the smallest hashes.
    """
    named = docs.select(F.col(doc_id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("body"))
    if most_documents is not None:
        named = named.join(F.broadcast(smallest_hashes(named.select("id"), most_documents, "id").distinct()), "id")
    some = named.where(F.col("body").rlike(r"[0-9@]|[(\[]at[)\]]")).select(F.xxhash64("id").alias("h"), "body")
    found = candidates(F.col("body"))
    some = some.select("h", *[c.alias(f"_{name}") for name, c in found.items()])
    base = spans.in_order(*[spans.as_spans(F.filter(F.col(f"_{k.name}"), _meets(k.name)), k.name, i) for i, k in enumerate(BASE)])
    some = some.withColumn("_base", base)
    rows = []
    for k in (*BASE, *LOOSE):
        labelled = F.transform(F.col(f"_{k.name}"), _labelled(k))
        rows.append(F.filter(labelled, lambda x: (x["label"] == 1) | _apart(x, F.col("_base"))))
    row = some.select("h", F.explode(F.flatten(F.array(*rows))).alias("c"))
    row = row.select((F.col("h") % 2 == 0).alias("fit"), F.col("c.label").alias("label"), *[v.alias(n) for n, v in features(F.col("c")).items()])
    return row if most_rows is None else smallest_hashes(row, most_rows, *row.columns)


def _labelled(kind: Kind):
    def of(x: Column) -> Column:
        good = meets_rule(kind.name, x["match"]) if kind.base else F.lit(False)
        return F.struct(*[x[c].alias(c) for c in ("match", "before", "after", "start", "end")], good.cast("double").alias("label"))

    return of


def train(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    trees: int = 9,
    depth: int = 4,
    precision: float = 0.98,
) -> Selector | None:
    """Boosted trees and their threshold from all documents; None if they hold one label only.

    Candidates with the same features and label are one row with their number as its
    weight, so what the trees are grown from follows the kinds of candidates and not the
    documents. Half the documents grow the trees. On the other half, scores fall into
    fifty bins; the threshold is the lowest bin above which the share of positives,
    smoothed by one negative, is at least ``precision``.
    """
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler

    rows = training_rows(docs, doc_id, text)
    names = [c for c in rows.columns if c not in ("fit", "label")]
    rows = kept_table(rows.groupBy(*rows.columns).agg(F.count("*").cast("double").alias("weight")), "candidates")
    sizes = [r["count"] for r in rows.where("fit").groupBy("label").count().collect()]
    if len(sizes) < 2:
        return None
    fit = VectorAssembler(inputCols=names, outputCol="features").transform(rows.where("fit"))
    # every value of a feature is a split point (65 at most), and with bins by the square
    # root of the rows Spark looks for these in all rows, of which it would draw some
    bins = max(66, isqrt(sum(sizes)) + 1)
    model = GBTClassifier(
        labelCol="label", featuresCol="features", weightCol="weight", maxIter=trees, maxDepth=depth, maxBins=bins, stepSize=0.3, seed=1
    ).fit(fit)

    def node(n):
        if n.subtreeDepth() == 0:
            return float(n.prediction())
        return (names[n.split().featureIndex()], float(n.split().threshold()), node(n.leftChild()), node(n.rightChild()))

    grown = tuple(node(t._call_java("rootNode")) for t in model.trees)
    selector = Selector(grown, tuple(model.treeWeights), 1.0)
    score = selector.score({c: F.col(c) for c in names})
    binned = rows.where("not fit").groupBy(F.floor(score * 50).alias("bin")).agg(F.sum("weight").alias("n"), F.sum(F.col("label") * F.col("weight")).alias("good"))
    n = good = 0.0
    threshold = 1.01
    for row in sorted(binned.collect(), key=lambda r: -r["bin"]):
        n, good = n + row["n"], good + row["good"]
        if good / (n + 1) >= precision:
            threshold = row["bin"] / 50
    return Selector(grown, tuple(model.treeWeights), threshold)


def find(
    docs: DataFrame, keep: list[str] = ["doc_id"], text: str = "text", doc_id: str = "doc_id", selector: Selector | None = None, learn: bool = True
) -> DataFrame:
    """The columns ``keep`` of each document with ``found``: spans (start, rank, kind, end) by start, then kind.

    Base spans are those of email, ip, card and phone matches (leftmost, not overlapping
    within their kind) that meet their rule; a match that fails is dropped without a
    retry. Spans of looser kinds are added where the trees select them and no base span
    overlaps them. Positions are code points, ends exclusive. A null text is empty; ids
    may be null or repeat, rows are judged one by one. Without candidates of both labels
    there is no model and base spans alone are returned. No rows, no result.
    """
    if selector is None and learn:
        selector = train(docs, doc_id, text)
    read = docs.select(*[F.col(c) for c in keep], F.coalesce(F.col(text), F.lit("")).alias("_pii_text"))
    found = candidates(F.col("_pii_text"))
    base = [spans.as_spans(F.filter(found[k.name], _meets(k.name)), k.name, i) for i, k in enumerate(BASE)]
    read = read.select(*keep, spans.in_order(*base).alias("_base"), *([found[k.name].alias(f"_{k.name}") for k in LOOSE] if selector else []))
    if not selector:
        return read.select(*keep, F.col("_base").alias("found"))
    added = [
        spans.as_spans(F.filter(F.col(f"_{k.name}"), lambda x: _apart(x, F.col("_base")) & (selector.score(features(x)) >= selector.threshold)), k.name, len(BASE) + i)
        for i, k in enumerate(LOOSE)
    ]
    return read.select(*keep, spans.in_order(F.col("_base"), *added).alias("found"))


def _meets(kind: str):
    return lambda x: meets_rule(kind, x["match"])


def _apart(x: Column, base: Column) -> Column:
    return ~F.exists(base, lambda s: (s["start"] < x["end"]) & (x["start"] < s["end"]))


def redact(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", mask: str = "[PII]", **options) -> DataFrame:
    """The documents with each span replaced by ``mask``; other columns as they were."""
    marked = find(whole_rows(docs, text, doc_id), keep=["_row"], text="_text", doc_id=f"_{doc_id}", **options)
    return unpacked(marked, docs.columns, **{text: spans.masked(F.col("_row")[text], F.col("found"), mask)})
