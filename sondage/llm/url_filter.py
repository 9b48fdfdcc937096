"""URL filters by a path-template tree.

Each host's paths form a tree of segments. Segments that vary become wildcards, first by
form (numbers, hexadecimal names) and then by support (segments too rare under their
host to be a branch). Nodes of the tree carry labelled counts, smoothed towards their
parents; a branch whose share of blocked pages does not differ significantly from its
parent's is merged with it, and a template is rejected if the purity of the node it ends
up in reaches a threshold. Above the hosts stand the same templates over all hosts, so a
host without labels follows what is known of its templates elsewhere. All of it is
grouping and joining of template rows; pages meet the result by one join.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sondage.llm.texts import kept_table, lower_ascii


@dataclass(frozen=True)
class Tree:
    """``depth``: segments that can branch, the rest being one wildcard; ``support``: pages
    a literal segment needs; ``prior``: rows of the parent's purity added to each node;
    ``apart``: standard errors by which a branch must differ to stand on its own;
    ``reject``: purity of blocked pages from which a template is rejected."""

    depth: int = 4
    support: int = 8
    prior: float = 4.0
    apart: float = 2.0
    reject: float = 0.5


@dataclass(frozen=True)
class Rule:
    """A verdict for a host with its subdomains and a path prefix."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to a slash, question mark, hash or the end, A-Z lower-cased; else empty."""
    return F.coalesce(lower_ascii(F.regexp_extract(url, "://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to a question mark, hash or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """Name of the longest rule that fits, of equals the first in order; null if none does."""
    longest_first = sorted(rules, key=lambda r: (-len(r.name), r.name))
    fits = [(host == r.host) | host.endswith("." + r.host) for r in longest_first]
    names = [F.when(f & path.startswith(r.path), F.lit(r.name)) for f, r in zip(fits, longest_first, strict=True)]
    return F.coalesce(*names, F.lit(None).cast("string"))


def verdict_of_rule(rule: Column, rules: list[Rule]) -> Column:
    found = F.lit(None).cast("string")
    for r in rules:
        found = F.when(rule == r.name, F.lit(r.verdict)).otherwise(found)
    return found


#: Segments that vary by their form: numbers, and hexadecimal names with a digit.
_NUMBER, _NAME = r"^[0-9]+(\.[A-Za-z0-9]{1,5})?$", r"^(?=.*[0-9])[0-9A-Fa-f-]{8,}(\.[A-Za-z0-9]{1,5})?$"


def segments(path: Column, depth: int) -> Column:
    """Segments of a path; varying ones as ``*`` with their extension, those past ``depth`` as one ``**``."""
    parts = F.filter(F.split(path, "/"), lambda s: s != "")
    known = F.transform(
        F.slice(parts, 1, depth),
        lambda s: F.when(s.rlike(_NUMBER) | s.rlike(_NAME), F.concat(F.lit("*"), F.regexp_extract(s, r"(\.[A-Za-z][A-Za-z0-9]{0,4})$", 1))).otherwise(s),
    )
    return F.concat(known, F.when(F.size(parts) > depth, F.array(F.lit("**"))).otherwise(F.array().cast("array<string>")))


def _joined(parts: Column) -> Column:
    return F.concat(F.lit("/"), F.array_join(parts, "/"))


def templates(paths: DataFrame, tree: Tree) -> DataFrame:
    """host, form (segments) and template of each distinct form, from host, form, n."""
    deep = paths.select("host", "form", "n", F.explode(F.sequence(F.lit(0), F.size("form"))).alias("d"))
    deep = deep.where("d > 0").withColumn("prefix", _joined(F.slice("form", 1, F.col("d"))))
    common = deep.groupBy("host", "prefix").agg(F.sum("n").alias("n")).where(F.col("n") >= tree.support).select("host", "prefix")
    common = kept_table(common, "branches")
    branch = deep.select("host", "form", "d", "prefix").join(common.withColumn("kept", F.lit(True)), ["host", "prefix"], "left")
    named = branch.groupBy("host", "form").agg(F.sort_array(F.collect_list(F.when(F.col("kept"), F.col("d")))).alias("kept"))
    rows = paths.select("host", "form").join(named, ["host", "form"], "left")
    kept = F.coalesce("kept", F.array().cast("array<int>"))
    part = F.transform("form", lambda s, i: F.when(F.array_contains(kept, i + 1) | s.startswith("*"), s).otherwise(F.lit("*")))
    return rows.select("host", "form", part.alias("template"))


def judged(leaves: DataFrame, tree: Tree) -> DataFrame:
    """host, template and purity of each leaf, from host, template, labelled, blocked.

    A leaf's nodes, from the root: all hosts; the leading segments of its template over
    all hosts; its host; the leading segments under its host.
    """
    chain = F.concat(
        F.array(F.lit("//")),
        F.transform(F.sequence(F.lit(1), F.lit(tree.depth + 1)), lambda d: F.concat(F.lit("/"), _joined(F.slice("template", 1, d)))),
        F.array(F.concat(F.col("host"), F.lit("//"))),
        F.transform(F.sequence(F.lit(1), F.lit(tree.depth + 1)), lambda d: F.concat(F.col("host"), _joined(F.slice("template", 1, d)))),
    )
    nodes = leaves.select("host", "template", "labelled", "blocked", F.posexplode(F.array_distinct(chain)).alias("level", "node"))
    counts = kept_table(nodes.groupBy("node").agg(F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked")), "purity")
    lines = nodes.select("host", "template", "level", "node").join(counts, "node").groupBy("host", "template")
    line = lines.agg(F.sort_array(F.collect_list(F.struct("level", "labelled", "blocked"))).alias("line"))

    def down(purity: Column, node: Column) -> Column:
        n, share = node["labelled"], (node["blocked"] + tree.prior * purity) / (node["labelled"] + tree.prior)
        error = F.sqrt(F.greatest(purity * (1 - purity), F.lit(0.01)) / F.greatest(n, F.lit(1)))
        return F.when((n > 0) & (F.abs(node["blocked"] / F.greatest(n, F.lit(1)) - purity) >= tree.apart * error), share).otherwise(purity)

    return line.select("host", "template", F.aggregate("line", F.lit(0.0), down).alias("purity"))


def judge(
    pages: DataFrame, keep: list[str] = ["page_id"], url: str = "url", rules: list[Rule] = [], blocked: str | None = None, tree: Tree = Tree()
) -> DataFrame:
    """The columns ``keep`` with host, path, rule, template, purity and verdict.

    ``rules`` decide the pages they fit; their verdicts are also the labels of the tree,
    unless ``blocked`` names a column of 1, 0 and null. Other pages follow their template:
    blocked from a purity of ``tree.reject``, else allowed. A null url, or one without
    ``://``, has an empty host and path. Without any label every purity is 0. Repeated
    rows count as often as they occur and are answered each. No rows, no result.
    """
    host, path = host_of(F.col(url)), path_of(F.col(url))
    given = [F.col(blocked).cast("double").alias("_blocked")] if blocked else []
    read = pages.select(*[F.col(c) for c in keep], host.alias("_host"), path.alias("_path"), *given)
    read = read.withColumn("_rule", fitting_rule(F.col("_host"), F.col("_path"), rules)).withColumn("_form", segments(F.col("_path"), tree.depth))
    ruled = verdict_of_rule(F.col("_rule"), rules)
    label = F.col("_blocked") if blocked else F.when(ruled == "block", F.lit(1.0)).when(ruled == "allow", F.lit(0.0))
    paths = read.groupBy(F.col("_host").alias("host"), F.col("_form").alias("form")).agg(
        F.count("*").alias("n"), F.count(label).cast("double").alias("labelled"), F.coalesce(F.sum(label), F.lit(0.0)).alias("blocked")
    )
    paths = kept_table(paths, "paths")
    shaped = kept_table(templates(paths, tree), "templates")
    leaves = paths.join(shaped, ["host", "form"]).groupBy("host", "template").agg(F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked"))
    purity = judged(kept_table(leaves, "leaves"), tree)
    answer = kept_table(shaped.join(purity, ["host", "template"]), "answers")
    answer = answer.select(F.col("host").alias("_h"), F.col("form").alias("_f"), F.col("template").alias("_t"), F.col("purity").alias("_p"))
    met = read.join(answer, (F.col("_host") == F.col("_h")) & (F.col("_form") == F.col("_f")), "left")
    verdict = F.coalesce(ruled, F.when(F.col("_p") >= tree.reject, F.lit("block")).otherwise(F.lit("allow")))
    return met.select(
        *keep,
        F.col("_host").alias("host"),
        F.col("_path").alias("path"),
        F.col("_rule").alias("rule"),
        _joined(F.col("_t")).alias("template"),
        F.col("_p").alias("purity"),
        verdict.alias("verdict"),
    )
