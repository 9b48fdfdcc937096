"""The registered queries of the operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sondage.llm import (
    centroid_clusters,
    decontamination,
    html_text,
    language_id,
    near_dedup,
    packing,
    pii,
    quality_gam,
    quality_rules,
    secret_scan,
    spans,
    toxicity,
    url_filter,
    whitening,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(check: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if check:
            CHECKS[f.__name__] = check
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


OP3_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
g AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS size,
    array_to_string(w[i : i + least(13, len(w)) - 1], ' ') AS gram
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM g),
dg AS (
  SELECT doc_id, size, i, array_to_string(w[i : i + size - 1], ' ') AS gram
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d, sizes WHERE len(w) >= size)),
m AS (SELECT dg.doc_id, dg.i, dg.size, g.item_id FROM dg JOIN g ON dg.gram = g.gram AND dg.size = g.size),
h AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS k FROM m) GROUP BY doc_id),
n AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(item_id, ',' ORDER BY item_id)) AS items_sha256
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM m) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  coalesce(items_sha256, sha256('')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN h ON d.doc_id = h.doc_id LEFT JOIN n ON d.doc_id = n.doc_id
"""


@query(OP3_SQL)
def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test items found in documents, by 13-word windows."""
    found = decontamination.find_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    hits, n_words = F.col("hits"), F.col("n_words")
    return found.select(
        "doc_id",
        "n_words",
        decontamination.n_hit(hits).alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        decontamination.contaminated(hits, n_words).alias("contaminated"),
    )


OP4_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + least(4, len(w)) - 1], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - least(4, len(w)) + 2)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (
  SELECT a, b FROM p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b WHERE 100 * k >= 80 * (x.n + y.n - k)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r AS (SELECT a AS doc_id, a AS c FROM e UNION SELECT e.b, r.c FROM r JOIN e ON r.doc_id = e.a),
c AS (SELECT doc_id, min(c) AS c FROM r GROUP BY doc_id)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c.c, w.doc_id) AS component_id, coalesce(c.c, w.doc_id) = w.doc_id AS kept
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN c ON c.doc_id = w.doc_id
"""


@query(OP4_SQL)
def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents whose 4-word shingle sets are linked at 0.8."""
    return near_dedup.group(table(spark, sf_dir, "documents"), near_dedup.Hamming(words=4))


@query()
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, base rules and compression bands of each document."""
    return quality_rules.score_rules(table(spark, sf_dir, "documents"))


@query()
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 4096 tokens."""
    pieces = packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def _digests(found: str, kinds: list[str]) -> list:
    """Counts and digest of the base kinds, and all spans written out."""
    def of(*names: str) -> Column:
        return F.filter(found, lambda s: s["kind"].isin(*names))

    base = of(*kinds)
    counts = [F.size(of(k)).cast("bigint").alias(f"n_{k}") for k in kinds]
    return [*counts, F.sha2(spans.written(base), 256).alias("base_sha256"), spans.written(F.col(found)).alias("spans")]


@query()
def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in documents, by a trigram index."""
    found = secret_scan.scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", *_digests("found", ["assign", "access", "hex"]))


@query()
def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in documents: base spans and those that boosted trees add."""
    found = pii.find(table(spark, sf_dir, "documents"))
    return found.select("doc_id", *_digests("found", ["email", "ip", "card", "phone"]))


#: The rules of the contract.
URL_RULES = [
    url_filter.Rule("allow", "org", "/"),
    url_filter.Rule("block", "example.org", "/es/"),
    url_filter.Rule("block", "example.org", "/en/1"),
    url_filter.Rule("allow", "com", "/fr/"),
    url_filter.Rule("block", "com", "/de/"),
]


@query()
def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on all pages by rules and path templates."""
    return url_filter.judge(table(spark, sf_dir, "pages"), rules=URL_RULES)


@query()
def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visible text of all pages."""
    return html_text.extract(table(spark, sf_dir, "pages"))


def _predicted(scored: DataFrame, at_least: float) -> DataFrame:
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= at_least).cast("int").alias("predicted"))


@query()
def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document by an additive model with pairs."""
    return _predicted(quality_gam.learn_and_score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")), 0.3)


@query()
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document by compression distance."""
    return _predicted(toxicity.learn_and_score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")), 0.7)


@query()
def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document by naive Bayes over hashed character n-grams."""
    return language_id.learn_and_predict(table(spark, sf_dir, "documents"))


def _rounds_in_sql(rounds: int = 10) -> str:
    """The clustering contract, a pair of subqueries for each round."""
    near = """a{k} AS MATERIALIZED (
  SELECT vec_id, min(cluster) AS cluster, min(d) AS distance FROM (
    SELECT vec_id, cluster, d, min(d) OVER (PARTITION BY vec_id) AS least FROM (
      SELECT vec_id, cluster, sum((v.x - c.x) * (v.x - c.x)) AS d FROM v JOIN c{k} c ON v.i = c.i GROUP BY vec_id, cluster))
  WHERE d = least GROUP BY vec_id)"""
    move = """c{n} AS MATERIALIZED (
  SELECT c.cluster, c.i, CASE WHEN m.n IS NULL THEN c.x ELSE (m.s - ((m.s % m.n) + m.n) % m.n) // m.n END AS x
  FROM c{k} c LEFT JOIN (
    SELECT cluster, i, sum(x) AS s, count(*) AS n FROM v JOIN a{k} a ON v.vec_id = a.vec_id GROUP BY cluster, i) m
  ON m.cluster = c.cluster AND m.i = c.i)"""
    steps = [f"{near.format(k=k)},\n{move.format(k=k, n=k + 1)}" for k in range(rounds)]
    return f"""
WITH kept AS (
  SELECT vec_id, embedding FROM embeddings
  WHERE len(embedding) = 64 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
v AS MATERIALIZED (
  SELECT vec_id, i, CAST(floor(1024 * CAST(embedding[i] AS DOUBLE)) AS BIGINT) AS x FROM kept, unnest(range(1, 65)) AS r(i)),
c0 AS MATERIALIZED (
  SELECT cluster, i, x FROM v JOIN (
    SELECT vec_id, row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS cluster FROM kept
    QUALIFY cluster < 8) f ON v.vec_id = f.vec_id),
{(","+chr(10)).join(steps)},
{near.format(k=rounds)}
SELECT a.vec_id, CAST(a.cluster AS INTEGER) AS cluster, CAST(distance AS BIGINT) AS distance,
  CAST(sum(distance) OVER (PARTITION BY a.cluster) AS BIGINT) AS cluster_inertia, CAST(sum(distance) OVER () AS BIGINT) AS inertia, h.centroid_sha256
FROM a{rounds} a JOIN (SELECT cluster, sha256(string_agg(x, ',' ORDER BY i)) AS centroid_sha256 FROM c{rounds} GROUP BY cluster) h ON h.cluster = a.cluster
"""


@query(_rounds_in_sql())
def op11_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters of all embeddings, exact in whole numbers."""
    return centroid_clusters.cluster(table(spark, sf_dir, "embeddings"))


@query()
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened components of all embeddings."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"))
