"""The pipeline's stages, each against a plain version on what the stage before it kept."""

from pathlib import Path

import numpy as np
import pytest
import zstandard

import __spark_entry__ as entry
import corpus_pipeline
from sondage.llm import quality_rules, queries
from tests.llm.test_decontamination import plain_hits
from tests.llm.test_near_dedup import plain_groups
from tests.llm.test_quality_rules import plain as plain_counts
from tests.llm.test_secret_scan import plain as plain_secrets

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).is_dir(), reason="test tables are not here")


def masked(text):
    out, at = "", 0
    spans = []
    for _, start, end in plain_secrets(text):
        if spans and start <= spans[-1][1]:
            spans[-1][1] = max(end, spans[-1][1])
        else:
            spans.append([start, end])
    for start, end in spans:
        out, at = out + text[at:start] + "[SECRET]", end
    return out + text[at:]


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    kept = {r["doc_id"]: r["text"] for r in docs.collect()}
    packer, bands = zstandard.ZstdCompressor(level=3), quality_rules.Bands()
    expected = []
    step = {}
    for d, t in kept.items():
        n, _, _, _, repeated = plain_counts(t)
        if n >= 50 and 100 * repeated <= 50 * n and quality_rules.band_verdict(t.encode(), packer, bands)[2]:
            step[d] = t
    expected.append(step)
    groups = plain_groups(list(step.items()), 5)
    step = {d: step[d] for d, _, c in groups if d == c}
    expected.append(step)
    hits = {d: plain_hits(t, items) for d, t in step.items()}
    step = {d: t for d, t in step.items() if not hits[d][1] or 20 * len(hits[d][1]) < hits[d][0]}
    expected.append(step)
    step = {d: masked(t) for d, t in step.items()}
    expected.append(step)
    assert len(kept) > len(expected[0]) > len(expected[1]) >= len(expected[2])
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        assert docs.columns == corpus_pipeline.COLUMNS, name
        got = docs.collect()
        assert len(got) == len(expected[k]), name
        assert {r["doc_id"]: r["text"] for r in got} == expected[k], name
        assert all(r["n_chars"] == len(r["text"]) for r in got if k == 3)
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.tokenizer_path())
    parts = {}
    for r in corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect():
        parts.setdefault(r["doc_id"], []).append((r["start"], bytes(r["ids"])))
    got = {d: np.frombuffer(b"".join(b for _, b in sorted(p)), "<u4").tolist() for d, p in parts.items()}
    assert got == {d: [*tokenizer.encode(t, add_special_tokens=False).ids, 2] for d, t in step.items()}


def test_queries_are_registered():
    names = entry.queries()
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{k}" for k in range(1, 11)}
    assert "pipeline" in names and "pipeline" not in entry.oracle_sql()


def test_odd_documents_pass_every_stage(spark):
    """Null ids and texts, repeated rows and an empty table go through all stages."""
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    rows = [(1, None, None, None, None), (None, "x " * 80, "en", None, 1), (2, "", "en", "s", 0), (2, "", "en", "s", 0)]
    for docs in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        for _, stage in corpus_pipeline.STAGES:
            stage(spark, docs, SF).collect()
