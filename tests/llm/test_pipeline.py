"""The pipeline and the registered queries of the folder."""

from __future__ import annotations

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from medvoice.llm.frames import stored
from medvoice.llm.queries import QUERIES
from tests.llm import brute


@pytest.fixture(scope="module")
def documents(sf_dir):
    rows = pq.read_table(f"{sf_dir}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    return [(r["doc_id"], r["text"]) for r in rows]


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_string_query(spark, sf_dir, documents):
    rows = QUERIES["op1_suffix_array_dedup"](spark, sf_dir).collect()
    assert sorted(map(tuple, rows)) == sorted(brute.strings(documents, 50))


def test_near_query(spark, sf_dir, documents):
    rows = QUERIES["op10_minhash_near_dedup"](spark, sf_dir).collect()
    assert sorted((r.doc_id, r.class_id) for r in rows) == sorted(
        (i, c) for (i, _), c in zip(documents, brute.classes(documents))
    )


def test_stages(spark, sf_dir):
    """Each stage judged on its own input, by plain loops where they can tell."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "line_dedup", "near_dedup", "decontamination", "mixing"]
    for name, stage in corpus_pipeline.STAGES:
        before = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
        after = stored(stage(spark, docs, sf_dir), name)
        if name == "mixing":
            assert after.count() == len(before)
            break
        assert after.columns == columns
        rows = {r.doc_id: r.text for r in after.collect()}
        if name == "toxicity":
            text = dict(before)
            assert len(rows) > 0.8 * len(before) and all(text[i] == t for i, t in rows.items())
        elif name == "line_dedup":
            assert [(i, brute.sha(brute.utf8(rows[i]))) for i, *_ in before] == [(r[0], r[3]) for r in brute.lines(before)]
            assert after.where(F.char_length("text") != F.col("n_chars")).count() == 0
        elif name == "near_dedup":
            words = {i for i, t in before if brute.shingles(t)}
            classes = brute.classes(before)
            assert {i for i in rows if i in words} == {c for (i, _), c in zip(before, classes) if i in words}
        else:
            bad = {r[0] for r in brute.contamination(before, items) if r[5]}
            assert set(rows) == {i for i, _ in before} - bad
        docs = after
