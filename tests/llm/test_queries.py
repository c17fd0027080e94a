"""The registered queries without SQL: what is exact in them, by plain loops over whole tables."""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from math import log10

import pyarrow.parquet as pq
import pytest

from medvoice.llm.queries import QUERIES
from tests.llm import brute


@pytest.fixture(scope="module")
def documents(sf_dir):
    rows = pq.read_table(f"{sf_dir}/documents.parquet", columns=["doc_id", "text", "source", "lang"]).to_pylist()
    return sorted(rows, key=lambda r: r["doc_id"])


def run(spark, sf_dir, name):
    rows = QUERIES[name](spark, sf_dir).collect()
    return sorted(rows, key=lambda r: r.doc_id)


def fold(doc_id: int, folds: int) -> int:
    return zlib.crc32(str(doc_id).encode()) % folds


def test_fingerprints(spark, sf_dir, documents):
    got = run(spark, sf_dir, "op2_document_fingerprints")
    texts = [r["text"] or "" for r in documents]
    # The next document has the next smaller id; after the last one comes the first.
    for k, (row, r) in enumerate(zip(got, documents, strict=True)):
        text, n = texts[k], len(texts[k])
        edited = text[: n - n // 2] + texts[k - 1][: n // 2]
        assert (row.doc_id, row.n_chars, row.edited_sha256) == (r["doc_id"], n, brute.sha(edited.encode()))
        assert 0 <= row.near_edited <= 1 and 0 <= row.near_next <= 1
        if edited == text:
            assert row.fingerprint == row.edited_fingerprint and row.near_edited == 1
    by_text = defaultdict(set)
    for row, text in zip(got, texts):
        by_text[text].add(row.fingerprint)
    assert all(len(prints) == 1 for prints in by_text.values())


def test_toxicity(spark, sf_dir, documents):
    got = run(spark, sf_dir, "op3_toxicity")
    assert [(r.doc_id, r.held_out) for r in got] == [(r["doc_id"], fold(r["doc_id"], 5) == 0) for r in documents]
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)


def test_lm_base_score(spark, sf_dir, documents):
    got = run(spark, sf_dir, "op4_lm_scoring")
    tokens = [[*brute.VISIBLE.findall(brute.utf8(r["text"]).translate(brute.LOWER)), None] for r in documents]
    held = [fold(r["doc_id"], 5) == 1 for r in documents]
    count = Counter(t for own, out in zip(tokens, held) if not out for t in own)
    total = sum(count.values())
    for row, own, out in zip(got, tokens, held, strict=True):
        assert (row.held_out, row.n_tokens, row.train_tokens) == (out, len(own), total)
        assert row.n_known == sum(t in count for t in own)
        base = sum(log10((count[t] + 0.5) / (total + 0.5 * (len(count) + 1))) for t in own)
        assert row.base_score == pytest.approx(base, rel=1e-9)
        assert row.score < 0


def test_mix(spark, sf_dir, documents):
    got = run(spark, sf_dir, "op8_mixing_sources")
    size = {r["doc_id"]: len(brute.VISIBLE.findall(brute.utf8(r["text"]))) for r in documents}
    source = {r["doc_id"]: r["source"] for r in documents}
    own = Counter()
    for i, s in source.items():
        own[s] += size[i]
    weight = {s: n % 3 + 1 for n, s in enumerate(sorted(own, key=lambda s: (s is None, s or "")))}
    # Water filling: whoever is above its limit stays there, the others share the rest anew.
    target, full = {}, set()
    while True:
        rest = sum(own.values()) - sum(3 * own[s] for s in full)
        shared = sum(w for s, w in weight.items() if s not in full)
        target = {s: 3.0 * own[s] if s in full else rest * w / shared for s, w in weight.items()}
        above = {s for s in target if target[s] > 3 * own[s] + 1e-9}
        if not above:
            break
        full |= above
    taken = Counter()
    for r in got:
        assert (r.size, r.source_size) == (size[r.doc_id], own[source[r.doc_id]])
        assert r.target == pytest.approx(target[source[r.doc_id]])
        assert 0 <= r.taken <= 3 * r.size
        taken[source[r.doc_id]] += r.taken
    assert len(got) == len(documents)
    assert all(abs(taken[s] - target[s]) <= 64 for s in target)
    assert got == run(spark, sf_dir, "op8_mixing_sources")


def test_language(spark, sf_dir, documents):
    got = run(spark, sf_dir, "op12_language_id")
    learned = {r["lang"] for r in documents if r["lang"] is not None and fold(r["doc_id"], 4) != 2}
    for row, r in zip(got, documents, strict=True):
        assert (row.doc_id, row.held_out) == (r["doc_id"], fold(r["doc_id"], 4) == 2)
        assert 0 <= row.score <= 1
        letter = re.search(r"[^\W\d_]", r["text"] or "")
        assert row.lang_pred in learned if letter else row.lang_pred == "und"


def test_secrets(spark, sf_dir, documents):
    text = {r["doc_id"]: r["text"] or "" for r in documents}
    got = run(spark, sf_dir, "op7_secret_scan")
    assert got and all(r.value in text[r.doc_id] for r in got)
    assert all(0 <= r.probability <= 1 and r.is_secret == (r.probability >= 0.5) for r in got)
    # No text of this table has a key-like name.
    assert not any(re.search("(?i)key|token|passw|secret|bearer", t) for t in text.values())
    assert not any(r.is_secret for r in got)
