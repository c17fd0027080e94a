"""Language identification: the kernel by sets, held-out accuracy, awkward rows."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from medvoice.llm import language as L
from medvoice.llm.queries import QUERIES
from tests.llm.data import awkward, frame

SCHEMA = "doc_id long, text string, lang string"
SOUNDS = {"aa": "ka lo mi ne tu ra", "bb": "sch ung eit das ver lich", "cc": "été ois eau que ant ille"}


def spoken(n=240, seed=5):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        lang = rng.choice(sorted(SOUNDS))
        parts = SOUNDS[lang].split()
        words = ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 4))) for _ in range(rng.randrange(3, 60))]
        out.append((i, " ".join(words).capitalize(), lang))
    return out


def held(i):
    return zlib.crc32(str(i).encode()) % 4 == 2


def grams(text, longest=L.LONGEST):
    data = text.lower().encode()
    return {data[a : a + n] for n in range(1, longest + 1) for a in range(len(data) - n + 1)}


def test_kernel_is_that_of_sets():
    """Products of hashed rows against sets of runs; few of them share a place by chance."""
    texts = [t for _, t, _ in spoken(12)] + ["", "x", "ab", "É é É"]
    rows = L.normalized(np.stack([L.runs_of(t) for t in texts]).astype(np.float32))
    sets = [grams(t) for t in texts]
    for a, x in enumerate(sets):
        for b, y in enumerate(sets):
            want = len(x & y) / max(1, len(x) * len(y)) ** 0.5
            assert rows[a] @ rows[b] == pytest.approx(want, abs=0.02)


def test_long_text_in_pieces(monkeypatch):
    text = " ".join(t for _, t, _ in spoken(60))
    whole = L.runs_of(text)
    monkeypatch.setattr(L.arrays, "PIECE", 100)
    assert (L.runs_of(text) == whole).all()


def test_regression_is_the_plain_one():
    """With every text a landmark the Nyström solution is kernel ridge regression itself."""
    rng = np.random.default_rng(3)
    names = np.array(["p", "q", "r"] * 10)
    rows = L.normalized((rng.random((30, 400)) < 0.2).astype(np.float64))
    kernel = rows @ rows.T
    languages, alpha = L.regression(kernel, kernel, names, 0.01)
    goal = np.where(names[:, None] == np.array(languages), 1.0, -1.0)
    want = np.linalg.solve(kernel + 0.01 * 30 * np.eye(30), goal)
    assert languages == ["p", "q", "r"] and np.allclose(kernel @ alpha, kernel @ want, atol=1e-6)


def test_one_product_is_two(spark):
    """Scores by the one matrix equal kernel values times coefficients."""
    docs = spoken(90)
    table = spark.createDataFrame(docs, SCHEMA)
    model = L.fit(table, landmarks=30)
    train = sorted((t, lang) for i, t, lang in docs if not held(i))
    assert model.languages == ["aa", "bb", "cc"] and model.weights.shape == (L.SIZE, 4)
    held_rows = np.stack([L.runs_of(t) for t, _ in train]).astype(np.float32)
    found = model.values(held_rows)
    kernel = L.normalized(held_rows) @ model.weights[:, :-1]
    assert np.allclose(found, kernel, atol=1e-4)
    assert [model.languages[k] for k in found.argmax(axis=1)] == [lang for _, lang in train]


def test_held_out_accuracy(spark):
    docs = spoken()
    table = spark.createDataFrame(docs, SCHEMA).repartition(5)
    model = L.fit(table, sample=150, landmarks=40)
    rows = L.predict(table.drop("lang"), model).collect()
    truth = {i: lang for i, _, lang in docs}
    checked = [r for r in rows if held(r.doc_id)]
    assert len(checked) > 40 and sum(r.lang_pred == truth[r.doc_id] for r in checked) >= 0.97 * len(checked)
    # Held-out labels, sources and the layout change nothing.
    other = [(i, t, "aa" if held(i) else lang) for i, t, lang in docs] + [(i, t, None) for i, t, _ in docs[:9]]
    again = L.fit(spark.createDataFrame(other, SCHEMA).repartition(2), sample=150, landmarks=40)
    assert np.allclose(again.weights, model.weights, atol=1e-5) and again.languages == model.languages


def test_awkward(spark):
    docs = [(1000 + i, t, lang) for i, t, lang in spoken(60)]
    docs += [(i, t, random.Random(i or 0).choice(["aa", None])) for i, t in awkward()]
    docs += [(1, None, "aa"), (3, "12 34 !?", "bb"), (None, "kalo", "aa"), (4, "²³", "cc"), (5, "中文 字", None)]
    table = spark.createDataFrame([(*d, "s", 1.5) for d in docs], SCHEMA + ", LANG_PRED string, score double").repartition(3)
    found = L.predict(table, L.fit(table))
    assert found.columns == [*table.columns, "lang_pred_", "score_"] and found.count() == len(docs)
    for r in found.collect():
        letter = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred_ == L.UNKNOWN) == (not letter)
        assert 0 <= r.score_ <= 1 and (letter or r.score_ == 0)


def test_nothing_to_learn(spark):
    empty = spark.createDataFrame([], SCHEMA)
    model = L.fit(empty)
    assert L.predict(empty, model).count() == 0
    rows = L.predict(frame(spark, [(1, "words"), (2, None)]), model).collect()
    assert {(r.lang_pred, r.score) for r in rows} == {(L.UNKNOWN, 0.0)}
    single = L.fit(spark.createDataFrame([(0, "only one", "zz")], SCHEMA))
    assert [r.lang_pred for r in L.predict(frame(spark, [(1, "words")]), single).collect()] == ["zz"]


def test_query(spark, sf_dir):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = QUERIES["op12_language_id"](spark, sf_dir).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    assert all(r.held_out == held(r.doc_id) for r in rows)
    checked = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == docs[r.doc_id].lang for r in checked) >= 0.95 * len(checked)
