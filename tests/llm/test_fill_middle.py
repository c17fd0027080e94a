"""Fill-in-middle: exact cuts, the learned index, round trips."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from medvoice.llm import fill_middle as M
from medvoice.llm.queries import QUERIES
from tests.llm.data import awkward, frame, sentence


def plain(doc_id, text):
    """The contract by a list of tokens."""
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text, re.S)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def rows():
    rng = random.Random(8)
    docs = awkward()
    docs += [(100 + i, rng.choice(["", "<", "<P", "P>", "\n"]) + sentence(rng, rng.randrange(1, 400))) for i in range(150)]
    docs += [(i, "<<P<S<M>" [: i - 300] + " text <P") for i in range(301, 308)]
    docs += [(400, "a <P> b"), (401, "<M>"), (402, "<s> stays <p>"), (403, "ab " * 700_000), (404, "x" * 900_000)]
    docs += [(405, "#" * 50_000 + "word" * 60_000 + "!" * 50_000), (406, "\U0001f600" * 3000 + "tail"), (407, "é1  ")]
    return docs


def test_against_tokens(spark):
    docs = rows()
    table = frame(spark, docs, more=("form", "OUTPUT"))
    made = M.fill_in_middle(table)
    assert made.columns == [*table.columns, "n", "form_", "prefix_chars", "middle_chars", "output_"]
    back = M.with_restored(made, "output_", "form_")
    got = sorted(((r.doc_id, r.text, r.n, r.form_, r.prefix_chars, r.middle_chars, r.output_) for r in back.collect()), key=repr)
    assert got == sorted(((i, t, *plain(i, t)) for i, t in docs), key=repr)
    assert all(r.restored == (r.text or "") for r in back.collect())
    assert {r.form_ for r in back.collect()} == {"plain", "psm", "spm"}


def test_nothing(spark):
    assert M.with_restored(M.fill_in_middle(frame(spark, []))).count() == 0


def test_index():
    rng = np.random.default_rng(2)
    for steps in (
        np.ones(5000, int), rng.integers(1, 9, 20_000), rng.integers(1, 4000, 3000), np.array([], int), np.array([7]),
        np.concatenate((np.ones(4000, int), [100_000], np.full(4000, 3), rng.geometric(0.01, 5000))),
    ):
        offsets = np.concatenate(([0], np.cumsum(steps))).astype(np.int64)
        for error in (1, 20, M.ERROR):
            index = M.fit(offsets, error)
            ranks = np.arange(len(offsets))
            assert (index.offset(ranks) == offsets).all()
            assert np.abs(offsets - index.predicted(ranks)).max() <= error + 1
            assert index.residual.dtype == np.int8 and index.first[0] == 0 and (np.diff(index.first) > 0).all()
    even = M.fit(np.arange(0, 70_000, 7))
    assert len(even.first) == 1 and not even.residual.any()
    words = np.concatenate(([0], np.cumsum(rng.integers(1, 9, 50_000))))
    assert len(M.fit(words).first) < 200
    with pytest.raises(ValueError):
        M.fit(words, 127)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="aZ<>PSM \né\U0001f600", max_size=40), st.sampled_from(["plain", "psm", "spm"]), st.data())
def test_round_trip(text, form, data):
    if form != "plain" and any(m in text for m in (M.PREFIX, M.SUFFIX, M.MIDDLE)):
        return
    low = data.draw(st.integers(0, len(text)))
    high = data.draw(st.integers(low, len(text)))
    assert M.restored(M.arranged(text, form, low, high), form) == text


def test_query(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]

    def sha(text):
        return hashlib.sha256((text or "").encode()).hexdigest()

    want = sorted((i, *(p := plain(i, t))[:4], sha(p[4]), sha(t)) for i, t in docs)
    assert sorted(map(tuple, QUERIES["op13_fill_in_middle"](spark, sf_dir).collect())) == want
