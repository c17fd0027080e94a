"""Words, windows and sketches against plain Python."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from medvoice.llm import arrays, sketch
from tests.llm import brute

TEXT = st.text(alphabet="aB0 \t\n\x0b.é漢-", max_size=60)


def spelled(found, texts):
    return [texts[d][a:b] for d, a, b in zip(found.doc, found.start, found.end)]


@settings(max_examples=60, deadline=None)
@given(st.lists(TEXT, max_size=6))
def test_words(texts):
    data = [t.encode() for t in texts]
    found = arrays.words(data)
    assert spelled(found, data) == [w for t in data for w in brute.VISIBLE.findall(t)]
    lower = [t.translate(brute.LOWER) for t in data]
    found = arrays.words(data, arrays.ALNUM, lower=True)
    words = spelled(found, lower)
    assert words == [w for t in lower for w in brute.ALNUM.findall(t)]
    # One hash for one word.
    assert len(set(words)) == len(set(found.hash.tolist())) == len(set(zip(words, found.hash.tolist())))


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet="ab ", max_size=300), min_size=1, max_size=4))
def test_words_of_long_texts_in_pieces(texts):
    data = [t.encode() for t in texts]
    piece = arrays.PIECE
    arrays.PIECE = 20
    try:
        found = arrays.words(data)
    finally:
        arrays.PIECE = piece
    assert spelled(found, data) == [w for t in data for w in re.findall(rb"\S+", t)]
    whole = arrays.words(data)
    assert (found.hash == whole.hash).all() and (found.start == whole.start).all()


def test_windows_and_anchors():
    texts = [b"a b c d e f a b c d", b"x", b"", b"c d e f a"]
    found = arrays.words(texts)
    offsets = found.of_doc(len(texts))
    start, hashed = arrays.windows(found.hash, offsets, 3)
    words = spelled(found, texts)
    runs = [tuple(words[s : s + 3]) for s in start]
    assert len(runs) == 8 + 3
    assert len(set(runs)) == len(set(hashed.tolist()))
    counts = np.maximum(np.diff(offsets) - 1, 0)
    _, pairs = arrays.windows(found.hash, offsets, 2)
    chosen = arrays.anchors(pairs, np.concatenate(([0], np.cumsum(counts))), 3)
    for g, at in enumerate(chosen):
        last = np.searchsorted(np.cumsum(counts), g, side="right")
        assert g <= at <= min(g + 2, np.cumsum(counts)[last] - 1)


def test_packed_numbers():
    for numbers in ([], [0], [254], [255], [0, 1, 255, 256, 511, 1021, 5000]):
        assert sketch.unpack(sketch.pack(np.array(numbers, dtype=np.int64))).tolist() == numbers


def test_sketch_misses_no_repeat(spark):
    import pyarrow as pa

    values = [i % 700 for i in range(1000)]
    table = spark.createDataFrame([(v,) for v in values], "v long").repartition(7)

    def hashes(batches):
        for batch in batches:
            yield arrays.mix(batch.column(0).to_numpy(zero_copy_only=False).astype(np.uint64))

    for shared in (False, True):
        built = sketch.build(table, hashes, 20, 3, shared)
        every = arrays.mix(np.arange(1000, dtype=np.uint64))
        said = built.repeated(every)
        assert said[:300].all() and said[300:].sum() < 20
        import pickle

        assert (pickle.loads(pickle.dumps(built)).repeated(every) == said).all()
    assert isinstance(table.limit(1).toArrow(), pa.Table)


def unlike_words():
    """Two words of 1,024 letters that polynomials modulo 2**64 cannot tell apart."""
    a = "".join("ab"[bin(i).count("1") & 1] for i in range(1024))
    return a, a.translate(str.maketrans("ab", "ba"))


def test_long_words_are_told_apart():
    import numpy as np

    from medvoice.llm import arrays

    a, b = (w.encode() for w in unlike_words())
    plain = [np.frombuffer(w, dtype=np.uint8).astype(np.uint64) + np.uint64(1) for w in (a, b)]
    ends = np.array([0]), np.array([1024])
    assert arrays.rolling(plain[0], arrays.BYTE_BASES[0], *ends) == arrays.rolling(plain[1], arrays.BYTE_BASES[0], *ends)
    found = arrays.words([a + b" x", b"x " + b, a + a, a], bases=arrays.BYTE_BASES)
    for hashes in (found.hash, found.other):
        assert hashes[0] == hashes[5] != hashes[3] and hashes[1] == hashes[2] and len(set(hashes.tolist())) == 4


def test_queries_with_long_words(spark, tmp_path):
    """The registered queries over texts that differ in such words only."""
    from medvoice.llm.queries import QUERIES

    a, b = unlike_words()
    tail = " ".join(f"w{i}" for i in range(34))
    docs = [(1, f"{a} {tail}"), (2, f"{b} {tail}"), (3, a), (4, b), (5, "else " * 20), (6, f"{b} {tail}")]
    folder = str(tmp_path)
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{folder}/documents.parquet")
    items = [("i", a), ("j", "q " * 13)]
    spark.createDataFrame(items, "item_id string, text string").write.parquet(f"{folder}/benchmark.parquet")

    def rows(name):
        return {r.doc_id: r for r in QUERIES[name](spark, folder).collect()}

    windows = rows("op9_substring_dedup")
    assert {k: r.n_removed for k, r in windows.items()} == {1: 0, 2: 35, 3: 0, 4: 0, 5: 0, 6: 35}
    classes = rows("op10_minhash_near_dedup")
    assert classes[3].class_id == 3 and classes[4].class_id == 4 and classes[6].class_id == classes[2].class_id
    hits = rows("op5_benchmark_decontamination")
    assert {k: r.n_hit for k, r in hits.items()} == {1: 1, 2: 0, 3: 1, 4: 0, 5: 0, 6: 0}
    import zlib

    train = [(i, t) for i, t in docs if zlib.crc32(str(i).encode()) % 5 != 1]
    known = {w for _, t in train for w in t.split()}
    scored = rows("op4_lm_scoring")
    for i, t in docs:
        assert scored[i].n_known == sum(w in known for w in t.split()) + 1


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.one_of(st.none(), TEXT), max_size=8), max_size=3), st.integers(1, 80))
def test_slices_hold_all_rows_in_order(batches, most):
    made = [pa.RecordBatch.from_pydict({"n": list(range(len(b))), "text": pa.array(b, pa.string())}) for b in batches]
    # A batch that is itself a part of another one has offsets of its own.
    made = [b.slice(1) if b.num_rows > 2 else b for b in made]
    got = list(arrays.slices(made, "text", most))
    want = [(n, (t or "").encode()) for b in made for n, t in zip(*(c.to_pylist() for c in b.columns))]
    assert [(n, t) for b, texts in got for n, t in zip(b.column("n").to_pylist(), texts, strict=True)] == want
    for _, texts in got:
        assert len(texts) == 1 or sum(map(len, texts)) <= most
