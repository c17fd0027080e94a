"""Line, window, string and near dedup, and decontamination, against plain loops."""

from __future__ import annotations

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from medvoice.llm import suffix_dedup
from medvoice.llm.decontaminate import find_benchmark, is_contaminated, merge
from medvoice.llm.line_dedup import drop_repeated_lines
from medvoice.llm.near_dedup import NearDuplicates, drop_near_duplicates, jaccard, signatures
from medvoice.llm.suffix_dedup import drop_repeated_strings, earliest, masks_of, suffix_order
from medvoice.llm.window_dedup import drop_repeated_windows
from tests.llm import brute
from tests.llm.data import awkward, frame

ROWS = awkward()
BITS = 20


def tidy(rows) -> list:
    return sorted((tuple(r) for r in rows), key=str)


def text_sha(column: str = "text"):
    return F.sha2(F.coalesce(column, F.lit("")), 256)


def test_lines(spark):
    docs = frame(spark, ROWS, more=("n_lines", "first", "lines"))
    got = drop_repeated_lines(docs, bits=BITS)
    assert got.columns == [*docs.columns, "n_lines_", "n_dropped"]
    rows = got.select("doc_id", "n_lines_", "n_dropped", text_sha()).collect()
    assert tidy(rows) == tidy(brute.lines(ROWS))
    assert got.where("n_lines <> 'n_lines!' OR lines <> 'lines!'").count() == 0
    assert got.where("doc_id = 5 AND text IS NULL").count() == 1


def test_windows(spark):
    docs = frame(spark, ROWS, more=("n_words", "starts"))
    got = drop_repeated_windows(docs, bits=BITS)
    rows = got.select("doc_id", "n_words_", "n_removed", text_sha()).collect()
    # A null text stays null; for the rest white space is one space.
    assert tidy(rows) == tidy(brute.windows(ROWS, 35))


@pytest.mark.parametrize("width", [2, 11])
def test_narrow_windows(spark, width):
    rows = ROWS[:40]
    got = drop_repeated_windows(frame(spark, rows), width=width, bits=BITS)
    assert tidy(got.select("doc_id", "n_words", "n_removed", text_sha()).collect()) == tidy(brute.windows(rows, width))


def strings_of(df) -> list:
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return tidy(df.select("doc_id", "n_bytes", removed, F.size("spans"), F.sha2("kept", 256)).collect())


def test_strings(spark):
    docs = frame(spark, ROWS, more=("key", "hash"))
    got = drop_repeated_strings(docs, bits=BITS)
    assert strings_of(got) == tidy(brute.strings(ROWS, 50))


def test_strings_of_frequent_keys_and_long_texts(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PIECE", 700)
    got = drop_repeated_strings(frame(spark, ROWS), bits=BITS, many=2)
    assert strings_of(got) == tidy(brute.strings(ROWS, 50))


def test_strings_that_do_not_repeat_are_not_stored(spark, monkeypatch):
    import random

    # Far more keys than there are counters in 2**20, of which three hundred occur twice.
    rng = random.Random(8)
    texts = [rng.randbytes(3000).hex() for _ in range(3000)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(9000 + i, t[:200]) for i, t in enumerate(texts[:300])]
    tables = {}

    def kept(df, name, *more):
        tables[name] = df.persist()
        return tables[name]

    monkeypatch.setattr(suffix_dedup, "stored", kept)
    monkeypatch.setattr(suffix_dedup, "forget", lambda table: None, raising=False)
    starts = suffix_dedup.repeated_strings(frame(spark, rows), bits=BITS)
    assert starts.count() >= 300
    # About one in sixty of the other 1.1 million keys is reported too, as a block of 65 bytes.
    assert tables["blocks"].agg(F.sum(F.octet_length("block"))).first()[0] < 0.12 * 18_000_000


def test_strings_by_a_filter_in_parts(spark, monkeypatch):
    from medvoice.llm import repeats

    made = []
    monkeypatch.setattr(suffix_dedup, "build", lambda *a: made.append(repeats.build(*a)) or made[-1])
    got = drop_repeated_strings(frame(spark, ROWS), bits=10, many=2)
    assert strings_of(got) == tidy(brute.strings(ROWS, 50))
    assert len(made[0].parts) > 1


def test_strings_leave_little_in_the_shared_folder(spark, tmp_path, monkeypatch):
    import itertools
    import os

    from medvoice.llm import frames

    numbers = itertools.count()
    monkeypatch.setattr(frames, "new_folder", lambda spark, name: f"{tmp_path}/{name}-{next(numbers)}")
    got = drop_repeated_strings(frame(spark, ROWS), bits=BITS, many=2)
    assert strings_of(got) == tidy(brute.strings(ROWS, 50))
    assert {n.rsplit("-", 1)[0] for n in os.listdir(tmp_path)} == {"repeated", "known"}


def test_repeated_hashes(spark):
    import numpy as np

    from medvoice.llm import repeats

    rng = np.random.default_rng(6)
    once = rng.integers(0, 1 << 63, 300_000, dtype=np.uint64) << np.uint64(1)
    twice = rng.integers(0, 1 << 63, 2_000, dtype=np.uint64) << np.uint64(1) | np.uint64(1)
    every = rng.permutation(np.concatenate((once, twice, twice, np.repeat(twice[:3], 50))))
    docs = spark.createDataFrame([(p,) for p in range(8)], "p long").repartition(8)

    def some(batches):
        for batch in batches:
            for p in batch.column(0).to_pylist():
                for part in np.array_split(every[p::8], 3):
                    yield part

    for most, parts in ((1 << 20, 1), (1500, 2)):
        found = repeats.build(docs, some, most, 40)
        assert len(found.parts) >= parts and (len(found.parts) == 1) == (parts == 1)
        assert found(twice).all() and found(once).mean() < 0.03
        assert {r["told"] for r in found.often.collect()} == set((twice[:3] >> np.uint64(64 - repeats.TOLD)).tolist())
        groups = list(found.together(range(5), lambda n: 400_000))
        assert groups == ([[n] for n in range(5)] if parts == 1 else [[0, 1, 2], [3, 4]])
    none = repeats.build(docs, lambda batches: iter(()), 1 << 20)
    assert not none(once).any() and none.often is None


def test_bytes_by_place():
    import numpy as np

    from medvoice.llm.repeats import from_planes, planes

    for values in ([0], [0, 0, 0], [1, 255, 0], [256, 3], [(1 << 44) - 1, 0, 70_000], [(1 << 64) - 1]):
        array = np.array(values, dtype=np.uint64)
        assert from_planes(planes(array), len(array)).tolist() == values
    assert len(planes(np.array([7, 300], dtype=np.uint64))) == 4


def test_suffix_order():
    import random

    import numpy as np

    rng = random.Random(4)
    for n in (1, 2, 3, 4, 5, 6, 7, 8, 40, 257):
        for k in (1, 2, 5, 250):
            s = np.array([rng.randrange(k) + 1 for _ in range(n)])
            assert list(suffix_order(s)) == sorted(range(n), key=lambda i: list(s[i:]))
    ids = np.array([7, 3, 9])
    texts = [b"abcabcabcabc", b"xbcabcabcabx", b"bcabcabcab"]
    least, first = earliest(pa.array(texts, pa.binary()), ids, 9)
    assert least.tolist() == [
        min(i for t, i in zip(texts, ids) for q in range(len(t) - 8) if t[q : q + 9] == s[p : p + 9])
        for s in texts
        for p in range(len(s) - 8)
    ]
    assert first.tolist() == [0, 4, 8]


def test_masks_of_contexts():
    import random

    import numpy as np

    rng = random.Random(9)
    contexts = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(9, 16))) for _ in range(60)] * 2
    key = np.array([rng.randrange(20) for _ in contexts[:60]] * 2)
    first = np.array([rng.randrange(9) for _ in contexts])
    order = np.argsort(key, kind="stable")
    contexts, key, first = [contexts[k] for k in order], key[order], first[order]
    many, mask = masks_of(key, first, pa.array(contexts, pa.binary()), 9)
    # Equal strings have equal keys in real contexts; here only those that share one count.
    for k, c in enumerate(contexts):
        assert many[k] == len(c) - 8
        for p in range(len(c) - 8):
            own = [f for q, f, g in zip(contexts, first, key) if c[p : p + 9] in q and (g == key[k])]
            got = bool(mask[k] >> p & 1)
            every = [f for q, f in zip(contexts, first) if c[p : p + 9] in q]
            assert got >= (min(own) < first[k]) and got <= (min(every) < first[k])


def test_near_classes(spark):
    docs = frame(spark, ROWS, more=("name", "class_id"))
    found = NearDuplicates(docs, bits=BITS).documents().collect()
    got = sorted((brute.order(r["id"]), brute.order(r["class_id"])) for r in found)
    want = sorted((brute.order(i), c) for (i, _), c in zip(ROWS, brute.classes(ROWS)))
    assert got == want


def test_near_kept(spark):
    docs = frame(spark, ROWS, more=("name", "alone"))
    kept = drop_near_duplicates(docs, bits=BITS)
    assert kept.columns == docs.columns
    rows = kept.collect()
    names = brute.classes(ROWS)
    with_words = [n for (i, t), n in zip(ROWS, names) if brute.shingles(t)]
    without = [i for i, t in ROWS if not brute.shingles(t)]
    assert len(rows) == len(set(with_words)) + len(without)


@pytest.mark.parametrize("piece", [1 << 20, 20_000])
def test_near_copies_among_many_unlike_ones(spark, monkeypatch, piece):
    """Hundreds of texts of one template, at 0.66 to each other; to each tenth there is a near copy."""
    import random

    from medvoice.llm import near_dedup

    monkeypatch.setattr(near_dedup, "PIECE", piece)
    base = [f"w{n}" for n in range(200)]
    rows = []
    for i in range(300):
        words = list(base)
        for at in random.Random(i).sample(range(5, 195, 10), 4):
            words[at] = f"own{i}x{at}"
        rows.append((i, " ".join(words)))
        if i % 10 == 0:
            rows.append((1000 + i, " ".join([*words[:-1], "end"])))
    found = NearDuplicates(frame(spark, rows), bands=8, rows=1, bits=BITS)
    got = sorted((r["id"], r["class_id"]) for r in found.documents().collect())
    assert got == sorted(zip((i for i, _ in rows), brute.classes(rows)))
    assert sum(i != c for i, c in got) >= 30


def test_signatures_estimate_similarity():
    import numpy as np

    rng = np.random.default_rng(2)
    a = np.unique(rng.integers(0, 1 << 62, 900).astype(np.uint64))
    b = np.unique(np.concatenate((a[:800], rng.integers(0, 1 << 62, 100).astype(np.uint64))))
    one, two = signatures([a, b], 3000)
    assert abs((one == two).mean() - jaccard(a, b)) < 0.04
    # Weighted: shared weight over all weight.
    weights = [np.full(len(a), 3), np.where(np.isin(b, a), 1, 2)]
    one, two = signatures([a, b], 3000, weights)
    shared = np.isin(b, a).sum()
    assert abs((one == two).mean() - shared / (3 * len(a) + 2 * (len(b) - shared))) < 0.04
    assert (signatures([a[:0], a[:1]], 64)[0] == 0).all()
    assert len(set(signatures([a[:1]], 64)[0].tolist())) == 64


ITEMS = [(1, "the of and bird river stone cloud token glass window paper light the of"), (2, None), (30, ""), (4, "Paper-light 42"), (4, "x")]


def test_decontamination(spark):
    rows = ROWS + [(90, "START The of, and BIRD river stone; cloud token glass window paper light the of stop " + "word " * 20)]
    docs = frame(spark, rows, more=("spans", "items"))
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = find_benchmark(docs, items)
    n_words, spans, names, n_hit = found.columns[-4:]
    got = found.select(
        "doc_id", n_words, n_hit, F.size(names), F.sha2(F.array_join(names, ","), 256), is_contaminated(n_hit, n_words)
    ).collect()
    assert tidy(got) == tidy(brute.contamination(rows, ITEMS))


def test_decontamination_in_blocks(spark, monkeypatch):
    from medvoice.llm import decontaminate

    monkeypatch.setattr(decontaminate, "BLOCK", 60)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = find_benchmark(frame(spark, ROWS), items)
    got = found.select("doc_id", "n_words", "n_hit", F.size("items"), F.sha2(F.array_join("items", ","), 256), is_contaminated())
    assert tidy(got.collect()) == tidy(brute.contamination(ROWS, ITEMS))
    assert merge([(5, 9), (1, 3), (3, 4), (6, 7)]) == [(1, 4), (5, 9)]


def test_decontamination_by_items_without_id(spark, tmp_path):
    import duckdb

    from medvoice.llm.queries import ORACLES, QUERIES

    docs = [(1, "so " + ITEMS[0][1] + " end"), (2, "say paper light 42 now"), (3, "nothing here"), (4, ITEMS[0][1] + " x paper light 42")]
    items = [(None, ITEMS[0][1]), (7, "paper light 42")]
    frame(spark, docs).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    name = "op5_benchmark_decontamination"
    got = QUERIES[name](spark, str(tmp_path))
    db = duckdb.connect()
    for table in ("documents", "benchmark"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{tmp_path}/{table}.parquet/*.parquet'")
    want = db.execute(f"SELECT {', '.join(got.columns)} FROM ({ORACLES[name]})").fetchall()
    assert tidy(got.collect()) == tidy(want)
    assert {r["doc_id"]: r["n_items"] for r in got.collect()} == {1: 1, 2: 1, 3: 0, 4: 2}


@pytest.mark.parametrize("rows", [[], [(1, None)]])
def test_nothing_to_do(spark, rows):
    docs = frame(spark, rows)
    items = spark.createDataFrame([], "item_id long, text string")
    assert drop_repeated_lines(docs, bits=BITS).count() == len(rows)
    assert drop_repeated_windows(docs, bits=BITS).count() == len(rows)
    assert drop_repeated_strings(docs, bits=BITS).count() == len(rows)
    assert NearDuplicates(docs, bits=BITS).documents().count() == len(rows)
    assert find_benchmark(docs, items).count() == len(rows)
