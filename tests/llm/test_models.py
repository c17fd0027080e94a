"""Toxicity, LM scoring, secrets, fingerprints and mixing."""

from __future__ import annotations

import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from medvoice.llm import fingerprints as P
from medvoice.llm import secrets, toxicity
from medvoice.llm.mixing import Mix, by_turns, permutation, targets
from medvoice.llm.suffix_tree import Model, is_held_out
from tests.llm import brute
from tests.llm.data import WORDS, awkward, frame, sentence

ROWS = awkward()


# -- Toxicity ---------------------------------------------------------------------


def toxic_rows():
    rng = random.Random(9)
    docs, labels = [], []
    for i in range(260):
        words = sentence(rng, 40).split()
        bad = i % 4 == 0
        if bad:
            for _ in range(3):
                words[rng.randrange(40)] = rng.choice(["Grumpf", "grumpfen", "blarg"])
        docs.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    return docs, labels


def test_toxicity(spark):
    docs, labels = toxic_rows()
    docs += [(None, None), (900, ""), (901, None), (902, "grumpf\nblarg and calm words"), (902, "calm")]
    table = frame(spark, docs, more=("score", "top"))
    marks = spark.createDataFrame([*labels, (1, None), (None, 1)], "doc_id long, toxic int")
    field = toxicity.fit(table, marks)
    scored = toxicity.score(table, field)
    assert scored.columns == [*table.columns, "expected", "top_", "toxic_spans", "score_", "predicted"]
    rows = scored.collect()
    truth = dict(labels)
    held = [r for r in rows if r.doc_id in truth and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert len(held) > 20 and all(r.predicted == truth[r.doc_id] for r in held)
    by_text = {r.text: r for r in rows}
    cut = by_text["grumpf\nblarg and calm words"]
    assert [cut.text[s.start : s.end] for s in cut.toxic_spans] == ["grumpf", "blarg"]
    assert by_text[None].score_ < 0.5 and by_text[""].score_ == by_text[None].score_
    assert all(0 <= r.score_ <= 1 for r in rows)
    # Held-out labels change nothing.
    other = marks.withColumn("toxic", F.when(toxicity.is_held_out("doc_id"), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = toxicity.fit(table, other)
    assert (again.weights == field.weights).all() and again.curve == field.curve


def test_toxicity_without_labels(spark):
    table = frame(spark, [(1, "a b"), (2, None)])
    field = toxicity.fit(table, spark.createDataFrame([], "doc_id long, toxic int"))
    assert {round(r.score, 3) for r in toxicity.score(table, field).collect()} == {0.25}
    assert toxicity.score(frame(spark, []), field).count() == 0


def test_marginals_by_enumeration():
    rng = np.random.default_rng(1)
    evidence, change = rng.normal(size=9), rng.normal(size=(2, 2))
    first = np.array([0, 5, 6])
    got = toxicity.marginals(evidence, first, change)
    for a, b in ((0, 5), (5, 6), (6, 9)):
        total = np.zeros(b - a)
        norm = 0.0
        for states in itertools.product((0, 1), repeat=b - a):
            weight = sum(evidence[a + i] * s for i, s in enumerate(states))
            weight = math.exp(weight + sum(change[x, y] for x, y in zip(states, states[1:])))
            norm += weight
            total += weight * np.array(states)
        assert np.allclose(got[a:b], total / norm)


# -- LM scoring -------------------------------------------------------------------


def test_lm(spark):
    rng = random.Random(5)
    rows = ROWS + [(i, " ".join(["red blue green gold"] * rng.randrange(3, 9)) + " " + sentence(rng, 9)) for i in range(200, 300)]
    rows = [r for r in rows if rows.count(r) == 1 or r[0] == 80]
    table = frame(spark, rows, more=("row", "score"))
    model = Model(table, ~is_held_out("doc_id"))
    tokens = [[*brute.VISIBLE.findall(brute.utf8(t).translate(brute.LOWER)), None] for _, t in rows]
    held = [i is not None and zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in rows]
    counts = Counter(w for own, h in zip(tokens, held) if not h for w in own)
    n, v = sum(counts.values()), len(counts)
    want = sorted(
        (str(i), len(own), sum(counts[w] > 0 for w in own), n,
         round(sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in own), 6))
        for (i, _), own in zip(rows, tokens)
    )
    found = model.scores().collect()
    got = sorted((str(r.id), r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in found)
    assert got == want
    tree = model.tree
    assert len(tree.contexts) > 1 and len(tree.contexts[1])
    every = np.arange(tree.size)
    for state in range(-1, len(tree.parents)):
        assert (10 ** tree.log10(np.full(tree.size, state), every)).sum() == pytest.approx(1)
    patterned = [r for r in found if r.id and 200 <= r.id < 300 and zlib.crc32(str(r.id).encode()) % 5 == 1]
    assert patterned and all(r.score > r.base_score for r in patterned)


def brute_tree(texts, train):
    """log10 probability of each text by a suffix tree in dictionaries."""
    from medvoice.llm import suffix_tree as S

    tokens = [[w.decode() for w in brute.VISIBLE.findall(brute.utf8(t).translate(brute.LOWER))] + [None] for t in texts]
    counts = Counter(w for own, yes in zip(tokens, train) if yes for w in own)
    n, v = sum(counts.values()), len(counts)
    least = [S.often_enough(n, f, low) for f, low in ((S.SYMBOL, 2), (S.CONTEXT, S.LEAST), (S.JOINT, S.LEAST))]
    named = {w for w, c in counts.items() if c >= least[0] or w is None}
    other = "<other>"
    whole = n + 0.5 * (v + 1)
    root = {w: (counts[w] + 0.5) / whole for w in named}
    other_whole = max(whole - sum(counts[w] + 0.5 for w in named), 0.5)
    root[other] = other_whole / whole
    texts_ = [[w if w in named else other for w in own] for own in tokens]
    follows = {}
    for own, yes in zip(texts_, train):
        for i, w in enumerate(own if yes else []):
            for k in range(1, S.DEPTH + 1):
                if i >= k:
                    follows.setdefault(tuple(own[i - k : i]), Counter())[w] += 1
    tree = {(): root}
    tested = {(w,) for w in root if sum(x.count(w) for x, yes in zip(texts_, train) if yes) >= least[1] and w is not None}

    def prob(context, w):
        while context not in tree:
            context = context[1:]
        if context == ():
            return root[w]
        own, rest = tree[context]
        return own[w] if w in own else rest * prob(context[1:], w)

    for _ in range(S.DEPTH):
        new, found = set(), {}
        for context in tested:
            after = {w: c for w, c in follows.get(context, {}).items() if c >= least[2]}
            total = sum(follows.get(context, {}).values())
            if not after:
                continue
            new |= {context + (w,) for w, c in after.items() if c >= least[1] and w is not None}
            before = {w: prob(context[1:], w) for w in after}
            own = {w: (c + S.SMOOTH * before[w]) / (total + S.SMOOTH) for w, c in after.items()}
            left, was = 1 - min(sum(own.values()), 1 - 1e-12), 1 - min(sum(before.values()), 1 - 1e-12)
            gain = total * (sum(p * math.log(p / before[w]) for w, p in own.items()) + left * math.log(left / was))
            if gain >= S.GAIN:
                found[context] = (own, left / was)
        tree.update(found)
        tested = new
    out = []
    for own, raw in zip(texts_, tokens):
        score = 0.0
        for i, w in enumerate(own):
            score += math.log10(prob(tuple(own[max(0, i - S.DEPTH) : i]), w))
            if w == other:
                score += math.log10((counts[raw[i]] + 0.5) / other_whole)
        out.append(score)
    return out, len(tree) - 1


def lm_rows(n, seed=11):
    rng = random.Random(seed)
    words = [f"w{int(1 / (0.0003 + rng.random()))}" for _ in range(20_000)]
    return [
        (i, " ".join([rng.choice(["red blue", "green gold blue", "so it goes on"])] * rng.randrange(4) + rng.choices(words, k=rng.randrange(60))))
        for i in range(n)
    ]


def test_lm_against_a_tree_in_dictionaries(spark):
    rows = ROWS[:40] + lm_rows(500)
    rows = [(1000 + k, t) for k, (_, t) in enumerate(rows)]
    train = [zlib.crc32(str(i).encode()) % 5 != 1 for i, _ in rows]
    want, kept = brute_tree([t for _, t in rows], train)
    assert kept > 10
    scores = []
    for parts in (1, 7):  # the layout changes nothing
        model = Model(frame(spark, rows, parts=parts), ~is_held_out("doc_id"))
        assert len(model.tree.parents) == kept
        scores.append({r.id: r.score for r in model.scores().collect()})
        for (i, _), w in zip(rows, want):
            assert scores[-1][i] == pytest.approx(w, abs=1e-6)


def test_lm_grows_with_the_input(spark):
    sizes = []
    for n in (300, 1500, 6000):
        tree = Model(frame(spark, lm_rows(n)), ~is_held_out("doc_id")).tree
        sizes.append((len(tree.words), len(tree.parents), len(tree.entries)))
    assert all(a < b for one, two in zip(sizes, sizes[1:]) for a, b in zip(one, two)), sizes


def test_lm_of_nothing(spark):
    assert Model(frame(spark, []), ~is_held_out("doc_id")).scores().count() == 0
    found = Model(frame(spark, [(1, None), (2, "")]), ~is_held_out("doc_id")).scores().collect()
    assert [(r.n_tokens, r.n_known, r.train_tokens) for r in found] == [(1, 1, 2)] * 2


def test_lm_reads_the_texts_three_times(spark):
    """For their sizes, for the words that may be symbols, and to write them as symbols."""
    rows, read = lm_rows(400), spark.sparkContext.accumulator(0)

    def seen(text):
        read.add(1)
        return text

    noted = F.udf(seen).asNondeterministic()
    docs = frame(spark, rows).withColumn("text", noted("text"))
    assert Model(docs, ~is_held_out("doc_id")).scores().count() == len(rows)
    assert read.value <= 3 * len(rows)


def test_lm_words_named_by_mistake_are_other_words(spark):
    # Frequent in one part each, and not often enough in all: named, then counted among the rest.
    rows = [(i, " ".join([f"only{i}"] * 5 + ["common"] * 30 + [f"w{i % 7}"])) for i in range(400)]
    least = Model(frame(spark, rows, parts=40), ~is_held_out("doc_id"), symbol=0.5)
    assert len(least.tree.words) < len(least.coded.words)
    got = {r.id: r.score for r in least.scores().collect()}
    one = {r.id: r.score for r in Model(frame(spark, rows, parts=1), ~is_held_out("doc_id"), symbol=0.5).scores().collect()}
    assert got == pytest.approx(one, abs=1e-9)


# -- Secrets ----------------------------------------------------------------------


def test_secrets(spark):
    rng = random.Random(8)
    rows = []
    for i in range(150):
        key = "".join(rng.choice("0123456789abcdef") for _ in range(40))
        number = "".join(rng.choice("0123456789") for _ in range(16))
        words = sentence(rng, 12)
        rows.append((i, f'{words} token = "{key}" {words}' if i % 2 else f"{words} {number} {words} a{i}.b@mail.example.com"))
    rows += [(None, None), (500, ""), (501, 'key: "0123456789abcdef0123456789abcdef" 1234567890123456'), (501, "same id")]
    table = frame(spark, rows, more=("value", "at"))

    def labelled(found):
        secret = (F.col("key_word") == 1) & (F.col("assigned") == 1)
        return found.withColumn("label", F.when(secret, 1.0).otherwise(0.0)).where("id < 100")

    found = secrets.fit(table, labelled).scan(table).collect()
    text = dict(r for r in rows if r[0] != 501)
    text[501] = rows[-2][1]
    pattern = __import__("re").compile(r"[A-Za-z0-9+/=_@:%~\-.]{16,}")
    want = sorted((i, m.start(), m.group()) for i, t in text.items() for m in pattern.finditer(t or "") if any(c.isdigit() for c in m.group()))
    assert sorted((r.id, r.at, r.value) for r in found) == want
    held = [r for r in found if r.id >= 100]
    assert all((r.probability >= 0.5) == (len(r.value) in (32, 40)) for r in held)


def test_secret_candidates(spark):
    rows = [
        (1, "set API_KEY=abcdefghijklmnopqrst now"), (2, "password:hunter2x"), (3, 'my password = "tr0ub4dor" ok'),
        (4, "see https://www.example.org/a/long/page and identifier=ab12"), (5, "the long word counterrevolutionary ends"),
        (6, 'colour = "lightblue1"'), (7, "x token: correcthorse"), (8, "url=https://example.org/page1"),
    ]
    found = secrets.candidates(frame(spark, rows)).collect()
    assert all(dict(rows)[r.id][r.at :].startswith(r.value) for r in found)
    assert sorted((r.id, r.value) for r in found) == [
        (1, "abcdefghijklmnopqrst"), (2, "hunter2x"), (3, "tr0ub4dor"), (4, "https://www.example.org/a/long/page"),
        (5, "counterrevolutionary"), (7, "correcthorse"), (8, "https://example.org/page1"),
    ]
    marks = {r.id: (r.key_word, r.assigned) for r in secrets.described(secrets.candidates(frame(spark, rows)), []).collect()}
    assert all(marks[i] == (1, 1) for i in (1, 2, 3, 7))


def test_secret_forms(spark):
    rows = [
        (1, "password = P@ssw0rd!23x", "P@ssw0rd!23x"), (2, "DB_PASSWORD='x9$kL2#mQ7'", "x9$kL2#mQ7"),
        (3, "password = s3cr3t#tail99", "s3cr3t#tail99"), (4, "Authorization: Bearer abcd1234efgh", "abcd1234efgh"),
        (5, "passwort = geheim12345", "geheim12345"), (6, 'das "Kennwort": "süß&gut77"', "süß&gut77"),
        (7, "la contraseña: lobo#verde9, y más", "lobo#verde9"), (8, "le jeton:  a1b2c3d4e5", "a1b2c3d4e5"),
        (9, "send Bearer zz11yy22xx33.", "zz11yy22xx33"), (10, "a\u0001b token=abcd\u0001efgh\u0001 x", "abcd\u0002efgh\u0002"),
        (11, "keyboard = something", None), (12, "the password was long", None), (13, "at 12:30:45:59:10 sharp", None),
    ]
    found = secrets.candidates(spark.createDataFrame(rows, "doc_id long, text string, want string")).collect()
    assert sorted((r.id, r.value) for r in found) == [(i, v) for i, _, v in rows if v]
    assert all(rows[r.id - 1][1][r.at :].replace("\u0001", "\u0002").startswith(r.value) for r in found)
    marks = secrets.described(secrets.candidates(spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")), []).collect()
    assert all((r.key_word, r.assigned) == (1, 1) for r in marks)


def test_very_many_candidates_in_a_text(spark):
    import time

    text = " ".join(f"x{i:020d}" for i in range(200_000))
    begun = time.time()
    row = secrets.candidates(frame(spark, [(1, text)])).agg(F.count("*"), F.max("at"), F.min("at")).first()
    assert tuple(row) == (200_000, 199_999 * 22, 0) and time.time() - begun < 10


def test_planted_secrets(spark):
    """Recall and precision on held-out documents with secrets of several forms."""
    rng = random.Random(21)
    kinds = ['token = "{}"', "api_key={}", "my password: {}", "Authorization: Bearer {}", "passwort = {}"]
    rows, truth = [], {}
    for i in range(400):
        words, more = sentence(rng, 15), sentence(rng, 15)
        if i % 2:
            size = rng.choice([12, 20, 32])
            truth[i] = "".join(rng.choice("abcdefghijkmnpqrstuvwxyzABCDEFGHJKLMNP23456789") for _ in range(size))
            words += " " + rng.choice(kinds).format(truth[i])
        else:
            words += rng.choice([" https://www.example.org/a/long/page", " 1234567890123456", " counterrevolutionary", " key: important"])
        rows.append((i, f"{words} {more}"))
    table = frame(spark, rows)

    def labelled(found):
        yes = F.col("id") % 2 == 1
        known = F.col("value").isin(*truth.values())
        return found.where("id < 200").withColumn("label", F.when(yes & known, 1.0).otherwise(0.0))

    found = [r for r in secrets.fit(table, labelled).scan(table).collect() if r.id >= 200 and r.probability >= 0.5]
    want = {(i, v) for i, v in truth.items() if i >= 200}
    got = {(r.id, r.value) for r in found}
    assert len(got & want) >= 0.95 * len(want) and len(got - want) <= 0.05 * len(want)


def test_secrets_without_labels(spark):
    table = frame(spark, [(1, "x 1234567890123456789 y"), (2, None)])
    model = secrets.fit(table, lambda found: found.withColumn("label", F.lit(1.0)).where("false"))
    assert [(r.id, r.at, r.probability) for r in model.scan(table).collect()] == [(1, 2, 0.5)]
    assert secrets.fit(frame(spark, []), lambda f: f.withColumn("label", F.lit(1.0))).scan(frame(spark, [])).count() == 0


# -- Fingerprints -----------------------------------------------------------------


def test_fingerprints(spark):
    rows = ROWS + [(i, sentence(random.Random(i), 400)) for i in range(300, 330)]
    table = frame(spark, rows, more=("own", "next_")).withColumn("text", F.coalesce("text", F.lit(""))).withColumn(
        "mark", F.xxhash64("text")
    )
    found = P.with_next(table, "doc_id", "mark", {"own": P.fingerprint(F.col("text"), fraction=1)}, ["text", "own"])
    out = found.withColumn("edited", P.edited(F.col("text"), F.col("next.text"))).withColumn(
        "other", P.fingerprint(F.col("edited"), fraction=1)
    )
    got = out.select(
        "doc_id", "text", "mark", F.col("next.text").alias("following"), "edited",
        P.similar(F.col("own"), F.col("other")).alias("near"),
        P.containment(F.col("own.kept"), F.col("other.kept")).alias("inside"), P.as_string(F.col("own")).alias("name"),
    ).collect()
    assert len(got) == len(rows)
    order = sorted(got, key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.mark), reverse=True)
    for r, after in zip(order, [*order[1:], order[0]]):
        half = len(r.text) // 2
        assert r.following == after.text
        assert r.edited == r.text[: len(r.text) - half] + after.text[:half]
        # With everything kept, likeness is exact.
        a, b = (
            frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()
            for w in (brute.VISIBLE.findall(t.encode()) for t in (r.text, r.edited))
        )
        assert r.near == pytest.approx(1.0 if a == b else len(a & b) / len(a | b))
        assert r.inside == pytest.approx(len(a & b) / len(a) if a else 0)
    names = {}
    for r in got:
        assert names.setdefault(r.text, r.name) == r.name


def test_sketches_merge(spark):
    a, b = sentence(random.Random(1), 300), sentence(random.Random(2), 300)
    table = spark.createDataFrame([(a, b)], "a string, b string")
    kept = lambda c: P.sketch(P.run_hashes(F.col(c)), 4)
    row = table.select(P.merge(kept("a"), kept("b")), kept("a"), kept("b"), F.size(P.run_hashes(F.col("a")))).first()
    assert row[0] == sorted({*row[1], *row[2]})
    assert row[3] / 8 < len(row[1]) < row[3] / 2
    assert P.with_next(frame(spark, []).withColumn("m", F.lit(1)), "doc_id", "m", {}, ["text"]).count() == 0


# -- Mixing -----------------------------------------------------------------------


def level(sizes: list[int], weights: list[float], limit: float = 3) -> list[float]:
    """Share by weight, cut at the limit, share the rest, until none is above."""
    full: set[int] = set()
    while True:
        left = sum(sizes) - sum(limit * sizes[i] for i in full)
        weight = sum(w for i, w in enumerate(weights) if i not in full)
        out = [limit * s if i in full else left * weights[i] / weight for i, s in enumerate(sizes)]
        over = {i for i, t in enumerate(out) if i not in full and t >= limit * sizes[i]}
        if not over:
            return out
        full |= over


def test_targets(spark):
    rng = random.Random(3)
    for _ in range(4):
        sizes = [rng.choice([0, 1, 5, 40, 3000]) for _ in range(9)]
        names = [*"abcdefgh", None]
        table = spark.createDataFrame(list(zip(names, sizes)), "source string, source_size long").repartition(3)
        got = {r.source: r.target for r in targets(table, by_turns(1, 2, 3)).collect()}
        if sum(sizes):
            assert [got[n] for n in names] == pytest.approx(level(sizes, [1, 2, 3] * 3))


def test_permutation():
    for n in (1, 2, 3, 5, 64, 100, 1000):
        for key in (1, 2):
            assert sorted(permutation(np.arange(n), n, key).tolist()) == list(range(n))
    assert permutation(np.arange(1000), 1000, 1).tolist() != permutation(np.arange(1000), 1000, 2).tolist()


def test_mix(spark):
    sources = ["b", "a", None, "c", "d"]
    rows = [(i, t, sources[n % 5] if n % 9 else "a") for n, (i, t) in enumerate(ROWS)]
    rows += [(400, "tiny", "e"), (401, None, "f")]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    mixed = Mix(table, block=8)
    found = mixed.taken().collect()
    assert len(found) == len(rows)
    size = {s: 0 for s in {r[2] for r in rows}}
    for _, t, s in rows:
        size[s] += len(brute.VISIBLE.findall(brute.utf8(t)))
    names = sorted((s for s in size if s is not None)) + [None]
    want = dict(zip(names, level([size[s] for s in names], [[1, 2, 3][i % 3] for i in range(len(names))])))
    taken = Counter()
    for r in found:
        assert r.taken <= 3 * r.size and r.source_size == size[r.source]
        assert r.target == pytest.approx(want[r.source])
        taken[r.source] += r.taken
    assert all(abs(taken[s] - want[s]) <= 8 for s in names)
    # No block is taken again before all have been taken.
    blocks = {r.number: r.blocks for r in mixed.sources.collect()}
    times = Counter((r.number, r.block) for r in mixed.slots.collect())
    for number, n in blocks.items():
        own = [times[number, b] for b in range(n)]
        assert not own or max(own) - min(own) <= 1
    again = Mix(table.repartition(5), block=8).taken().collect()
    assert sorted(map(tuple, again), key=str) == sorted(map(tuple, found), key=str)
    assert Mix(table.limit(0)).taken().count() == 0


assert WORDS
