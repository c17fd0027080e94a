import math
import random
import re
from collections import Counter

import pytest

from medvoice.functions.lexicon import LEXICON, STOPWORDS
from medvoice.functions.text import polarity, tokens
from medvoice.operators import classifier, joins, terms
from medvoice.operators import polarity as polarity_operators
from medvoice.operators.terms import cloud_terms, term_frequency, term_frequency_by_sentiment


def score(spark, text, **kwargs):
    df = spark.createDataFrame([(text,)], "review string")
    return df.select(polarity("review", **kwargs)).first()[0]


def test_polarity_contract(spark):
    assert score(spark, "Fantastic") > 0
    assert score(spark, "Worst didn't work") < 0
    assert score(spark, "This drug is the worst!") < 0
    for nothing in ("the table", "", None):
        assert score(spark, nothing) == 0.0
    assert score(spark, "good bad") == 0.0
    assert score(spark, "GOOD good best") == pytest.approx((0.75 + 0.75 + 1.0) / 3)


def test_negation(spark):
    assert score(spark, "not good") == -0.375
    assert score(spark, "it wasn't good") == -0.375
    assert score(spark, "never bad") == 0.375
    assert score(spark, "not good", negators=()) == 0.75
    assert score(spark, "not that good") == 0.75


def test_lexicon_is_bounded_and_in_range():
    assert all(-1 <= p <= 1 and p * 4 == int(p * 4) for p in LEXICON.values())
    assert len(LEXICON) < polarity_operators.MAX_INLINE_WORDS
    assert len(set(STOPWORDS)) == len(STOPWORDS)


TEXTS = [
    (1, "Good, good; not good - the WORST ever"),
    (2, "nothing here"),
    (3, None),
    (4, ""),
    (5, "no bad bad isn't best"),
]


def test_join_form_equals_row_form(spark):
    df = spark.createDataFrame(TEXTS, "UniqueID int, review string")
    table = spark.createDataFrame(list(LEXICON.items()), "word string, polarity double")
    rows = {r.UniqueID: r.sentiment for r in polarity_operators.score_reviews(df).collect()}
    joined = polarity_operators.polarity_by_join(df, table).collect()
    assert {r.UniqueID: pytest.approx(r.sentiment) for r in joined} == rows
    small = polarity_operators.score_reviews(df, table).collect()
    assert {r.UniqueID: r.sentiment for r in small} == rows
    assert all(-1 <= s <= 1 for s in rows.values()) and rows[1] != 0 and rows[2] == 0


def test_lexicon_size_decides_the_form(spark, monkeypatch):
    df = spark.createDataFrame(TEXTS, "UniqueID int, review string")
    table = spark.createDataFrame(list(LEXICON.items()), "word string, polarity double")
    plain = {tuple(r) for r in polarity_operators.score_reviews(df).collect()}
    monkeypatch.setattr(polarity_operators, "MAX_INLINE_WORDS", 10)
    for lexicon in (table, LEXICON):
        scored = polarity_operators.score_reviews(df, lexicon)
        assert "Join" in scored._jdf.queryExecution().optimizedPlan().toString()
        assert {tuple(r) for r in scored.select("UniqueID", "review", "sentiment").collect()} == plain


def test_tokens(spark):
    text = "It's 2nd-rate: 'quoted' don''t naïve_x ''' É"
    got = spark.createDataFrame([(text,)], "t string").select(tokens("t")).first()[0]
    assert got == re.findall(r"\w[\w']*", text.lower())


def test_term_frequency(spark):
    df = spark.createDataFrame(
        [("The pain, the PAIN", 2.0), ("relief", 9.0), (None, 9.0), ("pain", None)],
        "review string, rating double",
    )
    assert dict(term_frequency(df, "review").collect()) == {"the": 2, "pain": 3, "relief": 1}
    assert list(map(tuple, term_frequency(df, "review", STOPWORDS, 1).collect())) == [("pain", 3)]
    assert dict(term_frequency_by_sentiment(df, 0).collect()) == {"pain": 2}
    assert dict(term_frequency_by_sentiment(df, 1).collect()) == {"relief": 1}


def expected_cloud(texts, stopwords, threshold=30.0):
    """Brute force over the same definition."""
    singles, pairs = Counter(), Counter()
    for text in texts:
        words = re.findall(r"\w[\w']*", (text or "").lower())
        words = [w[:-2] if w.endswith("'s") else w for w in words]
        words = [w for w in words if not w.isdigit()]
        singles.update(w for w in words if w not in stopwords)
        pairs.update(
            p for p in zip(words, words[1:]) if p[0] not in stopwords and p[1] not in stopwords
        )

    def plural_of(word):
        return word.endswith("s") and not word.endswith("ss")

    form = {w: w[:-1] if plural_of(w) and w[:-1] in singles else w for w in singles}
    counts = Counter()
    for w, n in singles.items():
        counts[form[w]] += n
    merged = Counter()
    for (a, b), n in pairs.items():
        merged[(a, b[:-1]) if plural_of(b) and (a, b[:-1]) in pairs else (a, b)] += n
    total, original = sum(singles.values()), dict(counts)

    def part(k, n, x):
        return math.log(max(x, 1e-10)) * k + math.log(max(1 - x, 1e-10)) * (n - k)

    for (a, b), n in merged.items():
        c1, c2 = original[form[a]], original[form[b]]
        if total <= c1 or total <= c2:
            continue
        p, p1, p2 = c2 / total, n / c1, (c2 - n) / (total - c1)
        value = -2 * (
            part(n, c1, p) + part(c2 - n, total - c1, p)
            - part(n, c1, p1) - part(c2 - n, total - c1, p2)
        )
        if value > threshold:
            counts[form[a]] -= n
            counts[form[b]] -= n
            counts[f"{a} {b}"] += n
    return {w: n for w, n in counts.items() if n > 0}


@pytest.mark.parametrize("broadcast_rows", [joins.MAX_BROADCAST_ROWS, 3])
def test_cloud_against_brute_force(spark, monkeypatch, broadcast_rows):
    monkeypatch.setattr(joins, "MAX_BROADCAST_ROWS", broadcast_rows)
    texts = [
        "Birth control works. Birth control's cost: 20 dollars; side effects and side effect",
        "side effects of birth controls, hot flashes hot flash 12 34 hot flash",
        "the side effect is the pain, pains of the dress",
        None,
        "filler words to raise the total " * 30,
    ] * 3
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = dict(cloud_terms(df, "t", max_terms=None).collect())
    want = expected_cloud(texts, set(STOPWORDS))
    assert got == want
    assert any(" " in term for term in got)
    top = [tuple(r) for r in cloud_terms(df, "t", max_terms=3).collect()]
    assert top == sorted(want.items(), key=lambda kv: (-kv[1], kv[0]))[:3]


def test_text_classifier(spark):
    rows = [("good great relief", 1), ("bad awful pain", 0)] * 20 + [("unlabelled", None)]
    df = spark.createDataFrame(rows, "text string, label int")
    model = classifier.fit_text_classifier(df)
    fresh = spark.createDataFrame([("such relief, great",), ("awful!",)], "text string")
    labelled = classifier.label_sentiment(model, fresh)
    assert dict(labelled.dtypes)["sentiment"] == "array<struct<result:string>>"
    result = dict(map(tuple, classifier.explode_results(labelled).collect()))
    assert result == {"such relief, great": "positive", "awful!": "negative"}
    assert classifier.annotate(model, "great relief") == ["positive"]


def test_single_text(spark):
    assert polarity_operators.text_polarity(spark, "This drug is the worst!") == -1.0
    assert polarity_operators.text_polarity(spark, None) == 0.0


def test_lexicon_size_does_not_change_scores(spark):
    rows = [(1, "good"), (1, "bad"), (None, "good"), (None, None), (2, "not good")]
    df = spark.createDataFrame(rows, "UniqueID int, review string")
    padded = {**LEXICON, **{f"unused{i}": 0.5 for i in range(polarity_operators.MAX_INLINE_WORDS + 1)}}
    small = polarity_operators.score_reviews(df)
    large = polarity_operators.score_reviews(df, padded)
    assert sorted(map(str, small.collect())) == sorted(map(str, large.select(*small.columns).collect()))


def test_lexicon_with_a_word_twice(spark):
    df = spark.createDataFrame([(1, "good")], "UniqueID int, review string")
    table = spark.createDataFrame([("good", 1.0), ("good", 0.5), ("x", None)], "word string, polarity double")
    for score in (polarity_operators.score_reviews, polarity_operators.polarity_by_join):
        with pytest.raises(ValueError):
            score(df, table).collect()


def _zipf_texts(seed, n=300):
    rng = random.Random(seed)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(400)]
    words += [f"{w}s" for w in words[::3]]
    weights = [1 / (1 + i % 400) for i in range(len(words))]
    fixed = ["white house", "wine glass", "wine glasses", "wa wb"]
    return [
        " ".join(rng.choices(words, weights, k=rng.randrange(60)) + rng.choices(fixed, k=rng.randrange(3)) + [f"only{rng.random()}"])
        for _ in range(n)
    ]


@pytest.mark.parametrize("seed", [1, 2])
def test_cloud_of_some_terms_needs_no_look_up_of_all_pairs(spark, monkeypatch, seed):
    df = spark.createDataFrame([(t,) for t in _zipf_texts(seed)], "t string")
    whole = sorted(map(tuple, cloud_terms(df, "t", (), None).collect()), key=lambda r: (-r[1], r[0]))
    assert any(" " in term for term, _ in whole[:60])
    seen = []
    real = terms.lookup_join
    monkeypatch.setattr(terms, "lookup_join", lambda *a, **k: (seen.append(a), real(*a, **k))[1])
    for k in (1, 7, 60):
        assert [tuple(r) for r in cloud_terms(df, "t", (), k).collect()] == whole[:k]
    assert not seen


def test_cloud_whose_words_all_become_phrases(spark, monkeypatch):
    """Fewer terms are as frequent as the words alone would let expect: all are settled."""
    names = [chr(97 + i) for i in range(12)]
    df = spark.createDataFrame([(f"x{c} y{c}",) for c in names for _ in range(100)], "t string")
    want = [(f"x{c} y{c}", 100) for c in names]
    for k in (3, 12, 20):
        assert [tuple(r) for r in cloud_terms(df, "t", (), k).collect()] == want[:k]
