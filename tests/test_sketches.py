"""Stored sketches, frequent values, large samples, observed counts, the SQL function, word labels, the archive."""

import math
import os
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from medvoice.functions.lexicon import LEXICON
from medvoice.functions.sql import register_polarity
from medvoice.functions.text import polarity
from medvoice.operators import joins, sampling, sketches
from medvoice.operators import profiling as P
from medvoice.operators import rating_model as M
from medvoice.operators.cleaning import clean_reviews, observed, stage_counts
from medvoice.operators.word_bayes import WordBayes, fit_word_bayes, label_by_words
from medvoice.streaming.scoring import archive_scored, committed_sources, landed_source, score_landed
from tests.test_streaming import BAD, GOOD, encode, folders, land, publish  # noqa: F401


def test_parts_merge_to_the_whole(spark):
    rng = np.random.default_rng(1)
    values = np.concatenate((rng.normal(1e6, 1, 4000), rng.exponential(5, 3000), [7.5] * 3000))
    rng.shuffle(values)
    df = spark.createDataFrame([(i % 13, i % 2, float(v)) for i, v in enumerate(values)] + [(1, 0, None)], "a int, b int, x double")
    parts = sketches.summary_parts(df, "x", ["a", "b"])
    assert parts.count() == 26 and parts.agg(F.max(F.octet_length("sketch"))).first()[0] < 30_000
    for by in ([], ["b"]):
        for row in sketches.summary_of(sketches.merged_parts(parts, by)).collect():
            own = np.sort(values[np.arange(len(values)) % 2 == row["b"]] if by else values)
            assert (row["count"], row["min"], row["max"]) == (len(own), own[0], own[-1])
            assert math.isclose(row["mean"], own.mean()) and math.isclose(row["stddev"], own.std(ddof=1), rel_tol=1e-9)
            for q in (0.25, 0.5, 0.75):
                low, high = np.searchsorted(own, row[f"q{round(100 * q)}"], "left"), np.searchsorted(own, row[f"q{round(100 * q)}"], "right")
                assert low / len(own) - 0.01 <= q <= high / len(own) + 0.01
    one = sketches.summary_of(sketches.summary_parts(spark.createDataFrame([(2.0,)], "x double"), "x")).first()
    assert (one["count"], one["mean"], one["stddev"], one["q50"]) == (1, 2.0, None, 2.0)


def test_top_values(spark, monkeypatch):
    rng = random.Random(4)
    cases = {
        "few": [rng.randrange(30) for _ in range(4000)],
        "heavy": [int(2 ** rng.expovariate(0.25)) for _ in range(20_000)],
        "even": [i % 5000 for i in range(20_000)],
        "ties": [i % 7 for i in range(700)] + [100 + i for i in range(3000)],
        "none": [],
    }
    for name, values in cases.items():
        df = spark.createDataFrame([(v, str(v)) for v in values] + [(None, None)], "v long, s string").repartition(4)
        for column in ("v", "s"):
            want = [tuple(r) for r in P.value_counts(df, column).limit(6).collect()]
            for tracked in (50, 400, 10_000):
                got = sketches.top_values(df, column, 6, tracked)
                assert sorted(map(tuple, got.collect())) == sorted(want), (name, tracked)
                assert got.columns == [column, "n"]


def test_top_values_do_not_shuffle_all(spark, monkeypatch):
    """With heavy values the candidates settle it: all values are never counted."""
    values = [int(2 ** random.Random(i).expovariate(0.25)) for i in range(20_000)]
    df = spark.createDataFrame([(v,) for v in values], "v long")
    seen = []
    real = sketches.value_counts
    monkeypatch.setattr(sketches, "value_counts", lambda d, c: (seen.append(d.distinct().count()), real(d, c))[1])
    sketches.top_values(df, "v", 5, tracked=1000)
    assert len(seen) == 1 and seen[0] <= 20 < len(set(values))


def test_large_sample(spark, monkeypatch):
    df = spark.range(5000).selectExpr("id AS k", "id % 7 AS other").repartition(5)
    for last in (10_000, 3):
        monkeypatch.setattr(sampling, "LAST", last)
        for n in (1, 17, 2500, 4999, 5000, 9000):
            want = {r.k for r in sampling.sample_n(df, ["k"], n, 3).collect()}
            got = sampling.sample_large(df, ["k"], n, 3)
            assert {r.k for r in got.collect()} == want and got.columns == ["k", "other"]
    plan = sampling.sample_large(df, ["k"], 2500, 3)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrdered" not in plan and "Sort" not in plan and "Limit" not in plan
    assert sampling.sample_large(df, ["k"], 0).count() == 0
    # Rows of one key share a hash.
    hot = spark.range(100).selectExpr("id % 3 AS k", "id")
    assert [sampling.sample_large(hot, ["k"], n).count() for n in (1, 40, 77, 100)] == [1, 40, 77, 100]
    assert sampling.sample_large(df.limit(0), ["k"], 5).count() == 0


def test_observed_counts(spark):
    rows = [(1, "c", 1.0), (2, None, 1.0), (3, "</span>", 2.0), (4, "d", None), (5, "e", 3.0)]
    df = spark.createDataFrame(rows, "UniqueID int, condition string, rating double")
    counts = Observation("x")
    assert clean_reviews(observed(df, counts)).count() == 2
    assert counts.get == {r.stage: r.n for r in stage_counts(df).collect()} == {"raw": 5, "no_nulls": 3, "clean": 2}


def test_polarity_in_sql(spark, tmp_path):
    texts = ["I am not happy, it's great", None, "", "no good's don't help great", "GREAT great\nbad \\ 'quoted'", "it wasn't good"]
    df = spark.createDataFrame([(t,) for t in texts], "review string")
    lexicon = {**LEXICON, "quoted": 0.25, "good's": -1.0, "back\\slash": 0.5}
    for words in (LEXICON, lexicon, {}):
        register_polarity(spark, "scored_as", words)
        got = [r[0] for r in df.selectExpr("scored_as(review)").collect()]
        want = [r[0] for r in df.select(polarity("review", words)).collect()] if words else [0.0] * len(texts)
        assert got == want
    register_polarity(spark)
    plan = df.selectExpr("polarity(review)")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "UDF" not in plan
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("great\nawful\n")
    stream = spark.readStream.text(str(tmp_path / "in")).selectExpr("value", "polarity(value) AS p")
    stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c")).trigger(
        availableNow=True
    ).start(str(tmp_path / "out")).awaitTermination()
    rows = {r.value: r.p for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert rows["great"] > 0 > rows["awful"]


def brute_labels(rows):
    def toks(t):
        return re.findall(r"[^\W]['\w]*", t.lower())

    count = {0: Counter(), 1: Counter()}
    docs = Counter()
    for t, y in rows:
        if t is not None and y is not None:
            count[y].update(toks(t))
            docs[y] += 1
    words = set(count[0]) | set(count[1])
    total = {y: sum(count[y].values()) + len(words) for y in (0, 1)}
    out = []
    for t, _ in rows:
        if t is None:
            continue
        score = math.log(docs[1] + 1) - math.log(docs[0] + 1)
        for w in toks(t):
            if w in words:
                score += math.log((count[1][w] + 1) / total[1]) - math.log((count[0][w] + 1) / total[0])
        out.append((t, "positive" if round(score, 9) > 0 else "negative"))
    return sorted(out)


def test_word_labels(spark, tmp_path, monkeypatch):
    rng = random.Random(6)
    good, bad, any_ = "fine great calm".split(), "awful pain sick".split(), [f"w{i}" for i in range(60)]
    rows = [
        (" ".join(rng.choice(any_ + (good if i % 3 else bad) * 4) for _ in range(rng.randrange(0, 30))), int(i % 3 > 0))
        for i in range(300)
    ] + [(None, 1), ("great great", None), ("never seen words", None), ("great", 0)]
    df = spark.createDataFrame(rows, "text string, label int").repartition(4)
    model = fit_word_bayes(df)
    model.save(str(tmp_path / "m"))
    for bound in (joins.MAX_BROADCAST_ROWS, 5):
        monkeypatch.setattr(joins, "MAX_BROADCAST_ROWS", bound)
        loaded = WordBayes.load(spark, str(tmp_path / "m"))
        got = label_by_words(loaded, df.withColumn("term", F.lit("x")))
        assert got.columns == ["text", "label", "term", "sentiment"]
        assert sorted((r.text, r.sentiment[0].result) for r in got.collect()) == brute_labels(rows)
    empty = fit_word_bayes(df.limit(0))
    assert {r.sentiment[0].result for r in label_by_words(empty, df).collect()} == {"negative"}


def test_archive_after_one_run(spark, folders):  # noqa: F811
    model = M.fit_rating_model(
        spark.createDataFrame([(i, 0.5, 6.0) for i in range(9)], "usefulCount int, sentiment double, rating double"), numTrees=1
    )
    f = {k: str(v) for k, v in folders.items()}

    def names(folder):
        return sorted(n for _, _, found in os.walk(folder) for n in found if n.endswith(".csv"))

    assert archive_scored(spark, f["scoring"], f["landed"], f["archive"]) == 0
    for i, body in enumerate((GOOD, BAD)):
        publish(folders["messages"], f"{i}.txt", encode(dict(body, condition=f"c {i} ä")))
        land(spark, folders)
    score_landed(model, landed_source(spark, f["landed"]), f["predictions"], f["scoring"]).awaitTermination()
    scored = names(f["landed"])
    publish(folders["messages"], "late.txt", encode(dict(GOOD, UniqueID=7)))
    land(spark, folders)  # arrives after the run has listed its files
    late = sorted(set(names(f["landed"])) - set(scored))
    assert committed_sources(spark, f["scoring"]).count() == len(scored) == 2
    assert archive_scored(spark, f["scoring"], f["landed"], f["archive"]) == 2
    assert names(f["archive"]) == scored and names(f["landed"]) == late
    assert archive_scored(spark, f["scoring"], f["landed"], f["archive"]) == 0
    score_landed(model, landed_source(spark, f["landed"]), f["predictions"], f["scoring"]).awaitTermination()
    assert archive_scored(spark, f["scoring"], f["landed"], f["archive"]) == 1 and names(f["landed"]) == []
    assert spark.read.parquet(f["predictions"]).count() == 3
    assert any("month_dir=" in d for d in os.listdir(f["archive"]))
