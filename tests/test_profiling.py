import math
import random

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from medvoice.functions import columns as C
from medvoice.operators import profiling as P
from medvoice.operators import quantiles
from medvoice.operators.cleaning import clean_reviews, drop_markup_conditions, stage_counts
from medvoice.operators.sampling import holdout_split, sample_n, with_split
from medvoice.plans.profile import reports

SCHEMA = "drugName string, condition string, rating double, usefulCount int"


@pytest.fixture(scope="module")
def reviews(spark):
    return spark.createDataFrame(
        [
            ("a", "Fever", 10.0, 100),
            ("a", "Fever", 10.0, 150),
            ("a", "Fever", 9.0, 100),
            ("b", "Fever", 7.0, 500),
            ("b", "Fever", 8.0, 99),
            ("b", "Fever", 8.5, 100),
            (None, "Fever", 9.0, 500),
            ("c", "Pain", None, 500),
            ("c", None, 2.0, 1),
            ("d", "9</span> users", 5.0, 1),
        ],
        SCHEMA,
    )


def test_cleaning(reviews):
    assert clean_reviews(reviews).count() == 6
    # A NULL condition goes with the markup ones.
    assert drop_markup_conditions(reviews).count() == 8
    assert dict(stage_counts(reviews).collect()) == {"raw": 10, "no_nulls": 7, "clean": 6}


def test_rating_percent_counts_unrated_rows_in_the_total(reviews):
    shares = dict(P.rating_percent(reviews).collect())
    assert shares[10.0] == 20.0 and None not in shares
    assert math.isclose(sum(shares.values()), 90.0)


def test_histogram_and_value_counts(reviews):
    ratings = [r.rating for r in P.rating_histogram(reviews).collect()]
    assert ratings == sorted((r for r in ratings if r is not None), reverse=True) + [None]
    assert P.value_counts(reviews, "condition").first().asDict() == {"condition": "Fever", "n": 7}
    assert [r.condition for r in P.top_conditions(reviews, 2).collect()] == ["Fever", "9</span> users"]


def test_avg_rating(reviews):
    rows = P.avg_rating_by(clean_reviews(reviews), "drugName").collect()
    assert [(r.drugName, r.n) for r in rows] == [("a", 3), ("b", 3)]
    assert math.isclose(rows[0].avg_rating, 29 / 3)


def test_crosstab(reviews):
    table = P.top_drugs(reviews, "Fever", 7.0, False)
    assert table.columns == ["drugName", "r8_5", "r9", "r10"]
    assert sorted(map(tuple, table.collect())) == [("a", 0, 1, 2), ("b", 1, 0, 0)]
    fixed = P.top_drugs(reviews, "Fever", 9.0, True)
    assert list(map(tuple, fixed.collect())) == [("a", 1, 2)]
    pairs = P.crosstab_long(reviews, "drugName", "rating")
    assert pairs.agg(F.sum("n")).first()[0] == 8


def test_derived_columns(spark):
    df = spark.createDataFrame([(2.5,), (3.5,), (5.0,), (4.9,), (None,)], "x double")
    rows = df.select(C.round_half_even("x"), C.review_sent("x")).collect()
    assert [r[0] for r in rows] == [2.0, 4.0, 5.0, 5.0, None]
    assert [r[1] for r in rows] == [0, 0, 1, 0, None]
    text = spark.createDataFrame([("1.5",), ("x",)], "t string")
    assert [r[0] for r in text.select(C.to_numeric_or_null("t")).collect()] == [1.5, None]
    with pytest.raises(PySparkException):
        text.select(C.to_numeric("t")).collect()
    month = spark.sql("SELECT timestamp'2022-03-09 00:00:00' AS t").select(C.month_dir("t"))
    assert month.first()[0] == "3-2022"
    stamp = spark.range(1).select(C.run_stamp()).first()[0]
    assert len(stamp) == 22


def test_rmse(spark):
    df = spark.createDataFrame([(1.0, 2.5), (4.0, 3.5)], "y double, p double")
    row = df.agg(P.rmse("y", "p"), P.rmse_rounded("y", "p")).first()
    assert math.isclose(row[0], math.sqrt((2.25 + 0.25) / 2))
    assert math.isclose(row[1], math.sqrt((1 + 0) / 2))


@pytest.mark.parametrize("kind", ["hot", "distinct", "single", "two", "wide", "near", "signs", "none"])
def test_exact_quantiles_against_numpy(spark, kind):
    rng = random.Random(7)
    values = {
        "hot": [0.0] * 700 + [rng.gauss(0, 1) for _ in range(300)],
        "distinct": [rng.random() * 1e6 for _ in range(1500)],
        "single": [3.25],
        "two": [1.0, 2.0],
        "wide": [10.0 ** rng.uniform(-300, 300) for _ in range(900)] + [1.7e308, 5e-324],
        "near": [1.0 + k * 2.0**-52 for k in range(300)] + [5e-324 * k for k in range(1, 200)],
        "signs": [rng.choice([-1, 1]) * 10.0 ** rng.uniform(-9, 9) for _ in range(800)] + [0.0, -0.0] * 50,
        "none": [],
    }[kind]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "x double").repartition(3)
    wanted = [0.0, 0.25, 0.5, 0.75, 0.99, 1.0]
    for cells, keep in ((16, 40), (quantiles.CELLS, quantiles.KEEP)):
        got = quantiles.exact_quantiles(df, "x", wanted, cells, keep)
        if values:
            assert np.allclose(got, np.percentile(values, [100 * q for q in wanted]), rtol=1e-12, atol=1e-323)
        else:
            assert got == [None] * 6


def test_ordered_values_with_infinities(spark):
    values = [-math.inf] * 2 + [-1.5, 0.0, 2.5, 2.5] + [math.inf] * 2 + [math.nan]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    n, found = quantiles.ordered_values(df, "x", list(range(-1, 12)))
    assert n == 9 and repr([found[k] for k in range(9)]) == repr(values) and len(found) == 9


def test_many_distinct_values_are_not_ordered(spark):
    """A million distinct values: counters only, at most a row per cell leaves a task."""
    df = spark.range(1_000_000, numPartitions=8).selectExpr("(id * 7919) % 1000003 AS x")
    want = np.percentile((np.arange(1_000_000) * 7919) % 1000003, [25, 50, 75])
    assert quantiles.exact_quantiles(df, "x") == list(want)
    ranges = [quantiles.Range(0.0, 1000002.0, 0, 1_000_000)]
    values = df.selectExpr("CAST(x AS double) AS v")
    numbered = quantiles._numbered(values, ranges)
    cells = numbered.groupBy("range", quantiles._cell(F.col("v"), F.col("range"), ranges, 1024)).count()
    assert cells.count() <= 1024 and "Sort" not in cells._jdf.queryExecution().executedPlan().toString()


def test_cut_points(spark):
    df = spark.range(100_000).selectExpr("CASE WHEN id % 3 = 0 THEN 5.0 ELSE id * 1.0 END AS x")
    cuts = quantiles.cut_points(df, "x", 16)
    assert cuts == quantiles.cut_points(df.repartition(5), "x", 16) and 5.0 in cuts and len(cuts) <= 15
    values = np.where(np.arange(100_000) % 3 == 0, 5.0, np.arange(100_000))
    parts = np.bincount(np.searchsorted(cuts, values), minlength=len(cuts) + 1)
    assert parts[1:].max() <= 1.6 * 100_000 / 16 and parts[0] >= 33_333
    assert quantiles.cut_points(df.where("x IS NULL"), "x", 16) == []


def test_describe_and_summary(spark):
    values = [float(v) for v in range(101)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    full = quantiles.describe(df, "x").first()
    assert (full["count"], full["min"], full["q25"], full["q50"], full["q75"], full["max"]) == (
        101, 0.0, 25.0, 50.0, 75.0, 100.0,
    )
    assert math.isclose(full["stddev"], np.std(values, ddof=1))
    assert P.summary(df, "x").first()["q50"] == 50.0


def test_sample_is_exact_and_stable(spark):
    df = spark.range(5000).withColumnRenamed("id", "k")
    first = {r.k for r in sample_n(df, ["k"], 1000, 1).collect()}
    again = {r.k for r in sample_n(df.repartition(13), ["k"], 1000, 1).collect()}
    other = {r.k for r in sample_n(df, ["k"], 1000, 2).collect()}
    assert len(first) == 1000 and first == again and first != other
    assert sample_n(df.limit(10), ["k"], 1000).count() == 10


def test_split_keeps_keys_together(spark):
    df = spark.range(4000).selectExpr("id % 1000 AS k", "id")
    train, held = holdout_split(df, ["k"])
    assert train.count() + held.count() == 4000
    assert train.join(held, "k").count() == 0
    share = with_split(df, ["k"]).where("holdout").count() / 4000
    assert 0.2 < share < 0.3


def test_reports_cover_every_profile(spark, reviews):
    df = reviews.withColumn("review", F.lit("worst headache ever, worst headache"))
    tables = reports(df)
    assert set(tables) >= {"top_birth_control", "top_depression", "negative_cloud", "positive_cloud"}
    for table in tables.values():
        table.collect()
    top = {r.term: r.n for r in tables["review_cloud"].collect()}
    assert max(top.values()) == 20
