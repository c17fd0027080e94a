"""Every registered query against its SQL, and the shape of the plans."""

import re

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from medvoice.operators import joins
from medvoice.plans.queries import QUERIES
from medvoice.workspace import spread
from tests.check import connect, difference

# Queries that start jobs of their own when built; their plans are only a read.
FIXED = {"rating_model_predictions", "rating_model_rmse", "prediction_sample",
         "model_reload_predict", "stream_score_new", "batch_score_landed"}


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_every_query_without_sql_fits_a_model():
    own = set(QUERIES)
    assert own - set(oracle_sql()) == FIXED
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, duck, sf_dir, name):
    got = queries()[name](spark, sf_dir).toPandas()
    want = duck.execute(oracle_sql()[name]).df()
    assert difference(got, want) is None


@pytest.mark.parametrize("name", sorted(FIXED))
def test_model_query_runs(spark, sf_dir, name):
    assert queries()[name](spark, sf_dir).count() > 0


def plan(spark, sf_dir, name):
    return queries()[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()


NARROW = ["clean_reviews", "project_features", "review_sent", "rint_col"]
TEXT_NARROW = ["review_polarity", "extract_scored", "decode_messages", "rename_review"]
LAZY = NARROW + TEXT_NARROW + [
    "stage_counts", "avg_rating_by_drug", "rating_percent", "top_conditions", "top_drugs_gt",
    "term_frequency", "term_freq_negative", "price_describe",
    "sample_n", "holdout_split", "latest_reviews", "month_dir_counts",
]


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_cross_join(spark, sf_dir, name):
    text = plan(spark, sf_dir, name)
    for node in ("Python", "InPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in text


@pytest.mark.parametrize("name", TEXT_NARROW)
def test_scoring_texts_shuffles_nothing(spark, sf_dir, name):
    assert "Exchange" not in plan(spark, sf_dir, name)


@pytest.mark.parametrize("name", NARROW)
def test_only_the_view_join_moves_rows(spark, sf_dir, name):
    text = plan(spark, sf_dir, name)  # at this size the products are broadcast
    assert "BroadcastExchange" in text and "partitioning" not in text


def test_spread_leaves_large_tables_alone(spark):
    many = spark.range(0, 100, 1, 64)
    assert spread(many) is many
    few = spread(spark.range(0, 100, 1, 1))
    assert few.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert few.count() == 100


def test_only_needed_columns_are_read(spark, sf_dir):
    text = plan(spark, sf_dir, "project_features")
    assert "l_extendedprice" not in text and "p_name" not in text
    assert "ReadSchema: struct<text:string>" in plan(spark, sf_dir, "term_frequency")


def test_filters_reach_the_scan(spark, sf_dir):
    text = plan(spark, sf_dir, "top_drugs_gt")
    pushed = "".join(re.findall(r"PushedFilters: \[(.*?)\]", text))
    assert "IsNotNull(l_partkey)" in pushed and "IsNotNull(p_brand)" in pushed


@pytest.mark.parametrize("name", ["top_conditions", "term_freq_negative", "sample_n", "latest_reviews"])
def test_top_k_is_not_a_sort(spark, sf_dir, name):
    assert "TakeOrderedAndProject" in plan(spark, sf_dir, name)


@pytest.mark.parametrize("name", ["avg_rating_by_drug", "term_frequency", "top_drugs_gt"])
def test_groups_are_reduced_before_the_shuffle(spark, sf_dir, name):
    text = plan(spark, sf_dir, name)
    assert "partial_count" in text


def test_rating_percent_reuses_its_counts(spark, sf_dir):
    df = queries()["rating_percent"](spark, sf_dir)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in final


def test_large_lookup_spreads_hot_words(spark, sf_dir, monkeypatch):
    small = queries()["review_polarity_large_lexicon"](spark, sf_dir)
    assert "BroadcastHashJoin [word" in small._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(joins, "MAX_BROADCAST_ROWS", 100)
    large = queries()["review_polarity_large_lexicon"](spark, sf_dir)
    text = large._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"hashpartitioning\(word#\d+, _salt#\d+", text)
    assert set(map(tuple, large.collect())) == set(map(tuple, small.collect()))
