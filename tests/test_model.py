import math

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from medvoice.operators import rating_model as M
from medvoice.operators.cleaning import clean_reviews
from medvoice.plans import extraction
from medvoice.plans.training import train
from medvoice.plans.views import numeric_reviews
from medvoice.sources import files


@pytest.fixture(scope="module")
def reviews(spark, sf_dir):
    df = numeric_reviews(spark, sf_dir).cache()
    yield df
    df.unpersist()  # or later plans would read the cache


@pytest.fixture(scope="module")
def trained(reviews, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("model") / "m")
    return train(reviews, model_path=path, numTrees=5), path


def test_assembler(spark):
    df = spark.createDataFrame([(3, 0.5)], "usefulCount int, sentiment double")
    assert M.assemble(df).select(vector_to_array("features")).first()[0] == [3.0, 0.5]
    missing = spark.createDataFrame([(3, None)], "usefulCount int, sentiment double")
    with pytest.raises(Exception, match="null|NULL"):
        M.assemble(missing).collect()


def test_defaults_of_the_forest(spark, reviews):
    model = M.fit_rating_model(clean_reviews(reviews).limit(200))
    forest = model.stages[-1]
    assert forest.getNumTrees == 20 and forest.getMaxDepth() == 5
    assert forest.getMaxBins() == 32 and forest.getSubsamplingRate() == 1.0


def test_report(reviews, trained):
    result, _ = trained
    report = {r.split: r for r in result.report.collect()}
    deviation = clean_reviews(reviews).agg(F.stddev_samp("rating")).first()[0]
    assert set(report) == {"train", "holdout"}
    assert report["holdout"].rmse < deviation and report["train"].rmse < deviation
    assert report["train"].n + report["holdout"].n == clean_reviews(reviews).count()
    assert report["holdout"].n == result.predictions.count()
    by_hand = result.predictions.agg(
        F.sqrt(F.avg(F.pow(F.col("rating") - F.col("prediction"), 2)))
    ).first()[0]
    assert math.isclose(by_hand, report["holdout"].rmse)


def test_reload_predicts_the_same(spark, trained):
    result, path = trained
    again = M.predict(M.load_model(path), result.predictions.drop("features", "prediction"))
    sums = [d.agg(F.sum("prediction")).first()[0] for d in (result.predictions, again)]
    assert math.isclose(*sums, rel_tol=1e-12)
    one = spark.createDataFrame([(1, -1.0)], "usefulCount int, sentiment double")
    assert M.predict(M.load_model(path), one).first().prediction > 0
    M.save_model(result.model, path)  # replaces


def test_fit_is_repeatable(reviews, trained):
    result, _ = trained
    again = train(reviews, numTrees=5)
    assert {r.split: r.rmse for r in again.report.collect()} == pytest.approx(
        {r.split: r.rmse for r in result.report.collect()}
    )


def test_fit_does_not_depend_on_parts(reviews):
    rows = reviews.where("rating IS NOT NULL AND condition IS NOT NULL")
    forests = [
        M.fit_rating_model(rows.repartition(n), numTrees=3).stages[-1].toDebugString.split("\n", 1)[1]
        for n in (1, 5, 16)
    ]
    assert forests[0] == forests[1] == forests[2]


def test_condition_as_third_feature(reviews):
    features = ("usefulCount", "sentiment", "condition_idx")
    result = train(reviews, numTrees=2, features=features, indexed=("condition",))
    assert result.model.stages[-1].numFeatures == 3
    unknown = result.predictions.withColumn("condition", F.lit("never seen")).drop(
        "prediction", "features", "_condition_label", "condition_idx"
    )
    assert M.predict(result.model, unknown).where("prediction IS NULL").count() == 0


def test_given_holdout(reviews):
    left, right = reviews.where("UniqueID % 2 = 0"), reviews.where("UniqueID % 2 = 1")
    report = {r.split: r.n for r in train(left, right, numTrees=2).report.collect()}
    assert report == {
        "train": clean_reviews(left).count(), "holdout": clean_reviews(right).count(),
    }


def test_label_index(spark):
    df = spark.createDataFrame([("b",), ("b",), ("c",), ("a",), (None,)], "condition string")
    model = M.fit_label_index(df)
    assert model.labels == ["b", "a", "c"]
    assert model.transform(df).count() == 4
    unseen = spark.createDataFrame([("z",), ("a",)], "condition string")
    assert [r.condition_idx for r in model.transform(unseen).collect()] == [1.0]
    with pytest.raises(ValueError):
        M.fit_label_index(df, max_labels=2)


def test_label_ranks_equal_the_index(spark):
    labels = [f"l{i % 97}" for i in range(1000)] + ["hot"] * 500 + [None]
    df = spark.createDataFrame([(v, i) for i, v in enumerate(labels)], "condition string, i int")
    indexed = M.fit_label_index(df).transform(df)
    ranked = M.index_by_ranks(df, M.label_ranks(df))
    assert ranked.count() == 1500
    assert set(map(tuple, ranked.select("i", "condition", "condition_idx").collect())) == set(
        map(tuple, indexed.select("i", "condition", "condition_idx").collect())
    )


def test_extraction_to_training(spark, tmp_path):
    rows = [(i, "A", "c", text, rating, "d", i % 7) for i, (text, rating) in enumerate(
        [("great relief", 9.0), ("awful pain\n|", 2.0), ("nothing", 5.0)] * 40)]
    rows += [(999, "A", None, "x", 1.0, "d", 1), (998, "A", "9</span> u", "x", 1.0, "d", 1)]
    raw, scored = str(tmp_path / "raw"), str(tmp_path / "scored")
    schema = "UniqueID int, drugName string, condition string, review string, rating double, date string, usefulCount int"
    files.write_reviews_tsv(spark.createDataFrame(rows, schema), raw)
    for file_format in ("csv", "parquet"):
        extraction.run(spark, raw, scored, file_format=file_format)
    assert spark.read.parquet(scored).count() == 120
    extraction.run(spark, raw, scored)
    table = files.read_scored_csv(spark, scored)
    assert table.count() == 120
    report = train(table, table, numTrees=3).report.collect()
    assert all(r.rmse < 1.0 for r in report)


# -- Labels as a table, cells instead of rows --------------------------------------


def test_label_index_stage(spark, tmp_path, monkeypatch):
    from pyspark.ml import PipelineModel

    from medvoice.operators import joins
    from medvoice.operators.label_index import LabelIndex

    labels = [f"l{i % 97}" for i in range(1000)] + ["hot"] * 500 + [None]
    df = spark.createDataFrame([(v, i) for i, v in enumerate(labels)], "condition string, i int")
    want = {r.condition: r.condition_idx for r in M.fit_label_index(df).transform(df).collect()}
    stage = LabelIndex(inputCol="condition", outputCol="x").fit(df)
    path = str(tmp_path / "m")
    PipelineModel(stages=[stage]).write().overwrite().save(path)
    PipelineModel(stages=[stage]).write().overwrite().save(path)  # replaces
    loaded = PipelineModel.load(path)
    asked = df.unionByName(spark.createDataFrame([("new", 9001)], df.schema))
    for bound in (joins.MAX_BROADCAST_ROWS, 5):  # broadcast, then salted
        monkeypatch.setattr(joins, "MAX_BROADCAST_ROWS", bound)
        rows = loaded.transform(asked).collect()
        assert len(rows) == 1502 and rows[0].__fields__ == ["condition", "i", "x"]
        assert all(r.x == want.get(r.condition, 98.0) for r in rows)
        kept = stage.copy().setParams(inputCol="condition", outputCol="x", handleInvalid="skip")
        assert kept.transform(asked).count() == 1500
        strict = stage.copy().setParams(inputCol="condition", outputCol="x", handleInvalid="error")
        with pytest.raises(Exception, match="unknown label"):
            strict.transform(asked).collect()
    with pytest.raises(ValueError):
        loaded.transform(asked.withColumn("x", F.lit(1)))


def test_150_000_labels(spark, tmp_path):
    """Train, store, load and predict with more labels than a model holds; no refusal."""
    rows = spark.range(200_000).selectExpr(
        "id AS UniqueID", "concat('c', CASE WHEN id < 150000 THEN id ELSE id % 1000 END) AS condition",
        "CAST(id % 7 AS int) AS usefulCount", "(id % 11) / 10.0D AS sentiment", "1.0D + id % 10 AS rating",
    )
    features = ("usefulCount", "sentiment", "condition_idx")
    path = str(tmp_path / "m")
    result = train(rows, model_path=path, features=features, indexed=("condition",), numTrees=1)
    assert type(result.model.stages[0]).__name__ == "LabelIndexModel"
    again = M.predict(M.load_model(path), rows.where("UniqueID < 50"))
    first = M.predict(result.model, rows.where("UniqueID < 50"))
    assert sorted(r.prediction for r in again.collect()) == sorted(r.prediction for r in first.collect())
    unknown = rows.limit(3).withColumn("condition", F.lit("never seen"))
    assert {r.condition_idx for r in M.predict(M.load_model(path), unknown).collect()} == {
        float(result.model.stages[0].ranks.count())
    }


def test_cells(spark):
    from medvoice.operators.collapse import collapse

    df = spark.range(30_000).selectExpr("id % 1000 / 7.0D AS a", "CAST(id % 5 AS int) AS b", "id % 3 AS y", "id AS other")
    cells = collapse(df, ["a", "b"], "y", 16, 4)
    assert cells.columns == ["a", "b", "y", "weight", "piece"]
    assert cells.agg(F.sum("weight")).first()[0] == 30_000
    assert cells.groupBy("a", "b", "y").count().count() <= 16 * 5 * 3 and {r.b for r in cells.collect()} == set(range(5))
    by_label = {r.y: r.n for r in cells.groupBy("y").agg(F.sum("weight").alias("n")).collect()}
    assert by_label == {0: 10_000, 1: 10_000, 2: 10_000}
    assert sorted(map(tuple, cells.collect())) == sorted(map(tuple, collapse(df.repartition(7), ["a", "b"], "y", 16, 4).collect()))


def test_collapsed_fit(reviews):
    rows = clean_reviews(reviews)
    plain, cells = (train(rows, bins=b) for b in (None, 64))
    for a, b in zip(plain.report.orderBy("split").collect(), cells.report.orderBy("split").collect()):
        assert a.n == b.n and b.rmse < 1.02 * a.rmse
    forests = [
        M.fit_rating_model(rows.repartition(n), numTrees=3, bins=32).stages[-1].toDebugString.split("\n", 1)[1]
        for n in (1, 5)
    ]
    assert forests[0] == forests[1]


def test_parts_follow_the_rows(reviews, monkeypatch):
    seen = []
    real = type(reviews).repartition
    monkeypatch.setattr(type(reviews), "repartition", lambda self, n, *c: (seen.append(n), real(self, n, *c))[1])
    monkeypatch.setattr(M, "PART_ROWS", 100)
    rows = clean_reviews(reviews)
    M.fit_rating_model(rows, numTrees=1)
    assert seen == [-(-rows.count() // 100)]
