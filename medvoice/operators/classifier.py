"""Positive/negative labelling of texts by a trained classifier."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.base import Estimator
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.feature import HashingTF, RegexTokenizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from medvoice.functions.text import TOKEN_PATTERN

# The labels a text can get.
NEGATIVE, POSITIVE = "negative", "positive"
# Size of the hashed vocabulary: the model is two rows of this many numbers,
# whatever the number of distinct words. Words beyond it share places.
VOCABULARY = 1 << 20


def text_classifier(
    text: str = "text", label: str = "label", estimator: Estimator | None = None,
    vocabulary: int = VOCABULARY,
) -> Pipeline:
    """Tokens, hashed counts, classifier.

    The default classifier is multinomial naive Bayes: its fit is one pass of
    sums, whereas iterative ones pass over all texts many times. Any other
    classifier with a ``prediction`` column can be given.
    """
    return Pipeline(
        stages=[
            RegexTokenizer(
                inputCol=text, outputCol="_tokens", pattern=TOKEN_PATTERN,
                gaps=False, toLowercase=True,
            ),
            HashingTF(inputCol="_tokens", outputCol="_counts", numFeatures=vocabulary),
            estimator or NaiveBayes(labelCol=label, featuresCol="_counts", smoothing=1.0),
        ]
    )


def fit_text_classifier(
    df: DataFrame,
    text: str = "text",
    label: str = "label",
    estimator: Estimator | None = None,
    vocabulary: int = VOCABULARY,
) -> PipelineModel:
    """Fit on the labelled rows that have a text."""
    labelled = df.where(F.col(label).isNotNull() & F.col(text).isNotNull())
    return text_classifier(text, label, estimator, vocabulary).fit(
        labelled.select(text, F.col(label).cast("double").alias(label))
    )


def label_column(prediction: Column | str = "prediction") -> Column:
    """The annotation column: an array with one result struct."""
    prediction = F.col(prediction) if isinstance(prediction, str) else prediction
    result = F.when(prediction == 1.0, POSITIVE).otherwise(NEGATIVE)
    return F.array(F.struct(result.alias("result")))


def label_sentiment(model: PipelineModel, df: DataFrame, output: str = "sentiment") -> DataFrame:
    """Add the annotation column to each row with a text."""
    drop = ("_tokens", "_counts", "rawPrediction", "probability", "prediction")
    return (
        model.transform(df.where(F.col(model.stages[0].getInputCol()).isNotNull()))
        .withColumn(output, label_column())
        .drop(*drop)
    )


def explode_results(df: DataFrame, column: str = "sentiment") -> DataFrame:
    """One row per result; the annotation column becomes the result text."""
    return df.withColumn(column, F.explode(F.col(f"{column}.result")))


def annotate(model: PipelineModel, text: str) -> list[str]:
    """Labels of a single text."""
    column = model.stages[0].getInputCol()
    frame = SparkSession.active().createDataFrame([(text,)], f"{column} string")
    return [r.result for r in label_sentiment(model, frame).first()["sentiment"]]
