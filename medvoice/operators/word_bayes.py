"""Positive/negative labelling by multinomial naive Bayes with a vocabulary of any size.

Every distinct word has its own weight, in a table; no word shares a place with another,
and nothing of the vocabulary's size is on the driver.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from medvoice.operators.classifier import label_column
from medvoice.operators.joins import lookup_join
from medvoice.operators.terms import explode_tokens
from medvoice.workspace import materialize

# Digits that count in a score: sums of logarithms differ behind them with their order.
DIGITS = 9


@dataclass
class WordBayes:
    """``weights``: a table (term, weight) of log odds; ``prior``: log odds of the labels."""

    weights: DataFrame
    prior: float

    def save(self, path: str) -> None:
        self.weights.write.mode("overwrite").parquet(f"{path}/weights")
        prior = self.weights.sparkSession.createDataFrame([(self.prior,)], "prior double")
        prior.coalesce(1).write.mode("overwrite").parquet(f"{path}/prior")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> WordBayes:
        return cls(spark.read.parquet(f"{path}/weights"), spark.read.parquet(f"{path}/prior").first()["prior"])


def _log_odds(positive: Column, negative: Column, smoothing: float) -> Column:
    return F.log(positive + smoothing) - F.log(negative + smoothing)


def fit_word_bayes(
    df: DataFrame, text: str = "text", label: str = "label", smoothing: float = 1.0
) -> WordBayes:
    """Count words by label, in one pass; rows without a label or a text are left out."""
    known = df.where(F.col(label).isNotNull() & F.col(text).isNotNull())
    positive = F.col("label") == 1
    counts = materialize(
        explode_tokens(known.select(F.col(text).alias("text"), F.col(label).alias("label")), "text", "label")
        .groupBy("term")
        .agg(F.count_if(positive).alias("p"), F.count_if(~positive).alias("n")),
        "words",
    )
    all_ = counts.agg(
        F.count(F.lit(1)).alias("v"), F.coalesce(F.sum("p"), F.lit(0)).alias("p"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")
    ).first()
    rows = known.agg(F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) != 1).alias("n")).first()
    size = smoothing * all_["v"]
    base = math.log(all_["p"] + size) - math.log(all_["n"] + size) if all_["v"] else 0.0
    weights = counts.select("term", (_log_odds(F.col("p"), F.col("n"), smoothing) - base).alias("weight"))
    prior = math.log(rows["p"] + smoothing) - math.log(rows["n"] + smoothing)
    return WordBayes(materialize(weights, "weights"), prior)


def label_by_words(
    model: WordBayes, df: DataFrame, text: str = "text", output: str = "sentiment"
) -> DataFrame:
    """Add the annotation column to each row with a text.

    Rows are numbered in a copy, so only a number and a word of each token take part in the
    lookup, which is broadcast if the vocabulary is small and salted otherwise. Words that
    were not learnt count for neither label; a tie is negative.
    """
    row = "_row"
    kept = materialize(df.where(F.col(text).isNotNull()).withColumn(row, F.monotonically_increasing_id()), "texts")
    words = explode_tokens(kept, text, row).groupBy(row, "term").agg(F.count(F.lit(1)).alias("times"))
    weighted = lookup_join(words, model.weights, "term", [row])
    sums = weighted.groupBy(row).agg(F.sum(F.col("times") * F.col("weight")).alias("_sum"))
    score = F.round(F.coalesce("_sum", F.lit(0.0)) + model.prior, DIGITS)
    prediction = F.when(score > 0, 1.0).otherwise(0.0)
    return kept.join(sums, row, "left").withColumn(output, label_column(prediction)).drop(row, "_sum")
