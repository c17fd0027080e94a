"""The exploratory reports over one review table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from medvoice.functions.columns import review_sent
from medvoice.functions.lexicon import STOPWORDS
from medvoice.operators import profiling as P
from medvoice.operators.cleaning import stage_counts
from medvoice.operators.terms import MAX_TERMS, cloud_of_pairs, cloud_terms, weighted_values, word_pairs
from medvoice.workspace import materialize

# The two product reports, (condition, rating bound, bound included).
PRODUCT_REPORTS: Mapping[str, tuple[str, float, bool]] = {
    "top_birth_control": ("Birth Control", 7.0, False),
    "top_depression": ("Depression", 9.0, True),
}


def reports(
    df: DataFrame,
    product_reports: Mapping[str, tuple[str, float, bool]] = PRODUCT_REPORTS,
    stopwords: Sequence[str] = STOPWORDS,
    max_terms: int | None = MAX_TERMS,
) -> dict[str, DataFrame]:
    """Each report as a table, by name.

    The review texts are read once for all three review clouds: pairs of words are
    counted apart by label and written.
    """
    labelled = df.withColumn("label", review_sent("rating"))
    pairs = materialize(word_pairs(labelled, "review", stopwords, ["label"]), "pairs")
    result = {
        "stage_counts": stage_counts(df),
        "rating_histogram": P.rating_histogram(df),
        "avg_rating_by_condition": P.avg_rating_by(df, "condition"),
        "avg_rating_by_drug": P.avg_rating_by(df, "drugName"),
        "rating_percent": P.rating_percent(df),
        "top_conditions": P.top_conditions(df),
        "drug_name_cloud": cloud_terms(
            weighted_values(df, "drugName"), "drugName", stopwords, max_terms, weight="weight"
        ),
        "review_cloud": cloud_of_pairs(pairs, max_terms),
        "negative_cloud": cloud_of_pairs(pairs.where("label = 0"), max_terms),
        "positive_cloud": cloud_of_pairs(pairs.where("label = 1"), max_terms),
    }
    for name, (condition, bound, inclusive) in product_reports.items():
        result[name] = P.top_drugs(df, condition, bound, inclusive)
    return result
