"""Batch extraction: raw review files -> cleaned, scored review table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession

from medvoice.functions.lexicon import LEXICON
from medvoice.operators.cleaning import clean_reviews, observed
from medvoice.operators.polarity import score_reviews
from medvoice.sources.files import read_reviews_tsv, write_scored_csv


def extract(
    raw: DataFrame, lexicon: Mapping[str, float] | DataFrame = LEXICON
) -> DataFrame:
    """Clean and score. One narrow stage: no shuffle, no collect, one read."""
    return score_reviews(clean_reviews(raw), lexicon)


def run(
    spark: SparkSession,
    raw_path: str,
    scored_path: str,
    lexicon: Mapping[str, float] | DataFrame = LEXICON,
    file_format: str = "csv",
    max_records_per_file: int | None = 1_000_000,
    split: bool = False,
) -> dict[str, int]:
    """Read raw files, write the scored table; rows read, without NULLs, and clean.

    The counts come from the one job that writes.

    ``csv`` is the exchange format; ``parquet`` is the one to train from on a
    cluster, since it is splittable and read by column. ``split`` reads large raw files
    by a task per block.
    """
    counts = Observation("extract")
    raw = observed(read_reviews_tsv(spark, raw_path, split=split), counts)
    scored = extract(raw, lexicon)
    if file_format == "csv":
        write_scored_csv(scored, scored_path, max_records_per_file)
    else:
        scored.write.mode("overwrite").format(file_format).save(scored_path)
    return counts.get
