"""Review-shaped views over the given tables.

The tables hold no reviews and no NULLs, so the views rename columns and put
NULLs and markup at fixed places, which the cleaning steps then have to remove.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MARKUP_CONDITION = "3</span> users found this comment helpful."


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _dirty_condition(key: str, value: str) -> Column:
    return (
        F.when(F.col(key) % 29 == 0, F.lit(None))
        .when(F.col(key) % 31 == 0, F.lit(MARKUP_CONDITION))
        .otherwise(F.col(value))
    )


def numeric_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One review per line item. ``UniqueID`` is not unique here.

    No join hint: Spark broadcasts the products while they are small by its own
    size estimate and joins by shuffle, with skew handling, beyond that.
    """
    joined = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey")
    )
    stars = 1 + F.floor(F.col("l_discount") * 60).cast("int") + F.col("l_quantity").cast("int") % 4
    return joined.select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("UniqueID"),
        F.col("p_brand").alias("drugName"),
        _dirty_condition("l_partkey", "p_type").alias("condition"),
        F.when(F.col("l_suppkey") % 37 == 0, F.lit(None))
        .otherwise(stars.cast("double"))
        .alias("rating"),
        (F.col("l_orderkey") % 200).cast("int").alias("usefulCount"),
        (F.col("l_discount") * 20 - 1).alias("sentiment"),
        F.col("l_shipdate").alias("review_ts"),
    )


def text_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One review per document; ``UniqueID`` is unique."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("UniqueID"),
        F.col("source").alias("drugName"),
        _dirty_condition("doc_id", "lang").alias("condition"),
        F.col("text").alias("review"),
        (1 + F.col("n_chars") % 10).cast("double").alias("rating"),
        F.format_string(
            "%02d-%02d-2022", 1 + F.col("doc_id") % 12, 1 + F.col("doc_id") % 28
        ).alias("date"),
        (F.col("n_chars") % 200).cast("int").alias("usefulCount"),
    )
