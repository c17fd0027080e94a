"""Frequency ranks of the labels of a text column, as a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from medvoice.operators.joins import lookup_join
from medvoice.workspace import materialize


def label_ranks(df: DataFrame, column: str = "condition") -> DataFrame:
    """The same index as a table ``(label, index)``, for any number of labels.

    Labels are counted, sorted across tasks and written, so that each one's place
    in its part is settled; adding the sizes of the parts before gives the index.
    The table of parts has one row per task of the sort.
    """
    index = f"{column}_idx"
    counts = (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), F.asc(column))
    )
    # The id holds the part above bit 33 and the place in the part below it.
    placed = materialize(counts.select(column, F.monotonically_increasing_id().alias("id")), "ranks")
    part = F.shiftright("id", 33)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(part.alias("part"))
        .agg(F.count(F.lit(1)).alias("size"))
        .select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"))
    )
    place = F.col("id").bitwiseAND((1 << 33) - 1)
    return (
        placed.withColumn("part", part)
        .join(F.broadcast(offsets), "part")
        .select(column, (F.col("offset") + place).cast("double").alias(index))
    )


def index_by_ranks(df: DataFrame, ranks: DataFrame, column: str = "condition") -> DataFrame:
    """Add the index from such a table; rows with an unknown or NULL label are left out."""
    others = [c for c in df.columns if c != column] or [F.monotonically_increasing_id()]
    return lookup_join(df, ranks, column, others)
