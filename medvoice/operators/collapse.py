"""Rows collapsed to weighted cells of binned features, so that a fit does not grow with them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medvoice.operators.quantiles import cut_points

BINS = 64
# Parts a cell's weight is cut into, as a forest draws rows and not weights.
PIECES = 16
WEIGHT = "weight"


def collapse(
    df: DataFrame, features: Sequence[str], label: str, bins: int = BINS, pieces: int = PIECES
) -> DataFrame:
    """``(features, label, weight, piece)``: rows of one cell and label as one value with their number.

    Features are cut at the values that divide the rows into ``bins`` about equal parts; a
    cell is a combination of parts, and stands at the middle of what its rows hold. Cuts
    and cells depend on the rows alone. One shuffle of at most a row per cell, label and
    task; a cell of n rows becomes up to ``pieces`` rows that share its weight.
    """
    used = df.select(*[F.col(f).cast("double").alias(f) for f in features], label)
    cell = [f"_{f}_bin" for f in features]
    for f, name in zip(features, cell):
        cuts = cut_points(used, f, bins)
        splits = [-float("inf"), *cuts, float("inf")]
        used = Bucketizer(splits=splits, inputCol=f, outputCol=name, handleInvalid="error").transform(used)
    middle = [((F.min(f) + F.max(f)) / 2).alias(f) for f in features]
    cells = used.groupBy(*cell, label).agg(F.count(F.lit(1)).alias("_n"), *middle)
    share = F.least(F.col("_n"), F.lit(pieces)).cast("int")
    return cells.select(
        *features, label, (F.col("_n") / share).alias(WEIGHT), F.explode(F.sequence(F.lit(1), share)).alias("piece")
    )
