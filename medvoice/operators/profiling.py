"""Grouped profiles of review tables.

All group-bys use algebraic aggregates, so a hot key is reduced inside each task
before the shuffle and costs one partial row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the two product reports.
MIN_USEFUL = 100
TOP_CONDITIONS = 5
# Columns a crosstab may get from looked-up values.
MAX_CROSSTAB_COLUMNS = 1000


def rating_histogram(df: DataFrame, ordered: bool = True) -> DataFrame:
    """Rows per rating, highest rating first."""
    counts = df.groupBy("rating").agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("rating")) if ordered else counts


def avg_rating_by(df: DataFrame, key: str) -> DataFrame:
    """Mean rating and number of reviews per key, most reviewed first."""
    return (
        df.groupBy(key)
        .agg(F.avg("rating").alias("avg_rating"), F.count(key).alias("n"))
        .orderBy(F.desc("n"), F.asc(key))
    )


def rating_percent(df: DataFrame) -> DataFrame:
    """Share of each rating in percent of all rows, rows without rating included."""
    counts = df.groupBy("rating").agg(
        F.count(F.lit(1)).alias("rows"), F.count("rating").alias("n")
    )
    # Both uses of the counts need both columns, so the second one reuses the
    # shuffle of the first instead of reading the table again.
    total = counts.where(F.col("n") >= 0).agg(F.sum("rows")).scalar()
    return counts.where(F.col("n") > 0).select(
        "rating", (F.lit(100.0) * F.col("rows") / total).alias("percent")
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Frequency of each non-NULL value, most frequent first, ties by value."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), F.asc(column))
    )


def top_conditions(df: DataFrame, k: int = TOP_CONDITIONS) -> DataFrame:
    """The ``k`` most frequent conditions."""
    return value_counts(df, "condition").limit(k)


def crosstab(
    df: DataFrame, row: str, column: str, values: Sequence[float | int | str] | None = None,
    always: Sequence[float | int | str] = (),
) -> DataFrame:
    """Contingency counts: one row per ``row`` value, one column per ``column`` value.

    NULL keys are left out and an absent pair counts 0. One conditional count per
    value needs a single shuffle; a pivot would need two. Give ``values`` when
    they are known, or only some are wanted; otherwise they are looked up first, and
    those in ``always`` are added.
    """
    kept = df.where(F.col(row).isNotNull() & F.col(column).isNotNull())
    if values is None:
        head = kept.select(column).distinct().limit(MAX_CROSSTAB_COLUMNS + 1).collect()
        if len(head) > MAX_CROSSTAB_COLUMNS:
            raise ValueError(
                f"{column} has over {MAX_CROSSTAB_COLUMNS} values; crosstab_long has no such bound"
            )
        values = sorted({*(r[0] for r in head), *always})
    else:
        kept = kept.where(F.col(column).isin(list(values)))
    if not values:
        return kept.select(row).distinct()
    return kept.groupBy(row).agg(
        *[F.count_if(F.col(column) == F.lit(v)).alias(_label(v)) for v in values]
    )


def crosstab_long(df: DataFrame, row: str, column: str) -> DataFrame:
    """The contingency table as ``(row, column, n)``, for any number of values."""
    return (
        df.where(F.col(row).isNotNull() & F.col(column).isNotNull())
        .groupBy(row, column)
        .agg(F.count(F.lit(1)).alias("n"))
    )


def top_drugs(
    df: DataFrame,
    condition: str,
    min_rating: float,
    inclusive: bool,
    min_useful: int = MIN_USEFUL,
    always: Sequence[float] = (),
) -> DataFrame:
    """Product x rating counts for well rated, useful reviews of one condition.

    Every rating that occurs gets its column, also one between whole numbers; those in
    ``always`` get one in any case.
    """
    rating = F.col("rating")
    bound = (rating >= min_rating) if inclusive else (rating > min_rating)
    kept = df.where(
        (F.col("condition") == condition) & bound & (F.col("usefulCount") >= min_useful)
    )
    return crosstab(kept, "drugName", "rating", always=always)


def summary(df: DataFrame, column: str, accuracy: int = 10_000) -> DataFrame:
    """Count, mean, deviation, extremes and approximate quartiles, in one row.

    The quartile sketch merges across tasks; its rank error is at most
    ``rows / accuracy``.
    """
    value = F.col(column)
    quartiles = F.percentile_approx(value, [0.25, 0.5, 0.75], accuracy)
    return df.agg(
        F.count(value).alias("count"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("stddev"),
        F.min(value).alias("min"),
        quartiles.alias("q"),
        F.max(value).alias("max"),
    ).select(
        "count", "mean", "stddev", "min",
        F.get("q", F.lit(0)).alias("q25"),
        F.get("q", F.lit(1)).alias("q50"),
        F.get("q", F.lit(2)).alias("q75"),
        "max",
    )


def rmse(label: Column | str, prediction: Column | str) -> Column:
    """Root mean squared error as an aggregate expression."""
    label = F.col(label) if isinstance(label, str) else label
    prediction = F.col(prediction) if isinstance(prediction, str) else prediction
    difference = label - prediction
    return F.sqrt(F.avg(difference * difference))


def rmse_rounded(label: Column | str, prediction: Column | str) -> Column:
    """RMSE against the prediction rounded to the nearest integer, halves to even."""
    return rmse(label, F.rint(prediction))


def _label(value: float | int | str) -> str:
    """Column name of a crosstab value: 8.0 -> ``r8``, 7.5 -> ``r7_5``."""
    if isinstance(value, float) and value.is_integer():
        value = int(value)
    return "r" + str(value).replace(".", "_")
