"""Summaries that can be stored and merged: per file, month or batch, and later over any of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from medvoice.operators.profiling import value_counts

# Size of a quantile sketch; its rank error is about 1.7 / size of the rows, 0.4 % here.
SKETCH = 400
QUARTILES = (0.25, 0.5, 0.75)
#: Values a frequency sketch follows.
TRACKED = 10_000


def summary_parts(df: DataFrame, column: str, by: Sequence[str] = (), size: int = SKETCH) -> DataFrame:
    """One row per group: count, mean, sum of squared deviations, extremes, quantile sketch.

    A part has a bounded size whatever its number of rows, and can be written and merged
    later with parts of other tables.
    """
    value = F.col(column).cast("double")
    return df.where(value.isNotNull()).groupBy(*by).agg(
        F.count(value).alias("count"),
        F.avg(value).alias("mean"),
        (F.var_pop(value) * F.count(value)).alias("m2"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
        F.kll_sketch_agg_double(value, size).alias("sketch"),
    )


def merged_parts(parts: DataFrame, by: Sequence[str] = (), size: int = SKETCH) -> DataFrame:
    """Parts of the same group as one part."""
    # Deviations of the parts' means from the group's mean are added to those inside them.
    group = Window.partitionBy(*(by or [F.lit(0)]))
    mean = F.sum(F.col("count") * F.col("mean")).over(group) / F.sum("count").over(group)
    centred = parts.withColumn("_mean", mean)
    off = F.col("mean") - F.col("_mean")
    return centred.groupBy(*by).agg(
        F.sum("count").alias("count"),
        F.max("_mean").alias("mean"),
        F.sum(F.col("m2") + F.col("count") * off * off).alias("m2"),
        F.min("min").alias("min"),
        F.max("max").alias("max"),
        F.kll_merge_agg_double("sketch", size).alias("sketch"),
    )


def summary_of(parts: DataFrame) -> DataFrame:
    """The columns of :func:`medvoice.operators.profiling.summary` for each part."""
    fixed = ("count", "mean", "m2", "min", "max", "sketch")
    quartile = [F.kll_sketch_get_quantile_double("sketch", F.lit(q)).alias(f"q{round(100 * q)}") for q in QUARTILES]
    deviation = F.when(F.col("count") > 1, F.sqrt(F.col("m2") / (F.col("count") - 1)))
    return parts.select(
        *[c for c in parts.columns if c not in fixed], "count", "mean", deviation.alias("stddev"), "min", *quartile, "max"
    )


def top_values(df: DataFrame, column: str, k: int, tracked: int = TRACKED) -> DataFrame:
    """The ``k`` most frequent values, as ``value_counts(df, column).limit(k)`` gives them.

    A frequency sketch of bounded size names candidates, which one more pass counts
    exactly. The sketch tells how often a value that it does not name may occur at most;
    if the k-th candidate is not more frequent than that, as with values that are all
    about equally frequent, all values are counted after all.
    """
    known = df.where(F.col(column).isNotNull())
    named = known.select(F.col(column).alias("v")).agg(
        F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(v, {tracked}, {tracked})").alias("top")
    ).first()
    top = named["top"] or []
    # The sketch has 4/3 of the tracked places or more, and errs by 3.5 rows in that many; it
    # leaves out values of up to twice its error. Counts that add up mean that none is left out.
    whole = sum(t["count"] for t in top) == named["n"]
    unseen = 0 if whole else int(2 * 3.5 * named["n"] / (tracked / 0.75)) + 1
    if not whole and len(top) > 4 * k:
        floor = top[4 * k]["count"]
        unseen, top = max(unseen, floor), top[: 4 * k]
    if whole:
        top = [t for t in top if t["count"] >= (top[k - 1]["count"] if len(top) >= k else 0)]
    candidates = [t["item"] for t in top]
    exact = known.where(F.col(column).isin(candidates))
    counted = value_counts(exact, column).limit(k).collect()
    if whole or (len(counted) == k and counted[-1]["n"] > unseen):
        schema = exact.select(column, F.lit(0).cast("long").alias("n")).schema
        return df.sparkSession.createDataFrame(counted, schema)
    return value_counts(df, column).limit(k)
