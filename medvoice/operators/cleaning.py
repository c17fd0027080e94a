"""Cleaning of review tables and the audit counts around it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

# Fixed value: left-over markup that marks a broken condition field.
MARKUP = "</span>"


def drop_null_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Keep rows without a NULL in the given columns (default: in any)."""
    return df.dropna(subset=list(columns) if columns is not None else None)


def drop_markup_conditions(df: DataFrame, column: str = "condition") -> DataFrame:
    """Keep rows whose condition is present and free of markup."""
    return df.where(~F.col(column).contains(MARKUP))


def clean_reviews(df: DataFrame) -> DataFrame:
    """Rows without NULLs and without markup in the condition. Narrow: no shuffle."""
    return drop_markup_conditions(drop_null_rows(df))


def _stages(df: DataFrame) -> list[Column]:
    complete = F.lit(True)
    for name in df.columns:
        complete = complete & F.col(name).isNotNull()
    clean = complete & ~F.col("condition").contains(MARKUP)
    return [
        F.count(F.lit(1)).alias("raw"),
        F.count_if(complete).alias("no_nulls"),
        F.count_if(clean).alias("clean"),
    ]


def observed(df: DataFrame, observation: Observation) -> DataFrame:
    """The same rows; the job that uses them leaves its :func:`stage_counts` in the observation.

    The counts are made by the tasks that read the rows anyway: there is no other pass.
    ``observation.get`` waits for the first job over the result to end.
    """
    return df.observe(observation, *_stages(df))


def stage_counts(df: DataFrame) -> DataFrame:
    """Rows before cleaning, after the NULL filter and after both: one scan for all."""
    counts = df.agg(*_stages(df))
    return counts.select(
        F.stack(
            F.lit(3),
            F.lit("raw"), F.col("raw"),
            F.lit("no_nulls"), F.col("no_nulls"),
            F.lit("clean"), F.col("clean"),
        ).alias("stage", "n")
    )
