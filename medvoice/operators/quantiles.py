"""Exact order statistics by narrowing histograms: no sort, no shuffle of values."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

QUARTILES = (0.25, 0.5, 0.75)
# Cells a range is cut into by one pass, and values that are brought together in the end.
CELLS = 1024
KEEP = 20_000
# Beyond this ratio of its ends a range is cut by logarithm.
WIDE = 1e6


@dataclass
class Range:
    """Values from ``low`` to ``high``; ``before`` rows have smaller ones, ``n`` lie inside."""

    low: float
    high: float
    before: int
    n: int

    def holds(self, rank: int) -> bool:
        return self.before <= rank < self.before + self.n

    @property
    def by_log(self) -> bool:
        small, large = sorted((abs(self.low), abs(self.high)))
        return self.low * self.high > 0 and large / small > WIDE


def _finite(value: Column) -> Column:
    return ~F.isnan(value) & (F.abs(value) != F.lit(math.inf))


def _pick(values: Sequence[float], number: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), number)


def _cell(value: Column, number: Column, ranges: Sequence[Range], cells: int) -> Column:
    """Cell of a value in its range: a function that never falls as the value rises."""
    low, high = (_pick([getattr(r, end) for r in ranges], number) for end in ("low", "high"))
    # Halves, as the width of a range may exceed the largest number.
    part = F.try_divide(value / 2 - low / 2, high / 2 - low / 2)
    if any(r.by_log for r in ranges):
        start, end = F.log(F.abs(low)), F.log(F.abs(high))
        logged = F.try_divide(F.log(F.abs(value)) - start, end - start)
        part = F.when(_pick([r.by_log for r in ranges], number), logged).otherwise(part)
    return F.least(F.floor(F.coalesce(part, F.lit(0.0)) * cells), F.lit(cells - 1)).cast("int")


def _numbered(values: DataFrame, ranges: Sequence[Range]) -> DataFrame:
    """The values that lie in a range, with its number; ranges do not overlap."""
    number = F.lit(None).cast("int")
    for i, r in enumerate(ranges):
        number = F.when(F.col("v").between(r.low, r.high), i).otherwise(number)
    return values.select("v", number.alias("range")).where("range IS NOT NULL")


def ordered_values(
    df: DataFrame,
    column: str,
    ranks: Sequence[int] | None = None,
    probabilities: Sequence[float] = (),
    cells: int = CELLS,
    keep: int = KEEP,
    slack: float = 0.0,
) -> tuple[int, dict[int, float]]:
    """Number of non-NULL values, and the values at the wanted ranks, 0 being the smallest.

    Each pass counts the cells of the ranges that hold a wanted rank, and narrows them to
    the cells that hold it. A range is done when it has a single value, or so few rows that
    its distinct values can be brought together: ``keep`` over all ranges. So a task keeps
    counters only, no value is ordered, and nothing is shuffled but a row per cell and task.

    With ``slack`` a range is also done when it has no more than that part of all rows; the
    largest value in it stands for the wanted one. Results depend on the values alone.
    Infinite values and NaN (the largest) are counted apart. ``probabilities`` add the
    ranks on both sides of those parts of the way from the first to the last.
    """
    values = df.select(F.col(column).cast("double").alias("v")).where(F.col("v").isNotNull())
    v, finite = F.col("v"), _finite(F.col("v"))
    first = values.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(v == -math.inf).alias("least"),
        F.count_if(finite).alias("finite"),
        F.count_if(v == math.inf).alias("most"),
        *[
            measure
            for name, side in (("below", finite & (v < 0)), ("zero", v == 0), ("above", finite & (v > 0)))
            for measure in (
                F.count_if(side).alias(name),
                F.min(F.when(side, v)).alias(f"{name}_low"),
                F.max(F.when(side, v)).alias(f"{name}_high"),
            )
        ],
    ).first()
    total = first["n"]
    wanted = set(ranks or [])
    for p in probabilities:
        wanted |= {math.floor(p * (total - 1)), math.ceil(p * (total - 1))}
    wanted = sorted(r for r in wanted if 0 <= r < total)
    found: dict[int, float] = {}
    for r in wanted:
        if r < first["least"]:
            found[r] = -math.inf
        elif r >= first["least"] + first["finite"]:
            found[r] = math.inf if r < total - (total - first["least"] - first["finite"] - first["most"]) else math.nan
    # A range has one sign, so that it can be cut by logarithm.
    ranges, before = [], first["least"]
    for name in ("below", "zero", "above"):
        if first[name]:
            ranges.append(Range(first[f"{name}_low"], first[f"{name}_high"], before, first[name]))
            before += first[name]
    values = values.where(_finite(F.col("v")))
    small: list[Range] = []
    tried: list[Range] = []
    while True:
        open_ = []
        for r in ranges:
            inside = [rank for rank in wanted if r.holds(rank)]
            if not inside:
                continue
            if r.low == r.high or r.n <= slack * total:
                found.update((rank, r.high) for rank in inside)
            elif r.n <= keep // max(1, len(wanted)) or r in tried:
                small.append(r)  # or values so near each other that no cut tells them apart
            else:
                open_.append(r)
        if not open_:
            break
        tried, numbered = open_, _numbered(values, open_)
        counted = (
            numbered.groupBy("range", _cell(F.col("v"), F.col("range"), open_, cells).alias("cell"))
            .agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
            .collect()
        )
        ranges = []
        for i, r in enumerate(open_):
            before = r.before
            for row in sorted((c for c in counted if c["range"] == i), key=lambda c: c["cell"]):
                ranges.append(Range(row["low"], row["high"], before, row["n"]))
                before += row["n"]
    if small:
        rows = _numbered(values, small).groupBy("range", "v").agg(F.count(F.lit(1)).alias("n")).collect()
        for i, r in enumerate(small):
            before = r.before
            for row in sorted((x for x in rows if x["range"] == i), key=lambda x: x["v"]):
                found.update((k, row["v"]) for k in wanted if before <= k < before + row["n"])
                before += row["n"]
    return total, found


def exact_quantiles(
    df: DataFrame,
    column: str,
    probabilities: Sequence[float] = QUARTILES,
    cells: int = CELLS,
    keep: int = KEEP,
) -> list[float | None]:
    """Linearly interpolated quantiles, NULLs left out; without values they are None."""
    total, at = ordered_values(df, column, probabilities=probabilities, cells=cells, keep=keep)
    if not total:
        return [None] * len(probabilities)
    out = []
    for p in probabilities:
        place = p * (total - 1)
        low, high = at[math.floor(place)], at[math.ceil(place)]
        out.append(low if low == high else low + (high - low) * (place - math.floor(place)))
    return out


def cut_points(df: DataFrame, column: str, bins: int) -> list[float]:
    """At most ``bins - 1`` values that cut the rows into parts of about equal size.

    The same for the same values, however they are dealt out. A part is off by less than
    half its size unless a single value fills it.
    """
    total = df.where(F.col(column).isNotNull()).count()
    ranks = sorted({i * total // bins for i in range(1, bins)})
    return sorted(set(ordered_values(df, column, ranks, slack=0.5 / bins)[1].values()))


def describe(df: DataFrame, column: str) -> DataFrame:
    """Count, mean, deviation, extremes and exact interpolated quartiles, in one row."""
    value = F.col(column)
    basic = df.agg(
        F.count(value).alias("count"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("stddev"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    )
    quartiles = [F.lit(q).cast("double").alias(n) for q, n in zip(exact_quantiles(df, column), ("q25", "q50", "q75"))]
    return basic.select("count", "mean", "stddev", "min", *quartiles, "max")
