"""Seeded samples and splits that do not depend on partitioning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def seeded_hash(keys: Sequence[str], seed: int) -> Column:
    """Hash of the key columns and a seed as hex text, the same on every engine."""
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]
    return F.md5(F.concat_ws(":", *parts, F.lit(str(seed))))


def sample_n(df: DataFrame, keys: Sequence[str], n: int = 1000, seed: int = 1) -> DataFrame:
    """Exactly ``min(n, rows)`` rows without replacement, the same ones for a seed.

    ``keys`` must identify a row. Each task keeps its ``n`` smallest hashes and
    only those travel; there is no sort of the table.
    """
    return df.orderBy(seeded_hash(keys, seed), *keys).limit(n)


# Leading hex digits of the hash that one pass counts, and hashes brought together at last.
PREFIX, LAST = 4, 10_000


def sample_threshold(hashes: DataFrame, n: int, column: str = "hash") -> str | None:
    """The ``n``-th smallest hash, or None if there are no more than ``n``.

    Each pass counts the values of the next hex digits, 65,536 at most, among the hashes
    that begin with those settled so far.
    """
    settled, before = "", 0
    while True:
        inside = hashes.where(F.col(column).startswith(settled)) if settled else hashes
        digits = F.substring(column, len(settled) + 1, PREFIX)
        counts = sorted(inside.groupBy(digits.alias("d")).agg(F.count(F.lit(1)).alias("n")).collect())
        if before + sum(r["n"] for r in counts) <= n:
            return None
        for r in counts:
            if before + r["n"] >= n:
                break
            before += r["n"]
        settled += r["d"]
        if r["n"] <= LAST or len(settled) >= 32:
            rest = hashes.where(F.col(column).startswith(settled)).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
            for h in sorted(rest.collect()):
                before += h["n"]
                if before >= n:
                    return h[column]


def sample_large(df: DataFrame, keys: Sequence[str], n: int, seed: int = 1) -> DataFrame:
    """The rows of :func:`sample_n`, for samples of any size: a threshold, then a filter.

    The n-th smallest hash is found by counting, so no rows are ordered and the sample does
    not pass through one task. Rows that share the last hash are those of one key; if they
    are too many, the first of them are taken.
    """
    if n < 1:
        return df.limit(0)
    name = "_hash"
    hashed = df.withColumn(name, seeded_hash(keys, seed))
    last = sample_threshold(hashed.select(F.col(name).alias("hash")), n)
    if last is None:
        return df
    kept = hashed.where(F.col(name) <= last)
    spare = kept.count() - n
    if spare:
        ties = kept.where(F.col(name) == last)
        kept = kept.where(F.col(name) < last).unionByName(ties.orderBy(*keys).limit(ties.count() - spare))
    return kept.drop(name)


def with_split(
    df: DataFrame, keys: Sequence[str], holdout: float = 0.25, seed: int = 42,
    name: str = "holdout",
) -> DataFrame:
    """Mark about ``holdout`` of the rows by a hash of their key.

    Rows that share a key fall on the same side, so repeated reviews cannot leak
    from training into evaluation.
    """
    fraction = F.conv(F.substring(seeded_hash(keys, seed), 1, 8), 16, 10).cast("long") / F.lit(
        float(2**32)
    )
    return df.withColumn(name, fraction < holdout)


def holdout_split(
    df: DataFrame, keys: Sequence[str], holdout: float = 0.25, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """Training rows and holdout rows."""
    marked = with_split(df, keys, holdout, seed)
    return marked.where(~F.col("holdout")).drop("holdout"), marked.where("holdout").drop("holdout")
