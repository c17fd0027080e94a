"""Joins that stay even when one key holds a large part of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A lookup of at most this many rows and bytes of keys is broadcast; a larger one is shuffled.
MAX_BROADCAST_ROWS = 500_000
MAX_BROADCAST_BYTES = 32 << 20
# Tasks a single hot key is spread over in a shuffled lookup.
SALTS = 16


def lookup_join(
    rows: DataFrame, lookup: DataFrame, on: str, spread_by: Sequence[str] | None = None, how: str = "inner"
) -> DataFrame:
    """Join of ``rows`` with a narrow table that has each value of ``on`` once.

    The lookup is broadcast if counting shows that it is within the bound, else
    the join is salted. ``lookup`` should be a stored table, as it is counted first.
    ``how`` is inner, or left to keep the rows without a match.
    """
    size = (
        lookup.limit(MAX_BROADCAST_ROWS + 1)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.coalesce(F.sum(F.octet_length(F.col(on).cast("string"))), F.lit(0)).alias("bytes"),
        )
        .first()
    )
    if size["n"] <= MAX_BROADCAST_ROWS and size["bytes"] <= MAX_BROADCAST_BYTES:
        return rows.join(F.broadcast(lookup), on, how)
    return salted_join(rows, lookup, on, spread_by or _hashable(rows, on), how=how)


def _hashable(rows: DataFrame, on: str) -> list:
    """Columns that tell rows of one key apart; vectors and maps have no hash."""
    plain = ("vector", "map", "variant")
    return [c for c, kind in rows.dtypes if c != on and not any(p in kind for p in plain)] or [F.rand(1)]


def salted_join(
    rows: DataFrame,
    lookup: DataFrame,
    on: str,
    spread_by: Sequence[str],
    salts: int = SALTS,
    how: str = "inner",
) -> DataFrame:
    """The same join by shuffle.

    Each row gets a salt from its ``spread_by`` columns, the lookup is repeated
    once per salt, and both meet on key and salt: a hot key then fills ``salts``
    tasks instead of one, and no row is left out.
    """
    salted = rows.withColumn(
        "_salt", F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int")
    )
    copies = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(copies.hint("merge"), [on, "_salt"], how).drop("_salt")
