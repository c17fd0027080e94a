"""Document fingerprints: threshold-scaled sketches, by DataFrame functions only.

A sketch keeps the hash of every run of five words that falls below a fixed fraction of
the hash range. What is kept depends on the run alone, so the sketch of a union is the
union of the sketches, and shares of kept hashes estimate likeness and containment also
between texts of very different lengths. A text of one to four words is one run, a text
without words (null, empty) has none. A fingerprint also has a tag over all runs, which
tells apart texts too short to have kept any.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHINGLE = 5
FRACTION = 4  # one in so many hashes is kept
SPACE = r"[\x20\x09-\x0D]+"

#: Neighbours in id order are found in buckets: so many pieces of equal row counts, cut
#: further into equal id ranges of about ``BUCKET`` rows, at most ``MOST`` in all.
PIECES, BUCKET, MOST = 64, 500, 100_000


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once per row."""
    return F.element_at(F.transform(F.array(value), use), 1)


def run_hashes(text: Column, shingle: int = SHINGLE) -> Column:
    """Distinct hashes of all runs of ``shingle`` words, ascending."""

    def runs(words: Column) -> Column:
        every = F.transform(
            F.sequence(F.lit(0), F.size(words) - shingle),
            lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(shingle))),
        )
        return (
            F.when(F.size(words) >= shingle, F.array_sort(F.array_distinct(every)))
            .when(F.size(words) > 0, F.array(F.xxhash64(words, F.size(words))))
            .otherwise(F.array().cast("array<bigint>"))
        )

    return let(F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), ""), runs)


def sketch(hashes: Column, fraction: int = FRACTION) -> Column:
    """The hashes below the threshold; ascending if they were."""
    if fraction == 1:
        return hashes
    limit = -(1 << 63) + (1 << 64) // fraction
    return F.filter(hashes, lambda h: h < F.lit(limit))


def merge(a: Column, b: Column) -> Column:
    """Sketch of two texts' runs together."""
    return F.array_sort(F.array_union(a, b))


def likeness(a: Column, b: Column) -> Column:
    """Estimated share of common runs among all; 0 if nothing was kept."""
    return let(
        F.size(F.array_intersect(a, b)),
        lambda both: F.coalesce(
            F.try_divide(both.cast("double"), (F.size(a) + F.size(b) - both).cast("double")), F.lit(0.0)
        ),
    )


def containment(a: Column, b: Column) -> Column:
    """Estimated share of the first text's runs that the second has; 0 if none was kept."""
    return F.coalesce(
        F.try_divide(F.size(F.array_intersect(a, b)).cast("double"), F.size(a).cast("double")), F.lit(0.0)
    )


def fingerprint(text: Column, shingle: int = SHINGLE, fraction: int = FRACTION) -> Column:
    """``struct(tag, kept)``."""
    return let(
        run_hashes(text, shingle),
        lambda hashes: F.struct(F.xxhash64(hashes).alias("tag"), sketch(hashes, fraction).alias("kept")),
    )


def as_string(print_: Column) -> Column:
    """The tag, a colon, and the kept hashes, in hexadecimal digits."""
    kept = F.array_join(F.transform(print_["kept"], lambda h: F.hex(h)), ",")
    return F.concat(F.hex(print_["tag"]), F.lit(":"), kept)


def similar(a: Column, b: Column) -> Column:
    """Likeness of two fingerprints: 1 if they are equal, else that of what they kept."""
    return F.when(a["tag"] == b["tag"], F.lit(1.0)).otherwise(likeness(a["kept"], b["kept"]))


def with_next(docs: DataFrame, key: str, tie: str, more: dict[str, Column], columns: list[str]) -> DataFrame:
    """Each row with the columns ``more`` and ``next``, a struct of ``columns`` of the row after it.

    Rows are in descending order of the integer ``key`` (missing ones last), then of
    ``tie``; after the last row comes the first. Rows are dealt out once, by bucket of
    the key; a bucket also gets a copy of the row that follows its last one. The table
    of those rows has a row per bucket, at most ``MOST`` (or ``PIECES``), and is broadcast.
    """
    stats = docs.agg(
        F.count("*").alias("n"),
        F.percentile_approx(key, [i / PIECES for i in range(PIECES + 1)], 10_000).alias("cuts"),
    ).first()
    cuts = sorted(set(stats["cuts"] or [0]))
    per_piece = max(1, min(MOST // PIECES, -(-stats["n"] // (PIECES * BUCKET))))
    lows = F.array(*map(F.lit, cuts))
    widths = F.array(*(F.lit(float(b - a)) for a, b in zip(cuts, [*cuts[1:], cuts[-1] + 1])))
    piece = F.greatest(F.size(F.filter(lows, lambda low: low <= F.col(key))), F.lit(1))
    inside = (F.col(key) - F.element_at(lows, piece)).cast("double") / F.element_at(widths, piece) * per_piece
    bucket = F.when(F.col(key).isNull(), F.lit(-1).cast("long")).otherwise(
        (piece * per_piece + F.least(F.greatest(F.floor(inside), F.lit(0)), F.lit(per_piece - 1))).cast("long")
    )
    put = docs.withColumn("_bucket", bucket)
    order = F.struct(F.col(key).isNotNull(), F.col(key), F.col(tie))
    heads = put.groupBy("_bucket").agg(F.max(order).alias("_head"))
    # The bucket before in the order of rows, or the last one for the first.
    down = Window.orderBy(F.desc("_bucket"))
    links = heads.select(
        F.coalesce(F.lag("_bucket").over(down), F.min("_bucket").over(Window.partitionBy())).alias("_to"),
        F.col("_head"),
    )
    copies = (
        put.withColumn("_order", order)
        .join(F.broadcast(links), F.col("_order") == F.col("_head"))
        .select(*put.columns[:-1], F.col("_to").alias("_bucket"), F.lit(True).alias("_copy"))
    )
    # Dealt out before the further columns are made, so that these are not shuffled.
    both = put.withColumn("_copy", F.lit(False)).unionByName(copies).repartition("_bucket").withColumns(more)
    turn = Window.partitionBy("_bucket").orderBy("_copy", F.desc_nulls_last(key), F.desc(tie))
    return (
        both.withColumn("next", F.lead(F.struct(*columns)).over(turn)).where(~F.col("_copy")).drop("_bucket", "_copy")
    )


def edited(text: Column, following: Column) -> Column:
    """The text whose last half is replaced by as many (or all) first characters of another."""
    half = F.floor(F.char_length(text) / 2).cast("int")
    return F.concat(F.left(text, F.char_length(text) - half), F.left(following, half))
