"""Mixing sources to target weights.

The words of a source are one long row, its documents in a fixed pseudorandom order, cut
into blocks of ``block`` words (the last one may be shorter). The mix is a number of
output shards of about ``shard`` slots. A source has as many slots as its target needs, to the nearest
block; a multinomial draw says how many of them each shard gets, so a shard's mixture is
random and the whole is not. The slots of a source are numbered through all shards. Slot j goes to block
``permutation(j mod blocks)``, with another permutation for every time round, so each
block is taken once before any is taken again. Slots and blocks meet in a join by index.

Targets: source s has a share of all words in proportion to its weight, but at most
``limit`` times its own words; what is cut off is shared among the others by weight until
none is above. No block is taken more than ``limit`` times.

Null and empty texts have size 0. Sources are in code point order, a null source is a
source of its own and comes last. Rows are told apart by their place in the row of
words, so repeated ids and equal rows are mixed as separate documents. Same input, same
mix: order, draws and permutations depend on ids, texts and the seed alone.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medvoice.llm.arrays import mix
from medvoice.llm.frames import stored

BLOCK = 64
SHARD = 1 << 14
LIMIT = 3
#: Slots made by one task, about.
TASK = 500_000
SEED = 20240607
#: Documents of one source that share a packing bucket, about.
BUCKET = 2_000
WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def by_turns(*weights: float) -> Callable[[Column], Column]:
    """Weights given to sources in turn, by their number from 1."""
    return lambda number: F.element_at(F.array(*map(F.lit, weights)), ((number - 1) % len(weights) + 1).cast("int"))


def targets(sizes: DataFrame, weight_of: Callable[[Column], Column], limit: float = LIMIT) -> DataFrame:
    """``sizes`` (``source, source_size`` and more, a row per source) with ``number, target``.

    Works on the table of sources only. Sources are filled in order of limit to weight:
    one is at its limit if its share of what those before it leave over would pass it,
    and no later one can be once one is not.
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    every = Window.partitionBy()
    up = Window.orderBy(F.col("ratio"), F.col("number"))
    before = up.rowsBetween(Window.unboundedPreceding, -1)
    return (
        sizes.withColumn("number", F.row_number().over(order))
        .withColumn("weight", weight_of(F.col("number")).cast("double"))
        .withColumn("cap", (limit * F.col("source_size")).cast("double"))
        .withColumn("ratio", F.col("cap") / F.col("weight"))
        .withColumn("left", F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        .withColumn("weights", F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        .withColumn("full", F.col("left") * F.col("weight") >= F.col("cap") * F.col("weights"))
        .withColumn(
            "level",
            F.min_by(
                F.when(~F.col("full"), F.col("left") / F.col("weights")),
                F.when(~F.col("full"), F.struct("ratio", "number")),
            ).over(every),
        )
        .withColumn("target", F.when(F.col("full"), F.col("cap")).otherwise(F.col("weight") * F.col("level")))
        .drop("weight", "cap", "ratio", "left", "weights", "full", "level")
    )


def permutation(index: np.ndarray, n: int, key: int, rounds: int = 4) -> np.ndarray:
    """A pseudorandom permutation of the numbers below n.

    A Feistel network permutes the numbers below the smallest power of four that is not
    less than n; results of n or more go through it again until they are below n.
    """
    half = np.uint64(max(1, (max(n - 1, 1).bit_length() + 1) // 2))
    mask = np.uint64((1 << int(half)) - 1)
    out = index.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        x = out[todo]
        left, right = x >> half, x & mask
        for r in range(rounds):
            salt = np.uint64((key * 0x9E3779B97F4A7C15 + r * 0xD6E8FEB86659FD93) & (1 << 64) - 1)
            left, right = right, left ^ (mix(right + salt) & mask)
        out[todo] = (left << half) | right
        todo = todo[out[todo] >= n]
    return out.astype(np.int64)


def _drawn(frames: Iterator[pd.DataFrame], shards: int, seed: int) -> Iterator[pd.DataFrame]:
    """How many slots each shard gets of a source, and the number of the first."""
    for frame in frames:
        for row in frame.itertuples():
            counts = np.random.default_rng([seed, row.number]).multinomial(row.slots, np.full(shards, 1.0 / shards))
            base = np.cumsum(counts) - counts
            some = np.flatnonzero(counts)
            yield pd.DataFrame(
                {"number": row.number, "blocks": row.blocks, "shard": some, "base": base[some], "n": counts[some]}
            )


def _slots(frames: Iterator[pd.DataFrame], seed: int) -> Iterator[pd.DataFrame]:
    """The block of each slot of a source in a shard."""
    for frame in frames:
        for row in frame.itertuples():
            slot = np.arange(row.base, row.base + row.n)
            turn, place = slot // row.blocks, slot % row.blocks
            block = np.empty(len(slot), dtype=np.int64)
            for t in np.unique(turn):
                this = turn == t
                block[this] = permutation(place[this], row.blocks, (seed << 40) + (row.number << 16) + int(t))
            yield pd.DataFrame({"shard": row.shard, "number": row.number, "slot": slot, "block": block})


class Mix:
    """The mix of a table of documents; its parts are tables below the shared folder."""

    def __init__(
        self,
        docs: DataFrame,
        text: str = "text",
        doc_id: str = "doc_id",
        source: str = "source",
        weight_of: Callable[[Column], Column] = by_turns(1, 2, 3),
        block: int = BLOCK,
        shard: int = SHARD,
        limit: int = LIMIT,
        seed: int = SEED,
    ):
        self.block = block
        sized = stored(
            docs.select(
                F.col(source).cast("string").alias("source"),
                F.col(doc_id).alias("id"),
                F.xxhash64(text).alias("mark"),
                n_words(text).alias("size"),
            ),
            "sized",
        )
        totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"))
        blocks = F.ceil(F.col("source_size") / block).cast("long")
        #: A row per source: its number, size, target, blocks and slots.
        self.sources = stored(
            targets(totals, weight_of, limit)
            .withColumn("blocks", blocks)
            .withColumn(
                "slots",
                F.when(F.col("source_size") == 0, 0).otherwise(
                    F.least(F.rint(F.col("target") * F.col("blocks") / F.col("source_size")), limit * F.col("blocks"))
                ).cast("long"),
            ),
            "sources",
        )
        slots = self.sources.agg(F.sum("slots")).first()[0] or 0
        shards = max(1, -(-slots // shard))
        #: ``(shard, number, slot, block)``: what each output shard is made of.
        self.slots = (
            self.sources.where("slots > 0")
            .select("number", "blocks", "slots")
            .mapInPandas(
                lambda frames: _drawn(frames, shards, seed), "number int, blocks long, shard long, base long, n long"
            )
            .repartition(max(1, -(-slots // TASK)), "number", "shard")
            .mapInPandas(lambda frames: _slots(frames, seed), "shard long, number int, slot long, block long")
        )
        known = sized.join(
            self.sources.select(F.col("source").alias("_s"), "number", "source_size", "target", "docs"),
            F.col("source").eqNullSafe(F.col("_s")),
        ).withColumn("order", F.xxhash64("id", "mark", F.lit(seed)))
        packed = known.withColumn("bucket", F.pmod("order", F.ceil(F.col("docs") / BUCKET)).cast("long"))
        inside = Window.partitionBy("number", "bucket").orderBy("order", "id", "mark")
        past = Window.partitionBy("number").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        bases = (
            packed.groupBy("number", "bucket")
            .agg(F.sum("size").alias("bucket_size"))
            .select("number", "bucket", F.coalesce(F.sum("bucket_size").over(past), F.lit(0)).alias("base"))
        )
        #: Where each document lies in the row of words of its source.
        self.places = (
            packed.withColumn(
                "at",
                F.coalesce(F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
            )
            .join(bases.hint("merge"), ["number", "bucket"])
            .withColumn("at", F.col("at") + F.col("base"))
            .select("id", "mark", "source", "number", "size", "source_size", "target", "at")
        )

    def blocks_of_docs(self) -> DataFrame:
        """``(number, block, at, words)``: how many words of a block a document fills."""
        first, last = F.expr(f"at div {self.block}"), F.expr(f"(at + size - 1) div {self.block}")
        low = F.col("block") * self.block
        return (
            self.places.where("size > 0")
            .withColumn("block", F.explode(F.sequence(first, last)))
            .select(
                "number",
                "block",
                "at",
                (F.least(F.col("at") + F.col("size"), low + self.block) - F.greatest("at", low)).alias("words"),
            )
        )

    def taken(self) -> DataFrame:
        """``(id, mark, source, size, source_size, target, taken)`` for every document.

        The joins by block and place are merge joins: their sides grow with the words,
        and are made by functions whose output size Spark cannot foresee.
        """
        times = self.slots.groupBy("number", "block").agg(F.count("*").alias("times"))
        used = (
            self.blocks_of_docs()
            .join(times.hint("merge"), ["number", "block"])
            .groupBy("number", "at")
            .agg(F.sum(F.col("words") * F.col("times")).alias("taken"))
            .withColumn("filled", F.lit(True))
        )
        return (
            self.places.withColumn("filled", F.col("size") > 0)
            .join(used.hint("merge"), ["number", "at", "filled"], "left")
            .select(
                "id", "mark", "source", "size", "source_size", "target",
                F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
            )
        )
