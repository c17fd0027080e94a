"""Filter interaction audit: what each filter removes, in every order the filters may run in.

A document is reduced to a mask of the filters it fails, and a part of the corpus to its
cells: how many documents have a mask, and how many of those are labelled good or toxic.
The orders are one literal array that every task holds. Each cell folds across it: for an
order, ``aggregate`` carries "still there" from step to step, so ``transform`` over all
orders gives one weighted struct per order and step. The structs of a part's cells, at
most two to the number of filters, are merged by elementwise sums.

Texts never leave their task: the shuffles hold a row of some 60 bytes per document
(id, digest of the text, mask), once beside its labels and once, after copies have been
counted, by digest.

A null text is empty. A null part and an empty one are the same part. Rows without an id
come last among copies and have no label; rows of one id and text are no copies of each
other, and keep the labels of their id. Several labels of one id count as the largest.
Parts come from the documents, so an empty table gives no rows. Other columns, whatever
their names, are not looked at.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medvoice.llm.frames import id_of

WHITE = r"[\x20\x09-\x0D]+"
#: Conditions to fail by, over ``text`` and its measures. ``COPIES`` names one more filter.
RULES = {
    "A": "n_words < 100",
    "B": "100 * n_distinct < 80 * n_words",
    "C": "100 * n_upper > 10 * n_chars",
    "D": "text RLIKE '[#$%&*|]'",
}
COPIES = "E"
#: Every cell folds over all orders, so their number is bounded: 6! orders of 6 steps.
MOST = 6
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def measured(docs: DataFrame, text: str, doc_id: str, part: str) -> DataFrame:
    """``(part, id, digest)`` and the measures of the whole texts that rules may use."""
    named = docs.select(
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        id_of(doc_id).alias("id"),
        F.col(doc_id).isNotNull().alias("known"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    # Without white space at its ends only an empty text gives an empty word.
    bare = F.btrim("text", F.lit(" \t\n\x0b\x0c\r"))
    return named.select("*", F.when(bare != "", F.split(bare, WHITE)).alias("words")).select(
        "part",
        "id",
        "known",
        "text",
        F.unhex(F.sha2("text", 256)).alias("digest"),
        F.coalesce(F.size("words"), F.lit(0)).alias("n_words"),
        F.coalesce(F.size(F.array_distinct("words")), F.lit(0)).alias("n_distinct"),
        F.char_length("text").cast("long").alias("n_chars"),
        F.char_length(F.regexp_replace("text", "[^A-Z]+", "")).cast("long").alias("n_upper"),
    )


def cells(
    docs: DataFrame,
    labels: DataFrame,
    rules: dict[str, str] = RULES,
    copies: str | None = COPIES,
    text: str = "text",
    doc_id: str = "doc_id",
    part: str = "lang",
    good: str = "quality",
    toxic: str = "toxic",
) -> DataFrame:
    """``(part, mask, n, good, toxic)``: bit i of the mask says that the i-th letter's filter fails."""
    letters = sorted([*rules, *([copies] if copies else [])])
    mask = F.lit(0)
    for letter, rule in rules.items():
        mask = mask + F.when(F.expr(rule), 1 << letters.index(letter)).otherwise(0)
    rows = measured(docs, text, doc_id, part).select("part", "id", "known", "digest", mask.alias("mask"))
    marks = (
        labels.where(F.col(doc_id).isNotNull())
        .groupBy(F.col(doc_id).cast("long").alias("id"))
        .agg(
            F.coalesce(F.max((F.col(good) == 1).cast("int")), F.lit(0)).alias("good"),
            F.coalesce(F.max((F.col(toxic) == 1).cast("int")), F.lit(0)).alias("toxic"),
        )
        .withColumn("known", F.lit(True))
    )
    keys = ["part", "digest", "mask", "good", "toxic"]
    seen = (
        rows.join(marks, ["id", "known"], "left")
        .select("id", *keys[:3], *(F.coalesce(c, F.lit(0)).alias(c) for c in keys[3:]))
        .groupBy("id", *keys)
        .agg(F.count("*").alias("n"))
        .groupBy(*keys)
        .agg(F.sum("n").alias("n"), F.min(F.struct("id", "n")).alias("lead"))
    )
    weighted = [F.col("n"), (F.col("n") * F.col("good")).alias("good"), (F.col("n") * F.col("toxic")).alias("toxic")]
    if copies:
        # Of a text's rows those with its smallest id are no copies; few rows are left per digest.
        first = F.min("lead.id").over(Window.partitionBy("digest"))
        lead = F.when(F.col("lead.id") == F.col("first"), F.col("lead.n")).otherwise(0)
        bit = 1 << letters.index(copies)
        seen = (
            seen.withColumn("first", first)
            .select(
                *keys,
                F.inline(F.array(
                    F.struct(F.lit(0).alias("copy"), lead.alias("n")),
                    F.struct(F.lit(bit).alias("copy"), (F.col("n") - lead).alias("n")),
                )),
            )
            .where("n > 0")
            .withColumn("mask", F.col("mask") + F.col("copy"))
        )
    return seen.select("part", "mask", *weighted).groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic")
    )


def _folded(cell: Column, orders: Column, letters: list[str]) -> Column:
    """One weighted struct per order and step for a cell."""
    shape = ", ".join(f"{c}: bigint" for c in COUNTS)
    names = "".join(letters)

    def along(order: Column) -> Column:
        def step(state: Column, at: Column) -> Column:
            bit = F.element_at(F.array(*(F.lit(1 << i) for i in range(len(letters)))), F.instr(F.lit(names), F.substring(order, at, F.lit(1))))
            fails, there = cell["mask"].bitwiseAND(bit) != 0, state["there"]

            def weight(condition: Column, of: str) -> Column:
                return F.when(condition, cell[of]).otherwise(F.lit(0).cast("long"))

            row = F.struct(
                weight(there & ~fails, "n").alias("kept"),
                weight(there & fails, "n").alias("removed"),
                weight(~there & fails, "n").alias("redundant"),
                weight(cell["mask"] == bit, "n").alias("unique_fails"),
                weight(there & fails, "good").alias("good_lost"),
                weight(there & fails, "toxic").alias("toxic_lost"),
            )
            return F.struct((there & ~fails).alias("there"), F.concat(state["steps"], F.array(row)).alias("steps"))

        start = F.struct(F.lit(True).alias("there"), F.array().cast(f"array<struct<{shape}>>").alias("steps"))
        return F.aggregate(F.sequence(F.lit(1), F.lit(len(letters))), start, step, lambda state: state["steps"])

    return F.flatten(F.transform(orders, along))


def interactions(found: DataFrame, letters: list[str]) -> DataFrame:
    """One row per part, order and step from a table of :func:`cells`."""
    if not 1 <= len(letters) <= MOST:
        raise ValueError(f"one to {MOST} filters")
    letters = sorted(letters)
    named = ["".join(p) for p in permutations(letters)]
    orders, steps = F.lit(named), len(letters)
    zeros = F.array_repeat(F.struct(*(F.lit(0).cast("long").alias(c) for c in COUNTS)), len(named) * steps)

    def merge(have: Column, cell: Column) -> Column:
        return F.zip_with(
            have, _folded(cell, orders, letters), lambda a, b: F.struct(*((a[c] + b[c]).alias(c) for c in COUNTS))
        )

    merged = (
        found.groupBy("part")
        .agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))
        .select("part", F.posexplode(F.aggregate("cells", zeros, merge)).alias("at", "counts"))
        .withColumn("filter_order", F.element_at(orders, (F.col("at") / steps).cast("int") + 1))
        .withColumn("step", F.col("at") % steps + 1)
        .withColumn("letter", F.substring("filter_order", F.col("step"), F.lit(1)))
    )
    # A filter's marginal removals over all orders, which Shapley values are the mean of.
    every = F.sum("counts.removed").over(Window.partitionBy("part", "letter"))
    return merged.select("part", "filter_order", "step", "counts.*", every.alias("shapley"))


def audit(
    docs: DataFrame,
    labels: DataFrame,
    rules: dict[str, str] = RULES,
    copies: str | None = COPIES,
    text: str = "text",
    doc_id: str = "doc_id",
    part: str = "lang",
    good: str = "quality",
    toxic: str = "toxic",
) -> DataFrame:
    """What each filter keeps, removes and loses, per part, order and step.

    ``rules`` maps a letter to the condition to fail by; ``copies`` is the letter of the
    filter that removes texts a smaller id has too, if there is one.
    """
    found = cells(docs, labels, rules, copies, text, doc_id, part, good, toxic)
    return interactions(found, [*rules, *([copies] if copies else [])])
