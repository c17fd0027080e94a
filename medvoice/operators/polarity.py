"""Polarity scores for review tables, with a lexicon of any size."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medvoice.functions.lexicon import LEXICON, NEGATION_FACTOR, NEGATORS
from medvoice.functions.text import is_negator, polarity, tokens
from medvoice.operators.joins import lookup_join
from medvoice.workspace import materialize

# Up to this many words the lexicon becomes part of the plan; beyond, it is joined.
MAX_INLINE_WORDS = 5000


def score_reviews(
    df: DataFrame,
    lexicon: Mapping[str, float] | DataFrame = LEXICON,
    text: str = "review",
    key: str = "UniqueID",
    negators: Sequence[str] = NEGATORS,
    output: str = "sentiment",
) -> DataFrame:
    """Add the polarity of ``text`` to each row.

    ``lexicon`` is a mapping or a table ``(word, polarity)``. Lexicons of at most
    ``MAX_INLINE_WORDS`` words are scored row by row, without a shuffle; the size
    of a table is checked by reading one row more than that. Larger ones are
    joined. Both forms give the same scores, on batch tables of any keys; a stream
    scores its micro-batches. A word must be in a lexicon once; words without a
    polarity are left out.
    """
    if isinstance(lexicon, DataFrame):
        lexicon = lexicon.select("word", "polarity").where("word IS NOT NULL AND polarity IS NOT NULL")
        head = lexicon.limit(MAX_INLINE_WORDS + 1).collect()
        if len(head) > MAX_INLINE_WORDS:
            return polarity_by_join(df, lexicon, text, key, negators, output)
        words = {row["word"]: row["polarity"] for row in head}
        if len(words) < len(head):
            raise ValueError("a word is in the lexicon more than once")
        lexicon = words
    lexicon = {w: p for w, p in lexicon.items() if p is not None}
    if not lexicon:
        return df.withColumn(output, F.lit(0.0))
    if len(lexicon) > MAX_INLINE_WORDS:
        table = df.sparkSession.createDataFrame(
            list(lexicon.items()), "word string, polarity double"
        )
        return polarity_by_join(df, table, text, key, negators, output)
    return df.withColumn(output, polarity(text, lexicon, negators))


def polarity_by_join(
    df: DataFrame,
    lexicon: DataFrame,
    text: str = "review",
    key: str = "UniqueID",
    negators: Sequence[str] = NEGATORS,
    output: str = "sentiment",
) -> DataFrame:
    """The same scores through a join of tokens with a large lexicon table.

    Each row is numbered, in a copy written to the shared folder, so rows that share a
    ``key`` or have none are scored apart. Only number, word and mark of each token take
    part, never its text; the reviews themselves move once, in the last join. Natural
    text has a few words in a large part of all rows, which :func:`lookup_join` spreads
    over several tasks.
    """
    lexicon = lexicon.select("word", "polarity").where("word IS NOT NULL AND polarity IS NOT NULL")
    if lexicon.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).count():
        raise ValueError("a word is in the lexicon more than once")
    row = "_row"
    df = materialize(df.withColumn(row, F.monotonically_increasing_id()), "reviews")
    bound = F.transform(
        F.array(tokens(text)),
        lambda toks: F.transform(
            toks,
            lambda t, i: F.struct(
                t.alias("word"), is_negator(F.get(toks, i - 1), negators).alias("negated")
            ),
        ),
    )
    words = df.select(row, F.explode(F.get(bound, F.lit(0))).alias("t")).select(
        row, "t.word", "t.negated"
    )
    found = lookup_join(words, lexicon, "word", [row])
    factor = F.when(F.col("negated"), NEGATION_FACTOR).otherwise(1.0)
    means = found.groupBy(row).agg(F.avg(F.col("polarity") * factor).alias(output))
    return df.join(means, row, "left").drop(row).withColumn(
        output, F.coalesce(F.col(output), F.lit(0.0))
    )


def read_lexicon(spark: SparkSession, path: str) -> DataFrame:
    """A lexicon from files with a header and the columns ``word, polarity``."""
    return (
        spark.read.schema("word string, polarity double")
        .options(header="true", enforceSchema="false", mode="FAILFAST")
        .csv(path)
        .withColumn("word", F.lower(F.trim("word")))
    )


def text_polarity(
    spark: SparkSession, text: str | None, lexicon: Mapping[str, float] = LEXICON
) -> float:
    """Polarity of a single text."""
    return spark.createDataFrame([(text,)], "t string").select(polarity("t", lexicon)).first()[0]
