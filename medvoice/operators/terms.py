"""Term frequencies: the data behind word clouds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medvoice.functions.columns import review_sent
from medvoice.functions.lexicon import STOPWORDS
from medvoice.functions.text import tokens
from medvoice.operators.joins import MAX_BROADCAST_ROWS, lookup_join
from medvoice.workspace import materialize

# Fixed value: terms in one cloud.
MAX_TERMS = 1000


def weighted_values(df: DataFrame, column: str) -> DataFrame:
    """Each value of a column once, with the number of its rows as ``weight``.

    For columns of few different values: their texts are then tokenised once each
    rather than once per row.
    """
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("weight"))


def explode_tokens(df: DataFrame, column: str, *keep: str) -> DataFrame:
    """One row per token, with the named other columns."""
    return df.select(*keep, F.explode(tokens(column)).alias("term"))


def term_frequency(
    df: DataFrame,
    column: str,
    stopwords: Sequence[str] = (),
    max_terms: int | None = None,
    weight: str | None = None,
) -> DataFrame:
    """Occurrences of each token over all rows, optionally the most frequent only.

    A row counts as many times as its ``weight`` column says, once without one.

    Texts are never put together: tokens are counted inside each task first, and
    one row per task and distinct token is shuffled, however hot the token.
    """
    terms = explode_tokens(df, column, *([weight] if weight else []))
    if stopwords:
        terms = terms.where(~F.col("term").isin(*stopwords))
    counts = terms.groupBy("term").agg(_occurrences(weight).alias("n"))
    if max_terms is None:
        return counts
    return counts.orderBy(F.desc("n"), F.asc("term")).limit(max_terms)


def term_frequency_by_sentiment(
    df: DataFrame,
    label: int,
    column: str = "review",
    stopwords: Sequence[str] = STOPWORDS,
    max_terms: int | None = MAX_TERMS,
) -> DataFrame:
    """Term frequencies of the negative (0) or positive (1) reviews."""
    return term_frequency(
        df.where(review_sent("rating") == label), column, stopwords, max_terms
    )


# Fixed values of the word clouds: score from which two words count as a phrase,
# and the floor of the logarithms in that score.
COLLOCATION_THRESHOLD = 30.0
LOG_FLOOR = 1e-10
# How often the last term of a cloud may occur, as shares of the count of the last one by
# words alone: guesses that are checked, from each of which fewer words are left out.
SHARES = (1 / 2, 1 / 16)


def word_pairs(
    df: DataFrame,
    column: str,
    stopwords: Sequence[str] = STOPWORDS,
    by: Sequence[str] = (),
    weight: str | None = None,
) -> DataFrame:
    """Occurrences of each word with its follower in the same text: ``(w1, w2, n)``.

    Possessive endings are cut and plain numbers left out first. ``w1`` is never a
    stop word; ``w2`` is NULL where no word follows or a stop word does. Counts
    can be kept apart ``by`` other columns; rows count by ``weight`` if it is given.
    """

    def bare(t: Column) -> Column:
        return F.when(t.endswith("'s"), F.substring(t, F.lit(1), F.length(t) - 2)).otherwise(t)

    def is_number(t: Column) -> Column:
        # Digits sort before ":" or from U+0660 on; other words skip the pattern.
        return ((t < ":") | (t >= "\u0660")) & t.rlike(r"^\p{Nd}+$")

    def counted(word: Column) -> Column:
        return ~word.isin(*stopwords) if stopwords else word.isNotNull()

    def paired(words: Column) -> Column:
        # One text per pair, since words hold no blanks: a cheaper key to group by.
        def pair(word: Column, i: Column) -> Column:
            return F.when(word.isNotNull(), F.concat_ws(" ", word, F.get(words, i + 1)))

        return F.transform(words, pair)

    words = F.filter(F.transform(tokens(column), bare), lambda t: ~is_number(t))
    # Each word is looked up among the stop words once; those stay as NULL between the others.
    own = F.transform(words, lambda t: F.when(counted(t), t))
    bound = F.transform(F.array(own), paired)
    return (
        df.select(*by, *([weight] if weight else []), F.explode(F.get(bound, F.lit(0))).alias("pair"))
        .where(F.col("pair").isNotNull())
        .groupBy(*by, "pair")
        .agg(_occurrences(weight).alias("n"))
        .select(
            *by,
            F.get(F.split("pair", " "), F.lit(0)).alias("w1"),
            F.get(F.split("pair", " "), F.lit(1)).alias("w2"),
            "n",
        )
    )


def log_likelihood(both: Column, first: Column, second: Column, total: Column) -> Column:
    """How unexpected it is that two words follow each other (likelihood ratio)."""

    def part(k: Column, n: Column, p: Column) -> Column:
        return F.log(F.greatest(p, F.lit(LOG_FLOOR))) * k + F.log(
            F.greatest(1 - p, F.lit(LOG_FLOOR))
        ) * (n - k)

    rest = second - both
    overall, after_first = F.try_divide(second, total), F.try_divide(both, first)
    elsewhere = F.try_divide(rest, total - first)
    return F.when((total <= first) | (total <= second), 0.0).otherwise(
        -2
        * (
            part(both, first, overall)
            + part(rest, total - first, overall)
            - part(both, first, after_first)
            - part(rest, total - first, elsewhere)
        )
    )


def _about(both: Column, first: Column, second: Column, total: Column) -> Column:
    """The same score by sums of x ln x, which is quick and right to a thousandth below 10**10 words."""

    def part(x: Column) -> Column:
        x = x.cast("double")
        return x * F.log(F.greatest(x, F.lit(1e-300)))

    cells = part(both) + part(first - both) + part(second - both) + part(total - first - second + both)
    return 2 * (cells + part(total) - part(first) - part(second) - part(total - first) - part(total - second))


def cloud_terms(
    df: DataFrame,
    column: str,
    stopwords: Sequence[str] = STOPWORDS,
    max_terms: int | None = MAX_TERMS,
    threshold: float = COLLOCATION_THRESHOLD,
    weight: str | None = None,
) -> DataFrame:
    """Terms of a word cloud with their weights: words and two-word phrases.

    A plural counts for its singular where both occur. Two words that follow each
    other far more often than chance become a term of their own, and their
    occurrences no longer count for the single words. Starts a job: pair counts
    are written once to the shared folder, so that the texts are read once and
    everything after works on the table of distinct pairs.
    """
    pairs = materialize(word_pairs(df, column, stopwords, weight=weight), "pairs")
    return cloud_of_pairs(pairs, max_terms, threshold)


def cloud_of_pairs(
    pairs: DataFrame,
    max_terms: int | None = MAX_TERMS,
    threshold: float = COLLOCATION_THRESHOLD,
) -> DataFrame:
    """The cloud of a written table of pair counts, or of some of its rows.

    With ``max_terms`` the counts that may be among them are settled first, and all others
    only if that does not give the terms (:func:`_frequent_terms`).
    """
    # A group holds at most a word and its plural.
    group = Window.partitionBy("base")
    merged = F.max(F.col("term") == F.col("base")).over(group)
    known = materialize(
        pairs.groupBy(F.col("w1").alias("term"))
        .agg(F.sum("n").alias("n"))
        .withColumn("base", F.coalesce(_singular("term"), "term"))
        .select(
            "term",
            F.when(merged, F.col("base")).otherwise(F.col("term")).alias("form"),
            "n",
            F.when(merged, F.sum("n").over(group)).otherwise(F.col("n")).alias("form_n"),
        ),
        "words",
    )
    words = known.groupBy(F.col("form").alias("term")).agg(F.sum("n").alias("n"))
    if max_terms:
        few = words.orderBy(F.desc("n")).limit(max_terms).agg(F.count(F.lit(1)).alias("terms"), F.min("n").alias("n")).first()
        for part in SHARES if few["terms"] == max_terms else ():
            found = _frequent_terms(pairs, known, max_terms, threshold, int(few["n"] * part))
            if found is not None:
                return found
    total = known.agg(F.sum("n").cast("double")).scalar()
    phrases = _phrases(pairs.where(F.col("w2").isNotNull()))
    first = known.select(F.col("term").alias("w1"), F.col("form").alias("f1"), F.col("form_n").alias("n1"))
    second = known.select(F.col("term").alias("w2"), F.col("form").alias("f2"), F.col("form_n").alias("n2"))
    # A common word begins or ends many different phrases.
    scored = lookup_join(lookup_join(phrases, first, "w1", ["w2"]), second, "w2", ["w1"])
    score = log_likelihood(
        F.col("n").cast("double"), F.col("n1").cast("double"), F.col("n2").cast("double"), total
    )
    phrase_terms = scored.where(score > threshold).select("w1", "w2", "f1", "f2", "n")
    counts = _settled(words, phrase_terms)
    if max_terms is None:
        return counts
    return counts.orderBy(F.desc("n"), F.asc("term")).limit(max_terms)


def _phrases(pairs: DataFrame, *more: Column) -> DataFrame:
    """``(w1, w2, n)`` and more aggregates of pairs of words, a plural counted for its singular."""
    return (
        pairs.withColumn("base", F.coalesce(_singular("w2"), "w2"))
        .groupBy("w1", "base")
        .agg(
            F.sum("n").alias("n"),
            F.max(F.col("w2") == F.col("base")).alias("merged"),
            *more,
        )
        # Without its singular the group is a plural alone.
        .withColumn("w2", F.when(F.col("merged"), F.col("base")).otherwise(F.concat("base", F.lit("s"))))
        .drop("base", "merged")
    )


def _settled(words: DataFrame, phrase_terms: DataFrame) -> DataFrame:
    """Counts of words and phrases.

    Each phrase takes its occurrences from both words and adds itself; one
    grouping settles all three.
    """
    taken = phrase_terms.select(
        F.explode(
            F.array(
                F.struct(F.col("f1").alias("term"), (-F.col("n")).alias("n")),
                F.struct(F.col("f2").alias("term"), (-F.col("n")).alias("n")),
                F.struct(F.concat_ws(" ", "w1", "w2").alias("term"), F.col("n").alias("n")),
            )
        ).alias("t")
    ).select("t.term", "t.n")
    return (
        words.unionByName(taken)
        .groupBy("term")
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") > 0)
    )


def _frequent_terms(
    pairs: DataFrame, known: DataFrame, max_terms: int, threshold: float, least: int
) -> DataFrame | None:
    """The most frequent terms if all of them occur ``least`` times or more, else None.

    Such terms are words that occur so often before phrases are taken from them, and
    phrases of two of these words. To settle their counts, only phrases with one of these
    words are needed. Of a phrase with a rarer word the score lies below the larger of
    those for the least and the most that the rarer word may occur, as it falls up to the
    count that chance would give and rises from there; most need no look-up of the rarer
    word. Words of a phrase that are rarer occur less than ``least`` times, so they make no
    hot keys.
    """
    if least < 2:
        return None
    frequent = known.where(F.col("form_n") >= least)
    if frequent.limit(MAX_BROADCAST_ROWS + 1).count() > MAX_BROADCAST_ROWS:
        return None
    total = known.agg(F.sum("n").cast("double")).scalar()

    def of(words: DataFrame, i: int) -> DataFrame:
        return words.select(*[F.col(c).alias(f"{to}{i}") for c, to in (("term", "w"), ("form", "f"), ("form_n", "n"))])

    def score(first: Column, second: Column) -> Column:
        return log_likelihood(F.col("n").cast("double"), first.cast("double"), second.cast("double"), total)

    one, two = F.broadcast(of(frequent, 1)), F.broadcast(of(frequent, 2))
    some = (
        pairs.where(F.col("w2").isNotNull())
        .select("w1", "w2", "n")
        .join(one.drop("f1"), "w1", "left")
        .join(two.drop("f2"), "w2", "left")
        .where(F.col("n1").isNotNull() | F.col("n2").isNotNull())
    )
    most = F.lit(least - 1).cast("long")
    ends = [_about(F.col("n"), F.coalesce("n1", end), F.coalesce("n2", end), total) for end in (F.col("n"), most)]
    # Where counts are cut off or near to all words, the score is another function of them.
    plain = (F.coalesce("n1", most) + F.coalesce("n2", most) <= total) & (total < 1 / LOG_FLOOR)
    may = ~plain | (F.greatest(*ends) > threshold - 0.01)
    phrases = _phrases(some, F.max("n1").alias("n1"), F.max("n2").alias("n2")).where(may).select("w1", "w2", "n")
    phrases = materialize(phrases, "phrases").join(one, "w1", "left").join(two, "w2", "left")
    above = score(F.col("n1"), F.col("n2")) > threshold
    parts = [phrases.where(F.col("n1").isNotNull() & F.col("n2").isNotNull()).where(above)]
    for i in (1, 2):
        rare = phrases.where(F.col(f"n{i}").isNull()).drop(f"f{i}", f"n{i}").join(of(known, i), f"w{i}")
        parts.append(rare.where(above))
    columns = ("w1", "w2", "f1", "f2", "n")
    taken = parts[0].select(*columns).unionByName(parts[1].select(*columns)).unionByName(parts[2].select(*columns))
    words = frequent.select(F.col("form").alias("term"), F.col("form_n").alias("n")).distinct()
    order = [F.desc("n"), F.asc("term")]
    top = materialize(_settled(words, taken).orderBy(*order).limit(max_terms), "cloud")
    last = top.agg(F.count(F.lit(1)).alias("terms"), F.min("n").alias("n")).first()
    return top.orderBy(*order) if last["terms"] == max_terms and last["n"] >= least else None


def _occurrences(weight: str | None) -> Column:
    return F.sum(weight) if weight else F.count(F.lit(1))


def _singular(name: str) -> Column:
    word = F.col(name)
    plural = word.endswith("s") & ~word.endswith("ss")
    return F.when(plural, F.substring(word, F.lit(1), F.length(word) - 1))
