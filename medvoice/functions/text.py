"""Text functions: tokens and row-local polarity."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from medvoice.functions.lexicon import LEXICON, NEGATION_FACTOR, NEGATORS

# Fixed value: a token is a letter, digit or underscore, then any of these or '.
TOKEN_PATTERN = r"[\p{L}\p{N}_][\p{L}\p{N}_']*"


def tokens(text: Column | str) -> Column:
    """Lower-cased tokens of the whole text, in order; NULL for NULL."""
    text = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN_PATTERN), 0)


def is_negator(token: Column, negators: Sequence[str] = NEGATORS) -> Column:
    """True for a negating word; false for any other word and for NULL."""
    if not negators:
        return F.lit(False)
    return F.coalesce(token.isin(*negators) | token.endswith("n't"), F.lit(False))


def polarity(
    text: Column | str,
    lexicon: Mapping[str, float] = LEXICON,
    negators: Sequence[str] = NEGATORS,
) -> Column:
    """Mean polarity of the lexicon words of a text; 0.0 when there is none.

    Row-local, so scoring a table needs no join and no shuffle: the words are a
    hash set inside the plan, and only the few hits look up their value. Meant
    for lexicons of bounded size; larger ones go through
    :func:`medvoice.operators.polarity.polarity_by_join`.
    """
    words = sorted(lexicon)
    values = F.create_map(*[F.lit(x) for w in words for x in (w, float(lexicon[w]))])

    def mean_of(found: Column) -> Column:
        total = F.aggregate(found, F.lit(0.0), lambda acc, x: acc + x)
        return F.when(F.size(found) > 0, total / F.size(found)).otherwise(F.lit(0.0))

    def scored(toks: Column) -> Column:
        def hit(token: Column, i: Column) -> Column:
            value = F.try_element_at(values, token)
            if negators:
                before = F.get(toks, i - 1)
                factor = F.when(is_negator(before, negators), NEGATION_FACTOR).otherwise(1.0)
                value = value * factor
            return F.when(token.isin(*words), value)

        return F.filter(F.transform(toks, hit), lambda x: x.isNotNull())

    # A one-element array binds the token list once for the whole expression.
    bound = F.transform(F.array(tokens(text)), scored)
    return F.coalesce(F.get(F.transform(bound, mean_of), F.lit(0)), F.lit(0.0))
