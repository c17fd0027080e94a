"""Functions of this library for SQL text: in queries, views and streams."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import SparkSession

from medvoice.functions.lexicon import LEXICON, NEGATION_FACTOR, NEGATORS
from medvoice.functions.text import TOKEN_PATTERN


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def polarity_sql(
    text: str, lexicon: Mapping[str, float] = LEXICON, negators: Sequence[str] = NEGATORS
) -> str:
    """The polarity of a text as a SQL expression; the same values as :func:`~medvoice.functions.text.polarity`."""
    if not lexicon:
        return "0.0D"
    words = ", ".join(_text(w) for w in sorted(lexicon))
    values = ", ".join(f"{_text(w)}, {float(lexicon[w])!r}D" for w in sorted(lexicon))
    factor = "1.0D"
    if negators:
        before = "get(toks, i - 1)"
        negated = f"{before} IN ({', '.join(map(_text, negators))}) OR endswith({before}, {_text("n't")})"
        factor = f"CASE WHEN {negated} THEN {NEGATION_FACTOR}D ELSE 1.0D END"
    hit = f"CASE WHEN t IN ({words}) THEN try_element_at(map({values}), t) * {factor} END"
    found = f"filter(transform(toks, (t, i) -> {hit}), x -> x IS NOT NULL)"
    mean = "CASE WHEN size(f) > 0 THEN aggregate(f, 0.0D, (a, x) -> a + x) / size(f) ELSE 0.0D END"
    # Arrays of one element name the tokens and the hits, so that they are computed once.
    tokens = f"array(regexp_extract_all(lower({text}), {_text(TOKEN_PATTERN)}, 0))"
    return f"coalesce(get(transform(transform({tokens}, toks -> {found}), f -> {mean}), 0), 0.0D)"


def register_polarity(
    spark: SparkSession,
    name: str = "polarity",
    lexicon: Mapping[str, float] = LEXICON,
    negators: Sequence[str] = NEGATORS,
) -> None:
    """Make ``name(text)`` a function of the session, replacing an earlier one of that name."""
    body = polarity_sql("text", lexicon, negators)
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(text STRING) RETURNS DOUBLE RETURN {body}")
