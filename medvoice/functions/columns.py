"""Scalar expressions used by several operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from medvoice.schemas import MESSAGE

# Fixed value: reviews rated from here on count as positive.
POSITIVE_FROM = 5


def to_numeric(column: Column | str) -> Column:
    """Text to double. Unparsable text fails the query under ANSI mode."""
    return _col(column).cast("double")


def to_numeric_or_null(column: Column | str) -> Column:
    """Text to double, NULL where it cannot be parsed."""
    return _col(column).try_cast("double")


def review_sent(rating: Column | str = "rating") -> Column:
    """1.0 for a positive rating, 0.0 for a negative one, NULL without a rating."""
    rating = _col(rating)
    return F.when(rating >= POSITIVE_FROM, 1.0).when(rating < POSITIVE_FROM, 0.0)


def round_half_even(column: Column | str) -> Column:
    """Nearest integer, halves to the even neighbour (``round`` goes half-up)."""
    return F.rint(_col(column))


def month_dir(ts: Column | str) -> Column:
    """Month and year without zero padding, such as ``3-2024``."""
    ts = _col(ts)
    return F.concat_ws("-", F.month(ts), F.year(ts))


def run_stamp() -> Column:
    """Start of the current query (or micro-batch) as sortable text."""
    return F.date_format(F.current_timestamp(), "yyyyMMdd'T'HHmmss'.'SSSSSS")


def decode_body(data: Column | str) -> Column:
    """Message body from base64; NULL when it is not base64."""
    return F.try_to_binary(_col(data), F.lit("base64")).cast("string")


def parse_message(body: Column | str) -> Column:
    """A JSON body as a struct of the message schema; NULL fields on garbage."""
    return F.from_json(_col(body), MESSAGE, {"mode": "PERMISSIVE"})


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column
