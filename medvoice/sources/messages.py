"""Review messages: encoding, decoding, stream sources."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from medvoice.functions.columns import decode_body, parse_message
from medvoice.schemas import MESSAGE, MESSAGE_REQUIRED


# A file stream passes over files much older than the newest one it has seen. Copied or
# back-filled files keep old times, so the limit is far beyond any back-fill.
MAX_FILE_AGE = "36500d"


def message_source(
    spark: SparkSession,
    path: str,
    max_files: int | None = None,
    max_bytes: str | None = None,
    max_age: str = MAX_FILE_AGE,
) -> DataFrame:
    """Stream of message bodies, one per line of the files arriving in a folder.

    The body is in column ``data``. Any other source with such a column, such as
    a message bus connector, can take its place. The limits bound a micro-batch.
    """
    reader = spark.readStream.format("text").option("maxFileAge", max_age)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.load(path).withColumnRenamed("value", "data")


def table_source(
    spark: SparkSession, path: str, schema: StructType, pattern: str = "*.parquet",
    max_age: str = MAX_FILE_AGE,
) -> DataFrame:
    """Stream of the rows of Parquet files arriving in a folder."""
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", pattern)
        .option("maxFileAge", max_age)
        .parquet(path)
    )


def encode_messages(reviews: DataFrame) -> DataFrame:
    """Reviews as base64 JSON bodies; a NULL field is a missing key."""
    fields = [c for c in MESSAGE.fieldNames() if c in reviews.columns]
    body = F.to_json(F.struct(*fields))
    # Long base64 text may come in lines of 76 characters; a message is one line.
    data = F.translate(F.base64(body.cast("binary")), "\r\n", "")
    return reviews.select(data.alias("data"))


def decode_messages(
    messages: DataFrame, data: str = "data", keep: Sequence[str] = ()
) -> DataFrame:
    """Decode and parse; keep the raw body, ``keep``, and whether it is a usable message."""
    parsed = messages.withColumn("body", decode_body(data)).withColumn(
        "m", parse_message("body")
    )
    usable = reduce(
        lambda a, b: a & b, [F.col(f"m.{c}").isNotNull() for c in MESSAGE_REQUIRED]
    )
    return parsed.select(
        F.col(data), *keep, *[F.col(f"m.{c}").alias(c) for c in MESSAGE.fieldNames()],
        usable.alias("usable"),
    )
