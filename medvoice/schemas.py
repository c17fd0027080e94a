"""Table schemas. Every field is nullable.

Fixed values: column names, their order and their types are part of the data
contract with existing review files and messages.
"""

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

RAW = StructType(
    [
        StructField("UniqueID", LongType()),
        StructField("drugName", StringType()),
        StructField("condition", StringType()),
        StructField("review", StringType()),
        StructField("rating", DoubleType()),
        StructField("date", StringType()),
        StructField("usefulCount", IntegerType()),
    ]
)

# The exploratory read: identifiers as double, numbers as text, cast afterwards.
RAW_TEXT = StructType(
    [
        StructField("UniqueID", DoubleType()),
        StructField("drugName", StringType()),
        StructField("condition", StringType()),
        StructField("review", StringType()),
        StructField("rating", StringType()),
        StructField("date", StringType()),
        StructField("usefulCount", StringType()),
    ]
)

SCORED = StructType([*RAW.fields, StructField("sentiment", DoubleType())])

LANDED = StructType(
    [
        StructField("review", StringType()),
        StructField("UniqueID", LongType()),
        StructField("drugName", StringType()),
        StructField("condition", StringType()),
        StructField("date", StringType()),
        StructField("usefulCount", IntegerType()),
        StructField("sentiment", DoubleType()),
    ]
)

MESSAGE = RAW
# A message must carry these keys with a value; a rating is optional.
MESSAGE_REQUIRED = ("review", "UniqueID", "drugName", "condition", "date", "usefulCount")

FEATURES = ("usefulCount", "sentiment")
LABEL = "rating"


def with_int_ids(schema: StructType) -> StructType:
    """The same schema with a 32-bit ``UniqueID``, for consumers that ask for it.

    Everything is read and stored with 64 bits: a larger identifier read through a
    32-bit schema would be NULL, and the cleaning step would then drop the row.
    """
    return StructType(
        [
            StructField(f.name, IntegerType() if f.name == "UniqueID" else f.dataType)
            for f in schema.fields
        ]
    )
