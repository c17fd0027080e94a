"""Review files: typed CSV readers, CSV writers, landed folders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, DataFrameReader, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from medvoice.functions.columns import run_stamp, to_numeric
from medvoice.schemas import LANDED, RAW, RAW_TEXT, SCORED
from medvoice.sources.split_csv import read_split_csv

# The file formats of the review tables.
RAW_DELIMITER = "\t"
SCORED_DELIMITER = "|"
LANDED_DELIMITER = ","


def csv_options(delimiter: str, multi_line: bool = True) -> dict[str, str]:
    """Reader options shared by all review files."""
    return {
        "sep": delimiter,
        "header": "true",
        "quote": '"',
        "escape": '"',
        "multiLine": str(multi_line).lower(),
        "mode": "PERMISSIVE",
        "ignoreLeadingWhiteSpace": "true",
        "ignoreTrailingWhiteSpace": "true",
    }


def _reader(
    spark: SparkSession, schema: StructType, delimiter: str, multi_line: bool
) -> DataFrameReader:
    return spark.read.schema(schema).options(**csv_options(delimiter, multi_line))


def read_reviews_tsv(
    spark: SparkSession, path: str | Sequence[str], schema: StructType = RAW,
    multi_line: bool = True, split: bool = False,
) -> DataFrame:
    """Raw reviews from tab-separated files. Columns bind by position.

    A review may span lines, so a file is read by one task. ``split`` gives the same rows
    from as many tasks as the file has blocks; where no review holds a line break,
    ``multi_line=False`` does so with one pass.
    """
    if split:
        return read_split_csv(spark, path, schema, csv_options(RAW_DELIMITER))
    return _reader(spark, schema, RAW_DELIMITER, multi_line).csv(path)


def read_scored_csv(
    spark: SparkSession, path: str | Sequence[str], schema: StructType = SCORED,
    multi_line: bool = True, split: bool = False,
) -> DataFrame:
    """Scored reviews from ``|``-separated files; ``split`` as for raw ones."""
    if split:
        return read_split_csv(spark, path, schema, csv_options(SCORED_DELIMITER))
    return _reader(spark, schema, SCORED_DELIMITER, multi_line).csv(path)


def read_text_typed(
    spark: SparkSession, path: str | Sequence[str], multi_line: bool = True, split: bool = False
) -> DataFrame:
    """Raw reviews read as text, numbers cast afterwards: bad numbers fail the job."""
    df = read_reviews_tsv(spark, path, RAW_TEXT, multi_line, split)
    return df.withColumns(
        {c: to_numeric(c) for c in ("UniqueID", "rating", "usefulCount")}
    )


def landed_layout(index_column: bool = False) -> tuple[StructType, dict[str, str]]:
    """Schema and options for landed files, whose headers must name the columns.

    With ``index_column`` the files have an unnamed index before them. Spark compares
    every file's header with the schema, in which the index has no name either.
    """
    index = [StructField("", StringType())] if index_column else []
    return StructType([*index, *LANDED.fields]), {**csv_options(LANDED_DELIMITER), "enforceSchema": "false"}


def read_landed(
    spark: SparkSession,
    path: str,
    months: Sequence[str] | None = None,
    index_column: bool = False,
) -> DataFrame:
    """All landed files below a folder as one table, with their ``month_dir``.

    Files may lie in month folders or directly in the folder (``month_dir`` is NULL
    then). Asking for ``months`` reads only their folders. A header with other columns
    fails the read.
    """
    schema, options = landed_layout(index_column)
    df = spark.read.schema(schema).options(**options).csv(path)
    if any(part.startswith("month_dir=") for file in df.inputFiles() for part in file.split("/")):
        month = StructField("month_dir", StringType())
        df = spark.read.schema(StructType([*schema.fields, month])).options(**options).csv(path)
    else:
        df = df.withColumn("month_dir", F.lit(None).cast("string"))
    df = df.select(*LANDED.fieldNames(), "month_dir")
    return df.where(F.col("month_dir").isin(list(months))) if months is not None else df


def from_local(
    spark: SparkSession, rows: Sequence[Sequence[object]], schema: StructType | str
) -> DataFrame:
    """A small table from rows already in the program."""
    return spark.createDataFrame(list(rows), schema)


def append(*frames: DataFrame) -> DataFrame:
    """All rows of all frames, matched by column name; missing columns become NULL."""
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result


def csv_writer(
    df: DataFrame, delimiter: str, max_records_per_file: int | None = None
) -> DataFrameWriter:
    """A CSV writer whose files the readers above give back unchanged.

    Quotes are doubled, as the readers expect; Spark's default escape would
    corrupt reviews that hold quotes and line breaks.
    """
    writer = df.write.options(
        sep=delimiter,
        header=True,
        quote='"',
        escape='"',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    return writer


def write_scored_csv(
    df: DataFrame, path: str, max_records_per_file: int | None = None
) -> None:
    """Write ``|``-separated files in parallel, replacing an earlier result.

    Files are read back by one task each; ``max_records_per_file`` bounds them.
    """
    csv_writer(df, SCORED_DELIMITER, max_records_per_file).mode("overwrite").csv(path)


def write_reviews_tsv(
    df: DataFrame, path: str, max_records_per_file: int | None = None
) -> None:
    """Write raw reviews as tab-separated files."""
    csv_writer(df, RAW_DELIMITER, max_records_per_file).mode("overwrite").csv(path)


def as_parquet(df: DataFrame, folder: str) -> DataFrame:
    """Write a table once and return it read back from there.

    Raw files are text, read whole and, for multi-line reviews, one task per
    file. Work that reads a table several times goes through this copy, of which
    each query reads only its columns.
    """
    df.write.mode("overwrite").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def write_predictions(df: DataFrame, path: str, run: str | None = None) -> None:
    """Add one run's predictions under ``run_ts=<stamp>``; earlier runs stay.

    Feature vectors are left out: they repeat columns that are stored anyway.
    Writing the same run again replaces only that run.
    """
    stamp = F.lit(run) if run else run_stamp()
    (
        df.drop("features")
        .withColumn("run_ts", stamp)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_ts")
        .parquet(path)
    )
