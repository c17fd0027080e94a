"""Small helpers on DataFrames shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medvoice.workspace import new_folder

#: Missing ids sort after all others and count as one document.
NO_ID = (1 << 63) - 1

SHUFFLES_DELETED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def unused(df: DataFrame, name: str) -> str:
    """``name``, or a longer one that is no column of the table yet."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name += "_"
    return name


def id_of(column: str) -> Column:
    return F.coalesce(F.col(column).cast("long"), F.lit(NO_ID))


def stored(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """The table, written once to the shared folder and read from there.

    Cuts the lineage: what is there outlives executors, and is computed once.
    """
    folder = new_folder(df.sparkSession, name)
    df.write.parquet(folder, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def forget(table: DataFrame) -> None:
    """Delete the folder of a :func:`stored` table that nothing reads any more."""
    spark = table.sparkSession
    for file in table.inputFiles()[:1]:
        path = spark._jvm.org.apache.hadoop.fs.Path(file).getParent()
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """Queries that run inside delete their shuffle files as they end.

    Else these stay until the driver collects its garbage, which may be long after the
    disk is full. For the steps of a large job that are stored and not run again.
    """
    before = spark.conf.get(SHUFFLES_DELETED, "false")
    spark.conf.set(SHUFFLES_DELETED, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLES_DELETED, before)


def with_fields(schema: T.StructType, *fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType(list(schema.fields) + [T.StructField(n, t, True) for n, t in fields])


def rows(schema: list[tuple[str, pa.DataType]], columns: list) -> pa.RecordBatch:
    """A batch from columns given in the order of ``schema``."""
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, (_, t) in zip(columns, schema)], names=[n for n, _ in schema]
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
