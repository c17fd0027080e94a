"""Publishing batches by a manifest, for stores where moving a folder is not one step.

A batch's files are written under their final names, in a folder of their own per attempt,
and never moved. What makes them part of the table is one small file that lists them and
that appears whole, or not at all, under ``_manifests``. Readers take files from manifests
only, so they never see half a batch, the files of an attempt that failed, or a batch
twice: a batch that is repeated finds its manifest and leaves everything as it is.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StringType, StructType

MANIFESTS = "_manifests"
ENTRY = "path string, bytes long"


def _store(spark: SparkSession, path: str):
    """The Hadoop path and the store it lies in."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def manifest_path(root: str, key: str) -> str:
    return f"{root}/{MANIFESTS}/{key}.json"


def _written_files(spark: SparkSession, folder: str) -> list[tuple[str, int]]:
    """Names and sizes of the data files in one attempt's folder."""
    where, store = _store(spark, folder)
    found = store.listStatus(where) if store.exists(where) else []
    return sorted(
        (s.getPath().getName(), s.getLen()) for s in found if not s.getPath().getName().startswith(("_", "."))
    )


def _publish(spark: SparkSession, root: str, key: str, entries: Sequence[Mapping[str, object]]) -> None:
    """Make the manifest appear whole: written under a hidden name, then given its own."""
    final, store = _store(spark, manifest_path(root, key))
    hidden, _ = _store(spark, f"{root}/{MANIFESTS}/.{key}.{uuid.uuid4().hex}")
    out = store.create(hidden, True)
    out.write("".join(json.dumps(e) + "\n" for e in entries).encode())
    out.close()
    if not store.rename(hidden, final) and not store.exists(final):
        raise OSError(f"{final.toString()} could not be written")


def commit(spark: SparkSession, root: str, place: str, key: str, write: Callable[[str], None]) -> bool:
    """Write a batch's files below ``root/place`` and publish them as ``key``, once.

    ``write`` writes a table to the folder it is given. Attempts of the same key that
    failed are deleted first; only the owner of a key writes there. False if the key is
    published already.
    """
    done, store = _store(spark, manifest_path(root, key))
    if store.exists(done):
        return False
    batch, _ = _store(spark, f"{root}/{place}")
    if store.exists(batch):
        store.delete(batch, True)
    attempt = f"{place}/attempt={uuid.uuid4().hex}"
    write(f"{root}/{attempt}")
    files = _written_files(spark, f"{root}/{attempt}")
    _publish(spark, root, key, [{"path": f"{attempt}/{name}", "bytes": size} for name, size in files])
    return True


def entries_of(manifests: DataFrame) -> DataFrame:
    """``(path, bytes)`` of the files that manifests, one per row in ``value``, list."""
    lines = manifests.select(F.explode(F.split("value", "\n")).alias("line")).where("line <> ''")
    return lines.select(F.from_json("line", ENTRY).alias("e")).select("e.*")


def committed_files(spark: SparkSession, root: str) -> DataFrame:
    """``(path, bytes)`` of all published files, by paths relative to ``root``."""
    where, store = _store(spark, f"{root}/{MANIFESTS}")
    if not store.exists(where):
        return spark.createDataFrame([], ENTRY)
    return entries_of(spark.read.option("wholetext", "true").text(f"{root}/{MANIFESTS}"))


def read_files(
    spark: SparkSession,
    root: str,
    files: DataFrame,
    file_format: str,
    schema: StructType,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """The rows of listed files. Their names go through the driver, as those of any table read do."""
    paths = [f"{root}/{r['path']}" for r in files.select("path").distinct().collect()]
    if not paths:
        return spark.createDataFrame([], schema)
    reader = spark.read.format(file_format).schema(schema).options(**(options or {}))
    return reader.option("basePath", root).load(paths).select(*schema.fieldNames())


def read_committed(
    spark: SparkSession,
    root: str,
    file_format: str,
    schema: StructType,
    options: Mapping[str, str] | None = None,
    months: Sequence[str] | None = None,
) -> DataFrame:
    """All published rows with their ``month_dir``; with ``months`` only those files are read."""
    files = committed_files(spark, root)
    if months is not None:
        files = files.where(F.regexp_extract("path", "month_dir=([^/]+)", 1).isin(list(months)))
    with_month = StructType([*schema.fields, StructField("month_dir", StringType())])
    return read_files(spark, root, files, file_format, with_month, options)


def abandoned_files(spark: SparkSession, root: str) -> DataFrame:
    """``path`` of files below ``root`` that no manifest lists: attempts that failed, or still run."""
    where, store = _store(spark, root)
    if not store.exists(where):
        return spark.createDataFrame([], "path string")
    base = store.getFileStatus(where).getPath().toString().rstrip("/") + "/"
    # Names only: with no other column asked for, contents are not read.
    every = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    named = every.select(F.replace("path", F.lit(base), F.lit("")).alias("path"))
    return named.where(~F.col("path").startswith(MANIFESTS)).join(committed_files(spark, root), "path", "left_anti")
