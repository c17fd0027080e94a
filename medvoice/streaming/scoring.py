"""Newly landed files: predict ratings, store them, archive the inputs."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from medvoice.functions.columns import run_stamp
from medvoice.operators.rating_model import predict
from medvoice.schemas import FEATURES, LANDED
from medvoice.sources.files import landed_layout
from medvoice.sources.messages import MAX_FILE_AGE
from medvoice.streaming.landing import stream_id
from medvoice.streaming.manifest import MANIFESTS, commit, entries_of, read_committed, read_files


def landed_source(
    spark: SparkSession,
    landed_path: str,
    archive_path: str | None = None,
    max_files: int | None = None,
    index_column: bool = False,
    max_age: str = MAX_FILE_AGE,
) -> DataFrame:
    """Stream of the rows of landed files.

    With ``archive_path``, which must lie outside ``landed_path``, files of a
    committed batch are moved there when the next batch is planned; a file that
    has not been scored is never moved. :func:`archive_scored` moves the rest after a run.
    """
    schema, options = landed_layout(index_column)
    reader = (
        spark.readStream.schema(schema)
        .options(**options)
        .option("recursiveFileLookup", "true")
        .option("maxFileAge", max_age)
    )
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if archive_path:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_path)
    return reader.csv(landed_path).select(*LANDED.fieldNames())


def committed_sources(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``path`` of the files that committed batches of a file stream have read, from its checkpoint."""
    entry = F.from_json("value", "path string, timestamp long, batchId long")
    log = spark.read.text(f"{checkpoint}/sources/0").where(F.col("value").startswith("{"))
    done = spark.read.text(f"{checkpoint}/commits").select(
        F.regexp_extract(F.col("_metadata.file_name"), r"^(\d+)$", 1).cast("long").alias("batchId")
    )
    return log.select(entry.alias("e")).select("e.*").join(F.broadcast(done.distinct()), "batchId").select("path").distinct()


def archive_scored(spark: SparkSession, checkpoint: str, landed_path: str, archive_path: str) -> int:
    """Move all landed files that committed batches have scored; the number of files moved.

    What to move is what the stream's log says, so the last batch is included, and a file
    that arrived meanwhile is not. Files keep their place below the folder. Moving again
    moves what is left, so a run that was interrupted is made good by the next one.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path
    store = path(landed_path).getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(path(f"{checkpoint}/commits")):
        return 0
    root = store.makeQualified(path(landed_path)).toUri().getPath()
    moved = 0
    for row in committed_sources(spark, checkpoint).collect():
        source = path(spark._jvm.java.net.URI(row["path"]))
        place = source.toUri().getPath()
        if not place.startswith(f"{root}/") or not store.exists(source):
            continue
        target = path(f"{archive_path}/{place[len(root) + 1 :]}")
        store.mkdirs(target.getParent())
        if not store.rename(source, target):
            raise OSError(f"{source.toString()} could not be moved to {target.toString()}")
        moved += 1
    return moved


def predicted_columns(model: PipelineModel, landed: DataFrame) -> DataFrame:
    """Landed rows with their prediction and run stamp, in one pass.

    A row without one of the features stays, with a NULL prediction: one damaged
    file must not stop the stream, nor may its rows vanish.
    """
    complete = F.lit(True)
    for name in FEATURES:
        complete = complete & F.col(f"_{name}").isNotNull()
    kept = landed.withColumns({f"_{c}": F.col(c) for c in FEATURES})
    filled = kept.withColumns({c: F.coalesce(c, F.lit(0)) for c in FEATURES})
    return (
        predict(model, filled)
        .withColumns({c: F.col(f"_{c}") for c in FEATURES})
        .withColumn("prediction", F.when(complete, F.col("prediction")))
        .withColumn("run_ts", run_stamp())
        .select(*landed.columns, "prediction", "run_ts")
    )


def score_landed(
    model: PipelineModel,
    landed: DataFrame,
    predictions_path: str,
    checkpoint: str,
    once: bool = True,
    interval: str = "1 hour",
) -> StreamingQuery:
    """Start scoring; each file is scored exactly once over all runs.

    The checkpoint remembers the files, the Parquet sink commits each batch as a
    whole. Outputs of one run share a ``run_ts`` folder per micro-batch.
    """
    writer = (
        predicted_columns(model, landed)
        .writeStream.format("parquet")
        .partitionBy("run_ts")
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    trigger = {"availableNow": True} if once else {"processingTime": interval}
    return writer.trigger(**trigger).start(predictions_path)


def manifest_source(
    spark: SparkSession, landed_path: str, max_batches: int | None = None, max_age: str = MAX_FILE_AGE
) -> DataFrame:
    """Stream of the manifests of landed batches, one per row."""
    reader = spark.readStream.format("text").option("wholetext", "true").option("maxFileAge", max_age)
    if max_batches:
        reader = reader.option("maxFilesPerTrigger", max_batches)
    return reader.load(f"{landed_path}/{MANIFESTS}")


def score_landed_manifests(
    model: PipelineModel,
    manifests: DataFrame,
    landed_path: str,
    predictions_path: str,
    checkpoint: str,
    once: bool = True,
    interval: str = "1 hour",
) -> StreamingQuery:
    """Start scoring what manifests publish, and publish the predictions by manifests too.

    The checkpoint remembers the manifests. A micro-batch that is repeated finds its own
    manifest, so each landed file is scored once over all runs; no file is moved.
    """
    spark = manifests.sparkSession
    stream = stream_id(spark, checkpoint)
    schema, options = landed_layout()

    def write(batch: DataFrame, batch_id: int) -> None:
        landed = read_files(spark, landed_path, entries_of(batch), "csv", schema, options)
        scored = predicted_columns(model, landed)
        place = f"stream_id={stream}/batch_id={batch_id}"
        commit(spark, predictions_path, place, f"{stream}-{batch_id}", lambda folder: scored.write.parquet(folder))

    writer = manifests.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if once else {"processingTime": interval}
    return writer.trigger(**trigger).start()


def read_predictions_manifests(spark: SparkSession, predictions_path: str) -> DataFrame:
    """All published predictions."""
    schema = StructType(
        [*LANDED.fields, StructField("prediction", DoubleType()), StructField("run_ts", StringType())]
    )
    return read_committed(spark, predictions_path, "parquet", schema).drop("month_dir")
