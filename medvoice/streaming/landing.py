"""Arriving messages: decode, score, land by month. Stateless and retry-safe."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.utils import AnalysisException

from medvoice.functions.columns import month_dir
from medvoice.functions.lexicon import LEXICON
from medvoice.operators.polarity import score_reviews
from medvoice.schemas import LANDED
from medvoice.sources.files import LANDED_DELIMITER, csv_writer, landed_layout
from medvoice.sources.messages import decode_messages
from medvoice.streaming.manifest import commit, read_committed


def landed_columns(
    messages: DataFrame, lexicon: Mapping[str, float] | DataFrame = LEXICON
) -> DataFrame:
    """Decoded, scored messages with their month folder and the ``usable`` mark.

    ``messages`` is a batch table. A ``month_dir`` it brings along is kept; without one
    it is the month of the query's start.
    """
    if "month_dir" not in messages.columns:
        messages = messages.withColumn("month_dir", month_dir(F.current_timestamp()))
    decoded = decode_messages(messages, keep=["month_dir"])
    return score_reviews(decoded, lexicon).select(
        "data", "usable", *LANDED.fieldNames(), "month_dir"
    )


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The name of the stream that a checkpoint belongs to, made with the checkpoint.

    It is lost with the checkpoint: a new one, whose batches count from 0 again, is
    another stream.
    """
    folder = f"{checkpoint}/stream-id"
    try:
        return spark.read.text(folder).first()[0]
    except (AnalysisException, TypeError):
        name = f"s-{uuid.uuid4().hex}"
        spark.createDataFrame([(name,)], "value string").coalesce(1).write.mode("overwrite").text(folder)
        return name


def land_messages(
    messages: DataFrame,
    landed_path: str,
    rejects_path: str,
    checkpoint: str,
    lexicon: Mapping[str, float] | DataFrame = LEXICON,
    once: bool = True,
    interval: str = "1 minute",
    manifests: bool = False,
) -> StreamingQuery:
    """Start landing a stream of messages.

    Files go to ``<landed>/month_dir=<m-yyyy>/stream_id=<s>/batch_id=<n>``. A batch is
    written aside and then published by renaming its folder, once: a batch that is
    repeated after a failure finds its folder and leaves it as it is, so no row is landed
    twice, and files the scoring job may have read already never change. Streams with
    other checkpoints have other folders. Unusable messages are kept as received.

    Where a store cannot rename a folder in one step, use ``manifests``: files get their
    final names at once, and a manifest publishes them (:mod:`medvoice.streaming.manifest`);
    read them with :func:`read_landed_manifests`.

    The month comes from the clock that Spark logs with the batch, which a repeated
    batch sees again.
    """
    spark = messages.sparkSession
    stream = stream_id(spark, checkpoint)

    def publish(writer, root: str, place: str, batch_id: int) -> None:
        if manifests:
            commit(spark, root, place, f"{stream}-{batch_id}", lambda folder: writer.save(folder))
        else:
            _publish(spark, writer, root, place)

    def write(batch: DataFrame, batch_id: int) -> None:
        month = batch.select("month_dir").first()
        if month is None:
            return
        place = f"month_dir={month[0]}/stream_id={stream}/batch_id={batch_id}"
        # Kept once, for both writes: usable messages as landed, the others as received.
        received = F.when(~F.col("usable"), F.col("data")).alias("data")
        scored = landed_columns(batch, lexicon).select(received, "usable", *LANDED.fieldNames()).persist()
        try:
            good = scored.where("usable").select(*LANDED.fieldNames())
            publish(csv_writer(good, LANDED_DELIMITER).format("csv"), landed_path, place, batch_id)
            bad = scored.where(~F.col("usable")).select("data")
            publish(bad.write.format("text"), rejects_path, place, batch_id)
        finally:
            scored.unpersist()

    writer = (
        messages.select("data", month_dir(F.current_timestamp()).alias("month_dir"))
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
    )
    trigger = {"availableNow": True} if once else {"processingTime": interval}
    return writer.trigger(**trigger).start()


def read_landed_manifests(
    spark: SparkSession, path: str, months: Sequence[str] | None = None
) -> DataFrame:
    """All rows of published batches as one table, with their ``month_dir``."""
    schema, options = landed_layout()
    return read_committed(spark, path, "csv", schema, options, months)


def _publish(spark: SparkSession, writer, root: str, place: str) -> None:
    """Write to a folder readers pass over, then move it to its place unless that exists."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    final, aside = path(f"{root}/{place}"), path(f"{root}/_writing/{place.replace('/', '-')}")
    store = final.getFileSystem(spark._jsc.hadoopConfiguration())
    if store.exists(final):
        return
    writer.mode("overwrite").save(aside.toString())
    store.mkdirs(final.getParent())
    if not store.rename(aside, final) and not store.exists(final):
        raise OSError(f"{aside.toString()} could not be moved to {final.toString()}")
