"""Session settings used by the command line, the tests and the bench."""

from __future__ import annotations

from pyspark.sql import SparkSession

# What the jobs rely on. Most are Spark's defaults, stated because plans and
# tests depend on them.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(
    app: str = "medvoice",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A session with :data:`SETTINGS`.

    On a cluster leave ``master`` unset (spark-submit names it) and give
    ``shuffle_partitions`` generously, about shuffled bytes / 200 MB: adaptive
    execution merges what turns out too small, but it cannot split an aggregation.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(SETTINGS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
