"""Training: scored reviews -> evaluated, stored rating model."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from medvoice.operators.cleaning import clean_reviews
from medvoice.operators.rating_model import evaluate, fit_rating_model, predict, save_model
from medvoice.operators.sampling import with_split
from medvoice.schemas import FEATURES, LABEL

# Columns the model does not use; absent ones are ignored.
UNUSED = ("date", "document", "token", "class")


@dataclass
class Trained:
    model: PipelineModel
    predictions: DataFrame
    report: DataFrame


def train(
    train_reviews: DataFrame,
    holdout_reviews: DataFrame | None = None,
    keys: tuple[str, ...] = ("UniqueID",),
    seed: int = 42,
    model_path: str | None = None,
    features: Sequence[str] = FEATURES,
    indexed: Sequence[str] = (),
    bins: int | None = None,
    **forest: object,
) -> Trained:
    """Clean, fit, evaluate on both sides, optionally store.

    Without a holdout table a quarter of the training rows is set aside by key.
    Both sides are cleaned, since a NULL label fails the fit. The report holds
    one row per side. Both sides are one marked table whose columns the model needs are
    kept while fitting and reporting, so the source is read once for both. ``bins`` fits
    to cells of binned features, whose number does not grow with the table.
    """
    fitting = clean_reviews(train_reviews.drop(*UNUSED))
    if holdout_reviews is None:
        marked = with_split(fitting, keys, seed=seed)
    else:
        held = clean_reviews(holdout_reviews.drop(*UNUSED))
        marked = fitting.withColumn("holdout", F.lit(False)).unionByName(
            held.withColumn("holdout", F.lit(True))
        )
    used = [f for f in features if f not in {f"{c}_idx" for c in indexed}]
    names = [k for k in keys if k in marked.columns and k not in used]
    narrow = marked.select(*names, LABEL, *used, *indexed, "holdout").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        model = fit_rating_model(
            narrow.where(~F.col("holdout")).drop("holdout"), features, seed=seed, indexed=indexed, bins=bins, **forest
        )
        if model_path:
            save_model(model, model_path)
        split = F.when(F.col("holdout"), "holdout").otherwise("train")
        # One row per side; computed while the kept table is there.
        rows = evaluate(predict(model, narrow.withColumn("split", split)), by=["split"])
        report = rows.sparkSession.createDataFrame(rows.collect(), rows.schema)
    finally:
        narrow.unpersist()
    predictions = predict(model, marked.where("holdout").drop("holdout"))
    return Trained(model, predictions, report)
