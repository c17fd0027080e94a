"""Rating regression: features, fit, prediction, evaluation, storage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from medvoice.operators.collapse import WEIGHT, collapse
from medvoice.operators.label_index import LabelIndex
from medvoice.operators.profiling import rmse, rmse_rounded
from medvoice.operators.ranks import index_by_ranks, label_ranks
from medvoice.schemas import FEATURES, LABEL

__all__ = ["index_by_ranks", "label_ranks"]  # asked for here before they had a module

# Distinct labels an index model may hold whole on driver and tasks; beyond, they are a table.
MAX_LABELS = 100_000
# Rows of a part in a fit, and least number of parts. The forest depends on the number
# of parts, so that is made from the number of rows and nothing else of the cluster.
PART_ROWS, LEAST_PARTS = 250_000, 16


def assembler(features: Sequence[str] = FEATURES) -> VectorAssembler:
    """Feature vector stage; a NULL feature fails the job rather than being guessed."""
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="error")


def assemble(df: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    return assembler(features).transform(df)


def fit_label_index(
    df: DataFrame, column: str = "condition", max_labels: int = MAX_LABELS
) -> StringIndexerModel:
    """Index of a text column: most frequent label first, ties alphabetical.

    The number of labels is checked before they are brought together.
    """
    found = df.select(column).where(F.col(column).isNotNull()).distinct().limit(max_labels + 1)
    if found.count() > max_labels:
        raise ValueError(
            f"{column} has more than {max_labels} values; use LabelIndex, which keeps them in a table"
        )
    return StringIndexer(
        inputCol=column,
        outputCol=f"{column}_idx",
        handleInvalid="skip",
        stringOrderType="frequencyDesc",
    ).fit(df)


def fit_rating_model(
    train: DataFrame,
    features: Sequence[str] = FEATURES,
    label: str = LABEL,
    seed: int = 42,
    indexed: Sequence[str] = (),
    partitions: int | None = None,
    bins: int | None = None,
    max_labels: int = MAX_LABELS,
    **forest: object,
) -> PipelineModel:
    """Fit assembler and random forest, with Spark's default forest unless overridden.

    Only the label and the features are kept for the fit: three numbers per row
    whatever the width of the table. They are persisted because the fit passes
    over them several times; lost blocks are computed again.

    Spark draws each tree's rows part by part. Rows are dealt out by a hash of the whole
    row to a number of ``partitions`` that follows from the number of rows, and ordered
    inside them, so the same rows and seed give the same forest on any cluster.

    With ``bins`` the rows are first collapsed to weighted cells of binned features
    (:func:`medvoice.operators.collapse.collapse`), so that the fit has a size of its own.

    ``indexed`` names text columns that get a number by frequency (``<name>_idx``, the
    most frequent 0, unknown and missing ones the number of labels), for use among the
    features. The number is an ordinary one, not a category.
    """
    plain = [f for f in features if f not in {f"{c}_idx" for c in indexed}]
    rows = train.select(label, *plain, *indexed, F.xxhash64(*train.columns).alias("_row"))
    stages = [stage for c in indexed for stage in label_stages(rows, c, max_labels)]
    columns = [label, *features]
    rows = PipelineModel(stages=stages).transform(rows).select(*columns, "_row")
    if bins:
        rows, columns = collapse(rows, features, label, bins), [*columns, WEIGHT]
        rows = rows.select(*columns, F.xxhash64(*rows.columns).alias("_row"))
        forest = {"weightCol": WEIGHT, **forest}
    if partitions is None:
        partitions = max(LEAST_PARTS, -(-rows.count() // PART_ROWS))
    kept = (
        rows.repartition(partitions, "_row")
        .sortWithinPartitions("_row", *columns)
        .drop("_row")
        .persist(StorageLevel.MEMORY_AND_DISK)
    )
    try:
        regressor = RandomForestRegressor(labelCol=label, seed=seed, **forest)
        fitted = Pipeline(stages=[assembler(features), regressor]).fit(kept)
    finally:
        kept.unpersist()
    return PipelineModel(stages=[*stages, *fitted.stages])


def label_stages(df: DataFrame, column: str, max_labels: int = MAX_LABELS) -> list:
    """Fitted stages that add ``<column>_idx``; unknown and missing labels get the number of labels.

    The labels are in the model up to ``max_labels`` of them, and a table stored with it beyond.
    """
    found = df.select(column).where(F.col(column).isNotNull()).distinct().limit(max_labels + 1).count()
    if found > max_labels:
        return [LabelIndex(inputCol=column, outputCol=f"{column}_idx").fit(df)]
    index = fit_label_index(df, column, max_labels).setHandleInvalid("keep").setOutputCol(f"_{column}_label")
    # The sum leaves out the marks of a category, which would cost a bin per label.
    plain = SQLTransformer(statement=f"SELECT *, _{column}_label + 0.0D AS {column}_idx FROM __THIS__")
    return [index, plain]


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Add ``features`` and ``prediction``. Works on batch tables and streams."""
    return model.transform(df)


def evaluate(
    predictions: DataFrame, label: str = LABEL, by: Sequence[str] = ()
) -> DataFrame:
    """RMSE, RMSE of rounded predictions and rows, optionally per group, in one pass."""
    measures = (
        rmse(label, "prediction").alias("rmse"),
        rmse_rounded(label, "prediction").alias("rmse_rounded"),
        F.count(F.lit(1)).alias("n"),
    )
    return predictions.groupBy(*by).agg(*measures) if by else predictions.agg(*measures)


def save_model(model: PipelineModel, path: str) -> None:
    """Store the model, replacing an earlier one."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
