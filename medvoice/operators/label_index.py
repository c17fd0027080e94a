"""Index of a text column as a pipeline stage, for any number of labels."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param.shared import HasHandleInvalid, HasInputCol, HasOutputCol, Param, Params, TypeConverters
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
    MLReadable,
    MLReader,
    MLWritable,
    MLWriter,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medvoice.operators.joins import lookup_join
from medvoice.operators.ranks import label_ranks
from medvoice.workspace import materialize

KEEP, SKIP, ERROR = "keep", "skip", "error"
LABEL, RANK = "label", "rank"


class _Columns(HasInputCol, HasOutputCol, HasHandleInvalid):
    """What estimator and model share: column names, and what becomes of other labels.

    ``keep`` gives labels that were not seen, and missing ones, the number of labels;
    ``skip`` leaves their rows out; ``error`` fails.
    """

    def __init__(self) -> None:
        super().__init__()
        self._setDefault(handleInvalid=KEEP)

    @keyword_only
    def setParams(self, *, inputCol=None, outputCol=None, handleInvalid=KEEP):
        return self._set(**self._input_kwargs)


class LabelIndex(_Columns, Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Most frequent label 0, ties alphabetical, the ranks in a table rather than in the driver."""

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, handleInvalid=KEEP):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> LabelIndexModel:
        column = self.getInputCol()
        found = label_ranks(dataset.select(column), column)
        ranks = materialize(found.toDF(LABEL, RANK), "label-index")
        model = LabelIndexModel()._resetUid(self.uid)
        model._set(
            inputCol=column, outputCol=self.getOutputCol(), handleInvalid=self.getHandleInvalid(), labels=ranks.count()
        )
        model.ranks = ranks
        return model


class LabelIndexModel(_Columns, Model, MLReadable, MLWritable):
    """Adds the rank of a label as a plain number, by a lookup that is broadcast or salted."""

    labels = Param(Params._dummy(), "labels", "number of labels", typeConverter=TypeConverters.toInt)

    def __init__(self) -> None:
        super().__init__()
        self.ranks: DataFrame | None = None

    def _transform(self, dataset: DataFrame) -> DataFrame:
        column, output, invalid = self.getInputCol(), self.getOutputCol(), self.getHandleInvalid()
        if output in dataset.columns:
            raise ValueError(f"there is a column {output} already")
        known = self.ranks.toDF(column, output)
        joined = lookup_join(dataset, known, column, how="inner" if invalid == SKIP else "left")
        if invalid == SKIP:
            return joined.select(*dataset.columns, output)
        other = F.lit(float(self.getOrDefault("labels")))
        if invalid == ERROR:
            text = F.concat(F.lit(f"{column} has an unknown label: "), F.coalesce(column, F.lit("NULL")))
            other = F.raise_error(text).cast("double")
        return joined.select(*dataset.columns, F.coalesce(output, other).alias(output))

    def copy(self, extra=None) -> LabelIndexModel:
        that = super().copy(extra)
        that.ranks = self.ranks
        return that

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader(cls)


class _Writer(MLWriter):
    def __init__(self, model: LabelIndexModel) -> None:
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        self.model.ranks.write.parquet(f"{path}/ranks")


class _Reader(MLReader):
    def __init__(self, cls: type[LabelIndexModel]) -> None:
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> LabelIndexModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = self.cls()._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        model.ranks = self.sparkSession.read.schema(f"{LABEL} string, {RANK} double").parquet(f"{path}/ranks")
        return model
