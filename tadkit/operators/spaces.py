"""Feature spaces of one dataset as fitted, persistable pipelines.

``WoeEncoder`` is an estimator like any other of ``pyspark.ml``: it stands in a
``Pipeline``, and the fitted model is saved and loaded with it.  Its map is a
table (variable, bin, woe), written as Parquet, so categories need not fit in
the metadata.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.feature import MinMaxScaler, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param.shared import HasInputCols, HasLabelCol, HasOutputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MISSING = "Missings"


class _WoeParams(HasInputCols, HasOutputCols, HasLabelCol):
    """Columns to encode, their encoded names and the 0/1 target."""


class WoeEncoder(Estimator, _WoeParams, DefaultParamsReadable, DefaultParamsWritable):
    """Weight of evidence ln(%non-events / %events) of categories, both counts at least 0.5.

    Nulls are a category.  ``outputCols`` are ``<input>_woe`` if not given.
    """

    @keyword_only
    def __init__(self, *, inputCols: Sequence[str] | None = None, outputCols: Sequence[str] | None = None, labelCol: str = "label"):
        super().__init__()
        self._setDefault(labelCol="label")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> WoeEncoderModel:
        from tadkit.operators.stats import woe_table
        cols = self.getInputCols()
        target = self.getOrDefault(self.labelCol)
        x = dataset.select(F.col(target).cast("int").alias(target), *[F.col(c).cast("string").alias(c) for c in cols])
        table = woe_table(x, target, cols, orientation="non/events", max_levels=1 << 30, missing=MISSING).select("variable", "bin", "woe")
        outputs = self.getOutputCols() if self.isDefined(self.outputCols) else [f"{c}_woe" for c in cols]
        return WoeEncoderModel(table)._set(inputCols=cols, outputCols=outputs, labelCol=target)


class WoeEncoderModel(Model, _WoeParams, MLReadable, MLWritable):
    """Replaces categories by their weight of evidence; one never seen has none, 0."""

    def __init__(self, table: DataFrame | None = None):
        super().__init__()
        self.table = table

    def _transform(self, dataset: DataFrame) -> DataFrame:
        out = dataset
        for c, name in zip(self.getInputCols(), self.getOutputCols()):
            m = self.table.filter(F.col("variable") == c).select(F.col("bin").alias("_bin"), F.col("woe").alias("_woe"))
            out = out.join(m, F.coalesce(F.col(c).cast("string"), F.lit(MISSING)) == F.col("_bin"), "left") \
                .withColumn(name, F.coalesce("_woe", F.lit(0.0))).drop("_bin", "_woe")
        return out

    def write(self) -> MLWriter:
        return _WoeWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _WoeReader()


class _WoeWriter(MLWriter):
    def __init__(self, model: WoeEncoderModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        self.model.table.write.mode("overwrite").parquet(f"{path.rstrip('/')}/data")


class _WoeReader(MLReader):
    def load(self, path: str) -> WoeEncoderModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = WoeEncoderModel(self.sparkSession.read.parquet(f"{path.rstrip('/')}/data"))
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model


def fit_spaces(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], target: str, variance: float = 0.9) -> dict[str, PipelineModel]:
    """Fitted pipelines by space: raw, minmax and standard of the numeric columns, pca (components up
    to ``variance`` of the standardised ones) and woe (of the categorical ones).  Each makes
    a vector ``space``; rows with a null number are skipped there."""
    from tadkit.operators.features import pca_fit
    raw = VectorAssembler(inputCols=list(numeric), outputCol="space", handleInvalid="skip")
    part = VectorAssembler(inputCols=list(numeric), outputCol="_raw", handleInvalid="skip")
    encoder = WoeEncoder(inputCols=list(categorical), labelCol=target)
    fitted = {
        "raw": Pipeline(stages=[raw]).fit(df),
        "minmax": Pipeline(stages=[part, MinMaxScaler(inputCol="_raw", outputCol="space")]).fit(df),
        "standard": Pipeline(stages=[part, StandardScaler(inputCol="_raw", outputCol="space", withMean=True)]).fit(df),
        "pca": pca_fit(df, numeric, variance=variance),
        "woe": Pipeline(stages=[encoder, VectorAssembler(inputCols=[f"{c}_woe" for c in categorical], outputCol="space")]).fit(df),
    }
    fitted["pca"].stages[-1].setOutputCol("space")
    return fitted


def save_spaces(spaces: dict[str, PipelineModel], path: str) -> None:
    for name, model in spaces.items():
        model.write().overwrite().save(f"{path.rstrip('/')}/{name}")


def load_spaces(path: str, names: Sequence[str] = ("raw", "minmax", "standard", "pca", "woe")) -> dict[str, PipelineModel]:
    return {n: PipelineModel.load(f"{path.rstrip('/')}/{n}") for n in names}


def in_spaces(spaces: dict[str, PipelineModel], df: DataFrame, key: str) -> DataFrame:
    """key, space, values (an array) of each row in each space."""
    out = None
    for name, model in spaces.items():
        t = model.transform(df).select(key, F.lit(name).alias("space"), vector_to_array("space").alias("values"))
        out = t if out is None else out.unionByName(t)
    return out
