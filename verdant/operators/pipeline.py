"""A page classifier that can be saved (K5, G6): feature steps and model as one
``PipelineModel``, so that scoring needs nothing of the session that trained it.

The category dictionary and a linear model's weights are tables of any size;
they are saved beside the parameters of their step and never collected to be saved.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verdant.operators.features import FeatureModel, with_category_index
from verdant.operators.learners import SGD_KINDS, Fitted, LinearScorer
from verdant.operators.metrics import describe_prediction


class _TableWriter(MLWriter):
    """Parameters as Spark ML writes them, and the step's table beside them."""

    def __init__(self, step):
        super().__init__()
        self.step = step

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.step, path, self.sparkSession)
        self.step.table.write.parquet(f"{path}/data")


class _TableReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str):
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        step = self.cls(table=self.sparkSession.read.parquet(f"{path}/data"))
        step._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(step, metadata)
        return step


class _TableStep(Transformer, MLReadable, MLWritable):
    """A step whose fitted state is a table."""

    table: DataFrame | None

    def write(self) -> MLWriter:
        return _TableWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _TableReader(cls)


class CategoryIndexModel(_TableStep):
    """F1 as a step: ``category_index`` from a dictionary table ``(category, category_index)``."""

    unseen = Param(Params._dummy(), "unseen", "what a row of an unknown category does: error, keep or drop", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, table: DataFrame | None = None, unseen: str = "error"):
        super().__init__()
        self.table = table
        self._setDefault(unseen="error")
        self._set(unseen=unseen)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return with_category_index(dataset, self.table, self.getOrDefault("unseen"))


class LinearScoreModel(_TableStep, HasInputCol):
    """M7 as a step: ``score`` and ``prediction`` from a weight table ``(i, w)``."""

    kind = Param(Params._dummy(), "kind", "logistic or svm", TypeConverters.toString)
    intercept = Param(Params._dummy(), "intercept", "added to the margin", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, table: DataFrame | None = None, kind: str = "logistic", intercept: float = 0.0, inputCol: str = "features"):
        super().__init__()
        self.table = table
        self._set(kind=kind, intercept=intercept, inputCol=inputCol)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        weights = [r["w"] for r in self.table.orderBy("i").collect()]        # one number a feature
        return LinearScorer(weights, self.getOrDefault("intercept"), self.getOrDefault("kind"), features=self.getInputCol())(dataset)


class ScoreColumn(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """``score``: the entry for class 1 of a model's probability or raw prediction."""

    @keyword_only
    def __init__(self, *, inputCol: str = "probability", outputCol: str = "score"):
        super().__init__()
        self._set(inputCol=inputCol, outputCol=outputCol)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumn(self.getOutputCol(), vector_to_array(F.col(self.getInputCol()), "float64")[1])


def feature_steps(fm: FeatureModel) -> list:
    output = "raw_features" if fm.scaler else "features"
    steps = [CategoryIndexModel(table=fm.dictionary, unseen=fm.unseen), fm.encoder,
             VectorAssembler(inputCols=["category_vec", *fm.numerics], outputCol=output)]
    return [*steps, fm.scaler] if fm.scaler else steps


def model_steps(spark: SparkSession, fitted: Fitted) -> list:
    if fitted.name in SGD_KINDS:
        scorer = fitted.scorer
        table = spark.createDataFrame(list(enumerate(map(float, scorer.weights))), "i int, w double")
        return [LinearScoreModel(table=table, kind=scorer.kind, intercept=float(scorer.intercept), inputCol=scorer.features)]
    return [fitted.model, ScoreColumn(inputCol="rawPrediction" if fitted.name == "linear_svc" else "probability")]


def page_pipeline(spark: SparkSession, fm: FeatureModel, fitted: Fitted | None = None) -> PipelineModel:
    """Feature steps, and the model if one is given. Takes parsed pages (``parse_pages``)."""
    return PipelineModel(feature_steps(fm) + (model_steps(spark, fitted) if fitted else []))


def score_saved(path: str, parsed: DataFrame) -> DataFrame:
    """Loads a saved classifier and scores parsed pages: ``(url, score, prediction, description)``."""
    out = PipelineModel.load(path).transform(parsed)
    return describe_prediction(out.select("url", "score", "prediction"))
