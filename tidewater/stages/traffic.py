"""Stages of the traffic domain: A9 high label, A10/R3 categories, T4/J2 peak times, F21/F22 adjustment, R2 decision."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions import scalar
from tidewater.operators import categories
from tidewater.stages.base import PlainTransformer, StateEstimator, StateModel, keyword_only, one_row


class _High(HasInputCol, HasOutputCol):
    percentile = Param(Params._dummy(), "percentile", "percentile of the threshold", TypeConverters.toFloat)
    thresholdCol = Param(Params._dummy(), "thresholdCol", "column for the threshold", TypeConverters.toString)

    def __init__(self):
        super().__init__()
        self._setDefault(percentile=75.0, thresholdCol="tpm_threshold")


class HighLabelModel(StateModel, _High):
    def _transform(self, dataset: DataFrame) -> DataFrame:
        name = self.getOrDefault(self.thresholdCol)
        limit = self.state.select(F.col("threshold").alias(name))
        return dataset.drop(name).crossJoin(F.broadcast(limit)).withColumn(  # one row
            self.getOutputCol(), F.when(F.col(self.getInputCol()) >= F.col(name), 1.0).otherwise(0.0))


class HighLabel(StateEstimator, _High):
    """1 from the exact percentile of the rows it was fitted to, with the threshold beside it."""

    model = HighLabelModel

    @keyword_only
    def __init__(self, *, inputCol: str | None = None, outputCol: str | None = None, percentile: float = 75.0,
                 thresholdCol: str = "tpm_threshold"):
        super().__init__()
        self._set(**self._input_kwargs)

    def learn(self, rows: DataFrame) -> DataFrame:
        return one_row(categories.threshold(rows, self.getInputCol(), self.getOrDefault(self.percentile)))


class _Bins(HasInputCol, HasOutputCol):
    bins = Param(Params._dummy(), "bins", "number of categories", TypeConverters.toInt)
    openEnded = Param(Params._dummy(), "openEnded", "values outside the fitted range take the outer categories",
                      TypeConverters.toBoolean)

    def __init__(self):
        super().__init__()
        self._setDefault(bins=3, openEnded=True)


class CategoryThresholdsModel(StateModel, _Bins):
    def _transform(self, dataset: DataFrame) -> DataFrame:
        n, out = self.getOrDefault(self.bins), self.getOutputCol()
        if not self.getOrDefault(self.openEnded):
            return categories.categorise(dataset, self.getInputCol(), n, out, thresholds=self.state)
        return categories.assign_category(dataset, self.state, self.getInputCol(), out, n)


class CategoryThresholds(StateEstimator, _Bins):
    """Categories by the exact quantiles of the rows it was fitted to."""

    model = CategoryThresholdsModel

    @keyword_only
    def __init__(self, *, inputCol: str | None = None, outputCol: str | None = None, bins: int = 3, openEnded: bool = True):
        super().__init__()
        self._set(**self._input_kwargs)

    def learn(self, rows: DataFrame) -> DataFrame:
        return one_row(categories.edges(rows, self.getInputCol(), self.getOrDefault(self.bins)))


class _Times(Params):
    categoryCol = Param(Params._dummy(), "categoryCol", "category column", TypeConverters.toString)
    hourCol = Param(Params._dummy(), "hourCol", "hour column", TypeConverters.toString)
    dayCol = Param(Params._dummy(), "dayCol", "weekday column", TypeConverters.toString)

    def __init__(self):
        super().__init__()
        self._setDefault(categoryCol="tpm_category", hourCol="hour", dayCol="day_of_week")

    def _names(self) -> tuple[str, str, str]:
        return tuple(self.getOrDefault(p) for p in (self.categoryCol, self.hourCol, self.dayCol))


class PeakTimesModel(StateModel, _Times):
    def _transform(self, dataset: DataFrame) -> DataFrame:
        cat, hour, day = self._names()
        return categories.peak_flags(dataset, self.state.withColumnRenamed("category", cat), cat, hour, day)


class PeakTimes(StateEstimator, _Times):
    """T4: the peak hours and days of each category in the rows it was fitted to; flags (J2) on others."""

    model = PeakTimesModel

    @keyword_only
    def __init__(self, *, categoryCol: str = "tpm_category", hourCol: str = "hour", dayCol: str = "day_of_week"):
        super().__init__()
        self._set(**self._input_kwargs)

    def learn(self, rows: DataFrame) -> DataFrame:
        cat, hour, day = self._names()
        return one_row(categories.peak_times(rows, hour, day, cat).withColumnRenamed(cat, "category"))  # 5 a category


class CategoryAdjustment(PlainTransformer):
    """adjusted_{h} of every pred_{h}, and whether any changed."""

    horizons = Param(Params._dummy(), "horizons", "forecast horizons in minutes", TypeConverters.toListInt)
    categoryCol = Param(Params._dummy(), "categoryCol", "category column", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, horizons: list[int] | None = None, categoryCol: str = "tpm_category"):
        super().__init__()
        self._setDefault(categoryCol="tpm_category")
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return categories.adjust_predictions(dataset, self.getOrDefault(self.horizons), self.getOrDefault(self.categoryCol))


class DecisionLabel(PlainTransformer):
    """The probability of class 1, the predicted class, and High above a probability."""

    threshold = Param(Params._dummy(), "threshold", "probability above which the recommendation is High",
                      TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, threshold: float = 0.7):
        super().__init__()
        self._setDefault(threshold=0.7)
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        chance = vector_to_array("probability")[1]
        return dataset.withColumns({
            "probability_high": chance, "predicted_high": F.col("prediction") == 1.0,
            "recommendation": scalar.label_from_probability(chance, self.getOrDefault(self.threshold))})
