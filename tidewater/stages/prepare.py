"""Stages that prepare columns: N1 imputer, E1 label codes, E4 scaler, P3 aliases, P6 feature order."""

from __future__ import annotations

import json

from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasInputCols, HasOutputCol, HasOutputCols
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.session import materialize
from tidewater.stages.base import PlainTransformer, StateEstimator, StateModel, keyword_only, one_row


def _value(column: str) -> Column:
    """A number, with NaN as null."""
    value = F.col(f"`{column}`").cast("double")
    return F.when(~F.isnan(value), value)


class _Columns(HasInputCols, HasOutputCols):
    def _pairs(self) -> list[tuple[int, str, str]]:
        ins = self.getInputCols()
        outs = self.getOutputCols() if self.isSet(self.outputCols) else ins
        if len(ins) != len(outs):
            raise ValueError("inputCols and outputCols differ in length")
        return [(i, a, b) for i, (a, b) in enumerate(zip(ins, outs, strict=True))]


class MeanImputerModel(StateModel, _Columns):
    def _transform(self, dataset: DataFrame) -> DataFrame:
        out = dataset.crossJoin(F.broadcast(self.state))  # one row
        out = out.withColumns({b: F.coalesce(_value(a), F.col(f"_mean_{i}")) for i, a, b in self._pairs()})
        return out.drop(*[f"_mean_{i}" for i, _, _ in self._pairs()])


class MeanImputer(StateEstimator, _Columns):
    """Null and NaN become the mean of the rows it was fitted to; a column without values stays null."""

    model = MeanImputerModel

    @keyword_only
    def __init__(self, *, inputCols: list[str] | None = None, outputCols: list[str] | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def learn(self, rows: DataFrame) -> DataFrame:
        return one_row(rows.agg(*[F.avg(_value(a)).alias(f"_mean_{i}") for i, a, _ in self._pairs()]))


class TrainScalerModel(StateModel, _Columns):
    def _transform(self, dataset: DataFrame) -> DataFrame:
        out = dataset.crossJoin(F.broadcast(self.state))  # one row
        out = out.withColumns({b: (F.col(f"`{a}`") - F.col(f"_mean_{i}")) / F.col(f"_scale_{i}") for i, a, b in self._pairs()})
        return out.drop(*[f"_{n}_{i}" for i, _, _ in self._pairs() for n in ("mean", "scale")])


class TrainScaler(StateEstimator, _Columns):
    """(x - mean) / population standard deviation of the rows it was fitted to; no variance scales by 1."""

    model = TrainScalerModel

    @keyword_only
    def __init__(self, *, inputCols: list[str] | None = None, outputCols: list[str] | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def learn(self, rows: DataFrame) -> DataFrame:
        found = rows.agg(*[x for i, a, _ in self._pairs() for x in (
            F.avg(_value(a)).alias(f"_mean_{i}"), F.stddev_pop(_value(a)).alias(f"_scale_{i}"))])
        return one_row(found.withColumns({f"_scale_{i}": F.when(F.col(f"_scale_{i}") == 0, 1.0).otherwise(F.col(f"_scale_{i}"))
                                          for i, _, _ in self._pairs()}))


class LabelCodesModel(StateModel, HasInputCol, HasOutputCol):
    def _transform(self, dataset: DataFrame) -> DataFrame:
        label, code = self.getInputCol(), self.getOutputCol()
        codes = self.state.select(F.col("label").alias("_label"), F.col("code").alias(code))
        return (dataset.join(codes, F.col(f"`{label}`") == F.col("_label"), "left")
                .select(*[F.col(f"`{c}`") for c in dataset.columns if c != code], code))


class LabelCodes(StateEstimator, HasInputCol, HasOutputCol):
    """Codes from 0 in the labels' order; null, and a label the fit did not see, have a null code.

    The codes are a table of their own, so the labels' number is not bounded.
    """

    model = LabelCodesModel

    @keyword_only
    def __init__(self, *, inputCol: str | None = None, outputCol: str | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def learn(self, rows: DataFrame) -> DataFrame:
        from tidewater.operators.temporal import sequence_number
        labels = rows.select(F.col(f"`{self.getInputCol()}`").alias("label")).where("label IS NOT NULL").distinct()
        numbered = sequence_number(labels, ["label"], "code")
        return materialize(numbered.select("label", F.col("code").cast("double").alias("code")))


class AlignFeatures(PlainTransformer):
    """Every feature is there as a double, 0 where the column or its value is missing; the list is saved."""

    features = Param(Params._dummy(), "features", "feature names in training order", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, features: list[str] | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        have = set(dataset.columns)
        return dataset.withColumns({f: F.coalesce(_value(f), F.lit(0.0)) if f in have else F.lit(0.0)
                                    for f in self.getOrDefault(self.features)})


class ResolveAliases(PlainTransformer):
    """Each logical name gets the first of its candidate columns that exists; the mapping is saved."""

    candidates = Param(Params._dummy(), "candidates", "JSON of name -> candidate columns", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, candidates: str | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        have = set(dataset.columns)
        found = {name: next((a for a in names if a in have), None)
                 for name, names in json.loads(self.getOrDefault(self.candidates)).items()}
        return dataset.withColumns({name: F.col(f"`{a}`") for name, a in found.items() if a and a != name})
