"""What the fitted stages share: a state table, written as Parquet beside the stage's parameters."""

from __future__ import annotations

import posixpath

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.util import (DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable,
                             MLReader, MLWritable, MLWriter)
from pyspark.sql import DataFrame


class _StateWriter(MLWriter):
    def __init__(self, stage: StateModel):
        super().__init__()
        self.stage = stage

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.stage, path, self.sparkSession)
        self.stage.state.write.parquet(posixpath.join(path, "state"))


class _StateReader(MLReader):
    def __init__(self, kind: type[StateModel]):
        super().__init__()
        self.kind = kind

    def load(self, path: str) -> StateModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        stage = self.kind(self.sparkSession.read.parquet(posixpath.join(path, "state")))
        stage._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(stage, metadata)
        return stage


class StateModel(Model, MLWritable, MLReadable):
    """A fitted stage whose whole state is the table ``state``."""

    def __init__(self, state: DataFrame | None = None):
        super().__init__()
        self.state = state

    def write(self) -> MLWriter:
        return _StateWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _StateReader(cls)


class StateEstimator(Estimator, DefaultParamsWritable, DefaultParamsReadable):
    """Learns a state table in ``learn`` and hands it, with its own parameters, to ``model``."""

    model: type[StateModel]

    def learn(self, rows: DataFrame) -> DataFrame:
        raise NotImplementedError

    def _fit(self, dataset: DataFrame) -> StateModel:
        return self._copyValues(self.model(self.learn(dataset)))


class PlainTransformer(Transformer, DefaultParamsWritable, DefaultParamsReadable):
    """A stage without state of its own; its parameters are saved."""


def one_row(df: DataFrame) -> DataFrame:
    """A row of statistics, computed once."""
    return df.sparkSession.createDataFrame(df.collect(), df.schema)


__all__ = ["PlainTransformer", "StateEstimator", "StateModel", "keyword_only", "one_row"]
