"""Fitted steps as Spark ML stages: what is learnt from train rows is saved and loaded with the pipeline.

``prepare`` holds imputer, label codes, scaler and feature alignment, ``traffic``
thresholds, peak times and the category adjustment. They combine with MLlib's own
stages in one ``Pipeline``; ``PipelineModel.save`` and ``load`` keep them whole.
"""

from tidewater.stages.prepare import AlignFeatures, LabelCodes, MeanImputer, ResolveAliases, TrainScaler
from tidewater.stages.traffic import CategoryAdjustment, CategoryThresholds, DecisionLabel, HighLabel, PeakTimes

__all__ = ["AlignFeatures", "CategoryAdjustment", "CategoryThresholds", "DecisionLabel", "HighLabel", "LabelCodes",
           "MeanImputer", "PeakTimes", "ResolveAliases", "TrainScaler"]
