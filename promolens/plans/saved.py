"""A fitted job as one saved model: clip bounds, preprocessing, classifier,
acceptance probability, standardisation and segments, in this order.

The model reads a feature frame (``features.add_features``) and adds what the
job added: ``accept_prob`` and, unless segmentation was skipped, ``segment``. The
parts that Spark ML has no stage for are two small transformers, saved as JSON.
"""

from __future__ import annotations

import json

from pyspark import keyword_only
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OUTPUTS = ("accept_prob", "segment")


class WithColumns(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Adds or replaces columns by SQL expressions on the input (all read the input's columns)."""

    columns = Param(Params._dummy(), "columns", "name -> SQL expression, as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, columns: str = "{}"):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        made = json.loads(self.getOrDefault(self.columns))
        return df.withColumns({c: F.expr(e) for c, e in made.items()}) if made else df


class AcceptProbability(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """``accept_prob`` = 1 - P(rejected) from the classifier's ``probability``."""

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn("accept_prob", F.lit(1.0) - vector_to_array(F.col("probability"))[1])


class MeanProbability(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """``probability`` of a forest fitted in parts: the mean of the parts' probabilities, each counting as many times as it has trees."""

    parts = Param(Params._dummy(), "parts", "probability column -> number of trees, as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, parts: str = "{}"):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        parts = json.loads(self.getOrDefault(self.parts))
        votes = [sum((vector_to_array(F.col(c))[k] * F.lit(float(n)) for c, n in parts.items()), F.lit(0.0)) for k in (0, 1)]
        return df.withColumn("probability", array_to_vector(F.array(*[v / F.lit(float(sum(parts.values()))) for v in votes])))


def _double(v: float) -> str:
    return f"CAST('{v!r}' AS DOUBLE)"


def clip_sql(name: str, low: float | None, high: float | None) -> str:
    out = f"`{name}`"
    if low is not None:
        out = f"greatest({out}, {_double(low)})"
    if high is not None:
        out = f"least({out}, {_double(high)})"
    return f"CASE WHEN `{name}` IS NOT NULL THEN {out} END"


def scoring_model(train, segments) -> PipelineModel:
    """One model from a ``TrainResult`` and a ``SegmentResult``."""
    clips = {c: clip_sql(c, lo, hi) for c, (lo, hi) in train.bounds.items() if lo is not None or hi is not None}
    stages = [WithColumns(columns=json.dumps(clips)), *train.model.stages, AcceptProbability()]
    if segments.model is not None:
        z = [f"z_{c}" for c in segments.inputs.features]
        stages += [WithColumns(columns=json.dumps(dict(zip(z, segments.inputs.z_sql, strict=True)))),
                   WithColumns(columns=json.dumps({"segment": f"CAST({segments.model.sql()} AS INT)"}))]
    return PipelineModel(stages)


def score(features: DataFrame, model: PipelineModel) -> DataFrame:
    """``features`` (clipped) with the model's outputs."""
    out = model.transform(features)
    return out.select(*[f"`{c}`" for c in features.columns], *[c for c in OUTPUTS if c in out.columns])
