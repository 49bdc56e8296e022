"""Rejection-propensity classifier as a Spark ML pipeline.

Positive class = rejected (``Accepted == 0``; a missing label counts as
accepted). The proposals are winsorised, a balanced sample is drawn and
split 80/20 per class by hash order, the preprocessing (one-hot with
unseen categories as all zeros, median imputation fitted on the training
split) and the classifier form one ``Pipeline``; every proposal is scored
with ``accept_prob = 1 - P(rejected)``.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promolens.config import PipelineConfig
from promolens.functions.numeric import lenient_label
from promolens.operators import curves, sampling
from promolens.operators.boosting import BoostedTrees, BoostParams
from promolens.operators.forest import Forest
from promolens.operators.quantiles import exact_quantiles
from promolens.plans.features import CLASSIFIER_REQUIRED, clip_bounds, feature_columns, require_columns, winsorize
from promolens.plans.saved import MeanProbability
from promolens.session import reliable_checkpoint

MISSING_CATEGORY = "__missing__"
# Spark's fit of a forest holds two numbers a training row and tree (how often the tree drew the row, where the row stands):
# beyond so many rows x trees the forest is grown by ``operators.forest``, which holds neither.
SPARK_ROW_TREES = 500_000_000
# Trees do not depend on one another: beyond so many rows x trees they are fitted in parts, one after the other, so that
# a pass over the rows does not grow with their number times the trees.
ROW_TREES = 1_500_000_000


@dataclass
class TrainResult:
    model: PipelineModel
    scored: DataFrame       # input (winsorised) + accept_prob, scored as it is read
    metrics: DataFrame      # (section, metric, value)
    auc: float | None       # None: the test split lacks a class
    pr_auc: float
    best_threshold: float
    best_f1: float
    class_report: DataFrame
    bounds: dict


def rejection_label(df: DataFrame) -> DataFrame:
    """``label``: 1 = rejected; a missing or unreadable ``Accepted`` counts as accepted."""
    return df.withColumn("label", F.when(lenient_label(F.col("Accepted")) == 0, 1).otherwise(0))


def _prep_stages(train: DataFrame, cats: list[str], nums: list[str]):
    """Preprocessing stages fitted on the training split only."""
    stages = []
    if cats:
        fill = ", ".join(f"coalesce(CAST(`{c}` AS STRING), '{MISSING_CATEGORY}') AS `{c}__cat`" for c in cats)
        stages.append(SQLTransformer(statement=f"SELECT *, {fill} FROM __THIS__"))
        stages.append(StringIndexer(inputCols=[f"{c}__cat" for c in cats], outputCols=[f"{c}__idx" for c in cats],
                                    handleInvalid="keep", stringOrderType="alphabetAsc"))
        # dropLast drops the slot of unseen values: unseen -> all zeros
        stages.append(OneHotEncoder(inputCols=[f"{c}__idx" for c in cats], outputCols=[f"{c}__oh" for c in cats],
                                    dropLast=True, handleInvalid="keep"))
    med = exact_quantiles(train, nums, [0.5]) if nums else {}
    kept = [c for c in nums if med[c][0] is not None]  # all-missing columns are dropped, as the imputer does
    if kept:
        imp = ", ".join(f"coalesce(CAST(`{c}` AS DOUBLE), CAST({med[c][0]!r} AS DOUBLE)) AS `{c}__num`" for c in kept)
        stages.append(SQLTransformer(statement=f"SELECT *, {imp} FROM __THIS__"))
    inputs = [f"{c}__oh" for c in cats] + [f"{c}__num" for c in kept]
    stages.append(VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="keep"))
    return stages, kept


def make_classifier(cfg: PipelineConfig, forest=RandomForestClassifier):
    if cfg.model == "rf":
        return forest(labelCol="label", featuresCol="features", weightCol="weight",
                      numTrees=cfg.rf_num_trees, maxDepth=cfg.rf_max_depth, seed=cfg.seed,
                      featureSubsetStrategy="sqrt", maxMemoryInMB=1024, cacheNodeIds=True)
    if cfg.model in ("gbt", "lightgbm"):
        return BoostedTrees(BoostParams(rounds=cfg.gbt_max_iter, step=cfg.gbt_step_size, leaves=cfg.num_leaves,
                                        min_rows=cfg.min_instances_per_node, row_share=cfg.subsampling_rate,
                                        column_share=cfg.column_share, seed=cfg.seed))
    raise ValueError(f"unknown model {cfg.model!r}: use 'gbt' or 'rf'")


def classifier_stages(cfg: PipelineConfig, n_rows: int) -> list:
    """The classifier for ``n_rows`` training rows; a forest in as many parts as keep its working set bounded."""
    n_parts = min(cfg.rf_num_trees, math.ceil(n_rows * cfg.rf_num_trees / ROW_TREES)) if cfg.model == "rf" else 1
    if n_parts <= 1:
        return [make_classifier(cfg, Forest if n_rows * cfg.rf_num_trees > SPARK_ROW_TREES else RandomForestClassifier)]
    share, more = divmod(cfg.rf_num_trees, n_parts)
    trees = [share + (i < more) for i in range(n_parts)]
    forests = [make_classifier(cfg, Forest).setNumTrees(n).setSeed(cfg.seed + 1_000_003 * i).setPredictionCol(f"prediction_{i}")
               .setRawPredictionCol(f"votes_{i}").setProbabilityCol(f"probability_{i}") for i, n in enumerate(trees)]
    rows: dict = {}  # binned by the first part, read by all
    for i, f in enumerate(forests):
        f.share, f.leads = rows, i == 0
    return [*forests, MeanProbability(parts=json.dumps({f"probability_{i}": n for i, n in enumerate(trees)}))]


def p_positive(df: DataFrame, out: str = "reject_prob") -> DataFrame:
    return df.withColumn(out, vector_to_array(F.col("probability"))[1])


def train_and_score(df: DataFrame, cfg: PipelineConfig) -> TrainResult:
    require_columns(df, CLASSIFIER_REQUIRED, "classifier")
    # The feature frame feeds a dozen jobs (bounds, sample thresholds, fit,
    # scoring): materialise it once in the shared checkpoint folder.
    df = reliable_checkpoint(df, spread=True)
    bounds = clip_bounds(df)
    data = rejection_label(winsorize(df, bounds))
    cats, nums = feature_columns(data)

    sample = sampling.balanced_sample(data, "label", "ProposalID", neg_ratio=cfg.neg_ratio, seed=cfg.seed)
    split = sampling.stratified_split(sample, "label", "ProposalID", cfg.test_fraction, seed=f"{cfg.seed}-split")
    split = reliable_checkpoint(split, spread=True)  # cut lineage: reused by fit, medians and evaluation
    train = split.where(F.col("split") == "train")
    test = split.where(F.col("split") == "test")
    if cfg.oversample:
        train = sampling.oversample(train, "label", "ProposalID", seed=f"{cfg.seed}-over").drop("copy_no")
    counts = sampling.class_counts(train, "label")
    train = sampling.with_weights(train, "label", counts)

    stages, kept = _prep_stages(train, cats, nums)
    model = Pipeline(stages=stages + classifier_stages(cfg, sum(counts.values()))).fit(train)

    ev = reliable_checkpoint(p_positive(model.transform(test)).select("ProposalID", "label", "reject_prob"))
    summ = curves.binary_summary(ev, "reject_prob", "label", 1)
    auc, pr_auc = summ["auc"], summ["pr_auc"]
    thr, f1 = (summ["best_threshold"], summ["best_f1"]) if summ["best_threshold"] is not None else (0.5, 0.0)
    report = curves.classification_report(ev, "reject_prob", "label", thr, 1, names=("Accepted", "Rejected"))

    scored = (p_positive(model.transform(data))
              .withColumn("accept_prob", F.lit(1.0) - F.col("reject_prob"))
              .select(*df.columns, "accept_prob"))
    spark = df.sparkSession
    metrics = spark.createDataFrame(
        [("classifier", "auc", auc), ("classifier", "pr_auc", pr_auc),
         ("classifier", "best_threshold", float(thr)), ("classifier", "best_f1", float(f1))],
        "section string, metric string, value double")
    return TrainResult(model, scored, metrics, auc, pr_auc, float(thr), float(f1), report, bounds)
