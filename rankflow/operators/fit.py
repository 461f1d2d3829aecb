"""Fitting: per-task baselines and the two-tower model."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.classification import FMClassifier, LogisticRegression
from pyspark.ml.feature import FeatureHasher
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame

from rankflow.session import written

TASK_LABELS = {"ctr": "ctr_label", "fvtr": "finish_view_label", "unlock": "unlock_label", "cvr": "cvr_label"}


def fit_tasks(df: DataFrame, features: Sequence[str], labels: Mapping[str, str] = TASK_LABELS, hash_bits: int = 18,
              max_iter: int = 10) -> dict[str, PipelineModel]:
    """One logistic regression per task on the same hashed features.

    The hashed frame is written once and read by every task's fit.
    """
    hasher = FeatureHasher(inputCols=list(features), outputCol="hashed", numFeatures=1 << hash_bits)
    hashed = written(hasher.transform(df).select("hashed", *labels.values()), "hashed")
    models = {}
    for task, label in labels.items():
        step = LogisticRegression(featuresCol="hashed", labelCol=label, maxIter=max_iter, probabilityCol=f"p_{task}",
                                  rawPredictionCol=f"raw_{task}", predictionCol=f"hit_{task}")
        models[task] = PipelineModel([hasher, step.fit(hashed)])
    return models


def predict_tasks(df: DataFrame, models: Mapping[str, PipelineModel]) -> DataFrame:
    """Add each task's probability under the task's name, in one pass."""
    columns = df.columns
    hashed = next(iter(models.values())).stages[0].transform(df)
    for model in models.values():
        hashed = model.stages[1].transform(hashed)
    return hashed.select(*columns, *[vector_to_array(f"p_{t}")[1].alias(t) for t in models])


def fit_two_tower(df: DataFrame, actor: str, receiver: str, label: str, factors: int = 15, hash_bits: int = 16,
                  max_iter: int = 20) -> PipelineModel:
    """Factorisation machine over two one-hot ids: a bias per id plus the product of their vectors."""
    hasher = FeatureHasher(inputCols=[actor, receiver], outputCol="pair", numFeatures=1 << hash_bits,
                           categoricalCols=[actor, receiver])
    fm = FMClassifier(featuresCol="pair", labelCol=label, factorSize=factors, maxIter=max_iter, stepSize=0.05, seed=42)
    hashed = written(hasher.transform(df).select("pair", label), "pair")
    return PipelineModel([hasher, fm.fit(hashed)])


def predict_two_tower(df: DataFrame, model: PipelineModel) -> DataFrame:
    return model.transform(df).select(*df.columns, vector_to_array("probability")[1].alias("score"))
