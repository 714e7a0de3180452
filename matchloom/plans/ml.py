"""Training: feature vectors, gradient-boosted trees, importance cut, grid search by AUC, persistence."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import Imputer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pipeline(features: list[str], label: str = "RESULT", depth: int = 4, rounds: int = 20) -> Pipeline:
    filled = [f"{c}__f" for c in features]
    return Pipeline(stages=[Imputer(inputCols=features, outputCols=filled), VectorAssembler(inputCols=filled, outputCol="__x"), GBTClassifier(featuresCol="__x", labelCol=label, maxDepth=depth, maxIter=rounds, seed=7)])


def important(model: PipelineModel, features: list[str], percentile: float = 80.0) -> list[str]:
    """Features whose importance is in the top 100 - percentile per cent."""
    pairs = sorted(zip(model.stages[-1].featureImportances.toArray(), features), reverse=True)
    return [f for _, f in pairs[: max(1, round(len(pairs) * (100 - percentile) / 100))]]


def train(df: DataFrame, features: list[str], label: str = "RESULT", percentile: float = 80.0) -> tuple[PipelineModel, list[str]]:
    df = df.withColumns({c: F.col(c).cast("double") for c in features} | {label: F.col(label).cast("double")})
    chosen = important(pipeline(features, label).fit(df), features, percentile)
    return pipeline(chosen, label).fit(df), chosen


def tune(df: DataFrame, features: list[str], label: str = "RESULT", depths=(3, 5), rounds=(10, 20), folds: int = 5):
    p = pipeline(features, label)
    gbt = p.getStages()[-1]
    grid = ParamGridBuilder().addGrid(gbt.maxDepth, list(depths)).addGrid(gbt.maxIter, list(rounds)).build()
    return CrossValidator(estimator=p, estimatorParamMaps=grid, evaluator=BinaryClassificationEvaluator(labelCol=label), numFolds=folds, seed=7, parallelism=2).fit(df)


def predict(model: PipelineModel, df: DataFrame, features: list[str]) -> DataFrame:
    scored = model.transform(df.withColumns({c: F.col(c).cast("double") for c in features}))
    return scored.withColumn("p1", vector_to_array("probability")[1]).drop("__x", "rawPrediction", "probability", *[f"{c}__f" for c in features])


def auc(scored: DataFrame, label: str = "RESULT") -> float:
    return BinaryClassificationEvaluator(labelCol=label, rawPredictionCol="p1").evaluate(scored.withColumn(label, F.col(label).cast("double")))


def accuracy(scored: DataFrame, label: str = "RESULT") -> DataFrame:
    return scored.agg(F.avg(((F.col("p1") >= 0.5).cast("int") == F.col(label)).cast("double")).alias("accuracy"))
