"""Gradient boosting in rounds (M8): a validation column ends the training, each round's errors are rows.

The trees are Spark's. Rows with the validation flag are never fitted; after every round their error is measured, and the training
ends at the first round that does not improve it by ``tol`` of itself. The model keeps the rounds up to the best one.
"""

from __future__ import annotations

from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillpoint.operators import ml

VALIDATION = "is_val"
#: Share of the training rows that is held out to end the training, and the salt of their choice.
VALIDATION_FRACTION = 0.2
VALIDATION_SEED = ml.SEED + 1


def hold_out(train: DataFrame, keys: list[str] = ml.SPLIT_KEYS, fraction: float = VALIDATION_FRACTION) -> DataFrame:
    """``train`` with ``is_val``: an exact share of the rows, by a salted hash of their key (see ``ml.exact_split``)."""
    return ml.exact_split(train, keys, fraction, VALIDATION_SEED).withColumnRenamed("is_test", VALIDATION)


def fit_rounds(data: DataFrame, rounds: int = 100, depth: int = 6, step: float = 0.1, tol: float = 0.01,
               **params) -> GBTRegressionModel:
    """Boosted trees over (features, label, is_val). A null flag is a training row. Without validation rows nothing ends the
    training early; without training rows there is nothing to fit and a ValueError is raised."""
    data = data.withColumn(VALIDATION, F.coalesce(F.col(VALIDATION), F.lit(False)))
    n = data.agg(F.count_if(~F.col(VALIDATION)).alias("fit"), F.count_if(VALIDATION).alias("val")).first()
    if not n.fit:
        raise ValueError("no training rows")
    if n.val:
        params = dict(validationIndicatorCol=VALIDATION, validationTol=tol, **params)
    return ml.train("GradientBoosting", data, maxIter=rounds, maxDepth=depth, stepSize=step, **params)


def round_errors(model: GBTRegressionModel, data: DataFrame) -> DataFrame:
    """(rodada, n_nos, peso, erro_treino, erro_validacao): mean squared errors of the model cut after each round. One pass over
    each part gives the errors of all rounds; a part without rows has null."""
    flag = F.coalesce(F.col(VALIDATION), F.lit(False))
    parts = [data.where(~flag), data.where(flag)]
    errors = [[None] * len(model.trees) if p.isEmpty() else model.evaluateEachIteration(p, "squared") for p in parts]
    rows = [(i + 1, tree.numNodes, float(w), errors[0][i], errors[1][i])
            for i, (tree, w) in enumerate(zip(model.trees, model.treeWeights))]
    return data.sparkSession.createDataFrame(rows, "rodada long, n_nos int, peso double, erro_treino double, erro_validacao double")
