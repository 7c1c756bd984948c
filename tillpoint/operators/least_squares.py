"""Least squares by a tall-skinny QR (M3b), with its own persistence.

Normal equations square the condition of the problem: shares that sum to almost one leave residuals that are not orthogonal to
the features. Here every task reduces its rows to a triangular factor as wide as the features, batch by batch; the factors are
merged in a tree, and the solution comes from the last one. What is shuffled, and what reaches the driver, is one small
triangle per task and then one, whatever the number of rows.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillpoint.session import materialize

#: Triangles that one merging task stacks.
FAN_IN = 32
#: Singular values below this share of the largest are no direction of the data.
RANK_TOLERANCE = 1e-11


@dataclass(frozen=True)
class LinearFit:
    """prediction = intercept + sum of coefficient x feature; ``rank`` counts the directions in the data, the intercept's too."""

    names: tuple[str, ...]
    coefficients: tuple[float, ...]
    intercept: float
    rank: int
    n: int

    def column(self, features: list[Column]) -> Column:
        """The prediction as an expression over the features, summed in their order; it stays in the JVM."""
        out = F.lit(self.intercept)
        for c, x in zip(self.coefficients, features):
            out = out + F.lit(c) * x.cast("double")
        return out

    def predict(self, df: DataFrame, features: str = "features") -> DataFrame:
        """``df`` with ``prediction`` from its vector column."""
        terms = F.zip_with(vector_to_array(features), F.array(*[F.lit(c) for c in self.coefficients]), lambda x, c: x * c)
        total = F.aggregate(terms, F.lit(self.intercept), lambda acc, x: acc + x) if self.coefficients else F.lit(self.intercept)
        return df.withColumn("prediction", total)

    def save(self, spark: SparkSession, path: str) -> None:
        """One row of Parquet, doubles in full."""
        row = (json.dumps(self.names, ensure_ascii=False), list(self.coefficients), self.intercept, self.rank, self.n)
        (spark.createDataFrame([row], "nomes string, coeficientes array<double>, intercepto double, posto int, n long")
         .coalesce(1).write.mode("overwrite").parquet(path))

    @staticmethod
    def load(spark: SparkSession, path: str) -> LinearFit:
        r = spark.read.parquet(path).first()
        return LinearFit(tuple(json.loads(r.nomes)), tuple(r.coeficientes), r.intercepto, r.posto, r.n)


def _triangle(rows: np.ndarray) -> np.ndarray:
    return np.linalg.qr(rows, mode="r")


def _as_row(group: int, r: np.ndarray, n: int) -> pd.DataFrame:
    return pd.DataFrame({"g": [group], "rows": [r.shape[0]], "n": [n], "r": [r.astype("<f8").tobytes()]})


_SCHEMA = "g long, rows int, n long, r binary"


def triangles(data: DataFrame, features: str = "features", label: str = "label") -> DataFrame:
    """One triangular factor of [1, features, label] per task. A row with a missing value takes no part."""
    def reduce_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        r, n = None, 0
        for pdf in batches:
            if not len(pdf):
                continue
            x = np.column_stack([np.ones(len(pdf)), np.stack(pdf["x"].to_numpy()), pdf["y"].to_numpy()])
            x = x[np.isfinite(x).all(axis=1)]
            n += len(x)
            r = _triangle(x if r is None else np.vstack([r, x]))
        if r is not None:
            yield _as_row(0, r, n)

    rows = data.where(F.col(label).isNotNull()).select(vector_to_array(features).alias("x"), F.col(label).cast("double").alias("y"))
    return rows.mapInPandas(reduce_rows, _SCHEMA)


def merged(parts: DataFrame, width: int, tasks: int) -> tuple[np.ndarray, int]:
    """The factor of all rows and their number: groups of ``FAN_IN`` triangles are merged, level by level."""
    def stack(pdf: pd.DataFrame) -> pd.DataFrame:
        r = _triangle(np.vstack([np.frombuffer(b, "<f8").reshape(k, width) for b, k in zip(pdf["r"], pdf["rows"])]))
        return _as_row(int(pdf["g"].iloc[0]), r, int(pdf["n"].sum()))

    parts = parts.withColumn("g", F.monotonically_increasing_id())
    while True:
        tasks = -(-tasks // FAN_IN)
        parts = parts.withColumn("g", F.pmod(F.xxhash64("g"), F.lit(tasks))).groupBy("g").applyInPandas(stack, _SCHEMA)
        if tasks == 1:
            rows = parts.collect()  # one triangle
            return (np.frombuffer(rows[0].r, "<f8").reshape(rows[0].rows, width), rows[0].n) if rows else (np.zeros((0, width)), 0)


def fit(data: DataFrame, names: list[str], features: str = "features", label: str = "label") -> LinearFit:
    """Least squares with an intercept. Columns are scaled by their length, so that their units do not matter; of several
    solutions (features that depend on each other) the one of least length in that scale. No row: all zero."""
    width = len(names) + 2
    parts = materialize(triangles(data, features, label), "triangulos")
    r, n = merged(parts, width, max(1, parts.count()))
    if not n:
        return LinearFit(tuple(names), (0.0,) * len(names), 0.0, 0, 0)
    a, b = r[:, :-1], r[:, -1]
    scale = np.linalg.norm(a, axis=0)
    scale = np.where(scale > 0, scale, 1.0)
    beta, _, rank, _ = np.linalg.lstsq(a / scale, b, rcond=RANK_TOLERANCE)
    beta = beta / scale
    return LinearFit(tuple(names), tuple(beta[1:].tolist()), float(beta[0]), int(rank), n)


def orthogonality(scored: DataFrame, names: list[str], features: str = "features", label: str = "label") -> DataFrame:
    """(feature, cosseno) of the residuals with every feature and the intercept: 0 for least squares. One aggregate."""
    rows = scored.select(vector_to_array(features).alias("_x"), (F.col(label) - F.col("prediction")).alias("_e"))
    columns = [F.lit(1.0), *[F.col("_x")[i] for i in range(len(names))]]
    sums = rows.agg(F.sum(F.col("_e") * F.col("_e")).alias("ee"), *[F.sum(c * F.col("_e")).alias(f"xe{i}") for i, c in enumerate(columns)],
                    *[F.sum(c * c).alias(f"xx{i}") for i, c in enumerate(columns)])
    pairs = F.array(*[F.struct(F.lit(n).alias("feature"), F.coalesce(F.col(f"xe{i}") / F.nullif(
        F.sqrt(F.col(f"xx{i}") * F.col("ee")), F.lit(0.0)), F.lit(0.0)).alias("cosseno")) for i, n in enumerate(["intercepto", *names])])
    return sums.select(F.inline(pairs))
