"""Quality classifier: random Fourier features of document statistics, ridge regression, isotonic calibration."""

from __future__ import annotations

import operator
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillpoint.session import materialize

#: Number of statistics of a text.
N_STATS = 15
FEATURES = 192
RIDGE = 1e-3
SEED = 20240
#: Raw scores are calibrated on a fixed grid of this many cells between -1 and 2.
CELLS = 3000
LOW, HIGH = -1.0, 2.0


def text_stats(text: str | None) -> list[float]:
    """Statistics of one whole text; nothing but the text enters."""
    b = (text or "").encode("utf-8", "surrogatepass")
    h = np.bincount(np.frombuffer(b, np.uint8), minlength=256)
    words = b.split()
    n, size = max(1, len(words)), max(1, len(b))
    upper, lower, digit = h[65:91].sum(), h[97:123].sum(), h[48:58].sum()
    sentence = h[[46, 44, 59, 58, 63]].sum()  # . , ; : ?
    other = h[33:48].sum() + h[58:65].sum() + h[91:97].sum() + h[123:127].sum() - sentence
    counts = Counter(words)
    lines = [x for x in b.split(b"\n") if x.split()]
    n_lines = max(1, len(lines))
    bigrams = len(set(zip(words, words[1:]))) if len(words) > 1 else n
    p = h[h > 0] / size
    return [
        np.log1p(len(words)), np.log1p(100.0 * other / n), np.log1p(100.0 * h[33] / n),
        np.sqrt(upper / max(1, upper + lower)), np.log1p(100.0 * digit / size),
        np.log1p(100.0 * sentence / n), np.log((size - h[[32, 9, 10, 11, 12, 13]].sum() + 1) / n),
        len(counts) / n, max(counts.values(), default=0) / n, bigrams / n,
        np.sqrt(sum(map(operator.eq, words, words[1:])) / n), 1.0 - len(set(lines)) / n_lines,
        np.log1p(len(words) / n_lines), h[128:].sum() / size, float(-(p * np.log(p)).sum()),
    ]


def stats_matrix(texts) -> np.ndarray:
    return np.array([text_stats(t) for t in texts], float).reshape(-1, N_STATS)


@dataclass(frozen=True)
class QualityModel:
    """What scoring needs: a few kilobytes, whatever the size of the corpus."""

    mean: np.ndarray
    scale: np.ndarray
    beta: np.ndarray
    knots: np.ndarray
    levels: np.ndarray
    fitted: bool = True  # False: no labelled row to learn from

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return design(stats, self.mean, self.scale) @ self.beta

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(stats), self.knots, self.levels), 0.0, 1.0)


def design(stats: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Random Fourier features of the standardised statistics: their products approximate a Gaussian kernel."""
    rng = np.random.default_rng(SEED)
    width = np.sqrt(N_STATS)  # the typical distance of two standardised rows
    w, phase = rng.normal(0, 1 / width, (N_STATS, FEATURES)), rng.uniform(0, 2 * np.pi, FEATURES)
    z = np.clip((stats - mean) / scale, -8, 8)
    return np.hstack([np.sqrt(2 / FEATURES) * np.cos(z @ w + phase), np.ones((len(z), 1))])


def is_held_out(id_col: str) -> Column:
    """Rows never learned from: CRC-32 of the id as text leaves 2 when divided by 4; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def document_stats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, stats) per row; null texts count as empty. Ids go through as Arrow columns, which keep nulls and every digit."""
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stats = pa.array(list(stats_matrix(batch.column("t").to_pylist())), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("id"), stats], names=["id", "stats"])

    kind = docs.schema[id_col].dataType.simpleString()
    return (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
            .mapInArrow(measure, f"id {kind}, stats array<double>"))


def _pool(sums: np.ndarray, counts: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over the cells of the grid: increasing levels at the mean raw score of each block."""
    blocks: list[list[float]] = []
    for s, n, c in zip(sums, counts, centres):
        blocks.append([s, n, c * n])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            s1, n1, c1 = blocks.pop()
            blocks[-1] = [blocks[-1][0] + s1, blocks[-1][1] + n1, blocks[-1][2] + c1]
    return np.array([b[2] / b[1] for b in blocks]), np.array([b[0] / b[1] for b in blocks])


def fit(stats: DataFrame, labels: DataFrame, label_col: str = "quality", label_id: str = "doc_id") -> QualityModel:
    """Fit on every labelled row that is not held out; ``stats`` has (id, stats), a label row with a null is ignored.

    Each partition sums its own part of the normal equations (features x features) and the sums are added; the ridge
    system is solved once. Rows whose id leaves 3 (a fourth of all) are kept from the ridge fit and calibrate the raw
    scores: label sums per cell of a fixed grid, then pool-adjacent-violators over the cells.

    Without labelled rows every score is 0.5; if one of the two parts is empty, both use all rows.
    """
    known = labels.select(F.col(label_id).alias("l_id"), F.col(label_col).cast("double").alias("y")).dropna()
    rows = (stats.join(known, F.col("id") == F.col("l_id")).where(~is_held_out("id"))
            .select("stats", "y", (F.crc32(F.col("id").cast("string")) % 4 == 3).alias("calibrates")))
    rows = materialize(rows, "quality-train")
    n, n_cal = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col("calibrates").cast("long")), F.lit(0))).first()
    if n == 0:
        return QualityModel(np.zeros(N_STATS), np.ones(N_STATS), np.zeros(FEATURES + 1), np.zeros(1), np.full(1, 0.5),
                            fitted=False)
    one_part = n_cal in (0, n)
    train = rows if one_part else rows.where(~F.col("calibrates"))
    calibration = rows if one_part else rows.where("calibrates")

    moments = train.agg(*[F.avg(F.col("stats")[i]) for i in range(N_STATS)],
                        *[F.stddev_pop(F.col("stats")[i]) for i in range(N_STATS)]).first()
    mean, scale = np.array(moments[:N_STATS]), np.array(moments[N_STATS:])
    scale = np.where(scale > 1e-9, scale, 1.0)

    def equations(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((FEATURES + 1, FEATURES + 2))
        for pdf in batches:
            z = design(np.stack(pdf["stats"].to_numpy()), mean, scale)
            total += z.T @ np.column_stack([z, pdf["y"].to_numpy()])
        yield pd.DataFrame({"i": np.arange(len(total), dtype=np.int32), "sums": list(total)})

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"i": pdf["i"].iloc[:1], "sums": [np.stack(pdf["sums"].to_numpy()).sum(axis=0)]})

    summed = (train.select("stats", "y").mapInPandas(equations, "i int, sums array<double>")
              .groupBy("i").applyInPandas(add, "i int, sums array<double>").orderBy("i").collect())
    system = np.array([r["sums"] for r in summed])
    n_train = system[-1, -2]
    penalty = np.diag(np.r_[np.full(FEATURES, RIDGE * n_train), 0.0])
    beta = np.linalg.solve(system[:, :-1] + penalty + 1e-9 * np.eye(FEATURES + 1), system[:, -1])

    plain = QualityModel(mean, scale, beta, np.zeros(1), np.zeros(1))

    def raw_scores(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            raw = plain.raw(np.stack(pdf["stats"].to_numpy()))
            cell = np.clip((raw - LOW) / (HIGH - LOW) * CELLS, 0, CELLS - 1).astype(np.int32)
            yield pd.DataFrame({"cell": cell, "y": pdf["y"]})

    cells = (calibration.select("stats", "y").mapInPandas(raw_scores, "cell int, y double").groupBy("cell")
             .agg(F.sum("y"), F.count("y")).orderBy("cell").collect())
    cell, ones, counts = (np.array(x, float) for x in zip(*cells))
    knots, levels = _pool(ones, counts, LOW + (cell + 0.5) * (HIGH - LOW) / CELLS)
    return QualityModel(mean, scale, beta, knots, levels)


def score_documents(stats: DataFrame, model: QualityModel) -> DataFrame:
    """(id, score) of every row of ``stats``."""
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array(batch.column("stats").to_pylist(), float).reshape(-1, N_STATS)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(model.score(x))], names=["id", "score"])

    return stats.mapInArrow(score, f"id {stats.schema['id'].dataType.simpleString()}, score double")


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "quality", threshold: float = 0.7) -> DataFrame:
    """(id, held_out, score, predicted) of every row of ``docs``.

    The texts are read once: their statistics are written as a slim table, from which the model is fitted and all rows
    are scored. Defined cases: a null text is scored as an empty one; repeated rows each get a score; a null id is
    never learned from but is scored; an empty table gives none; further columns are ignored.
    """
    stats = materialize(document_stats(docs, id_col, text_col), "quality-stats")
    model = fit(stats, labels, label_col)
    return score_documents(stats, model).select(
        F.col("id").alias(id_col), is_held_out("id").alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              label_col: str = "quality", threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs``, all columns, that score at least ``threshold``; scored in the scan, without a shuffle.

    Without a usable label row (none at all, none of these documents, or all held out) there is no model and nothing can
    be rejected: all rows stay. Defined cases: a null text is judged as an empty one; a null id is judged like any other;
    repeated rows share a verdict; an empty table stays empty; columns of any name and their values stay as they are.
    """
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
    known = labels.select(F.col("doc_id").alias("l_id")).distinct()
    stats = materialize(document_stats(texts.join(known, F.col("id") == F.col("l_id"), "left_semi"), "id", "t"),
                        "quality-stats")
    model = fit(stats, labels, label_col)
    if not model.fitted:
        return docs

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array(model.score(stats_matrix(texts.to_pylist())))

    return docs.where(score(F.col(text_col)) >= threshold)
