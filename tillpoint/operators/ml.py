"""Forecast training and evaluation on the store × month panel.

* M1  ``fit_dummies`` — sparse one-hot vectors of every category level but the first by name, without a limit on their
      number (pandas ``get_dummies(drop_first=True)``); NULL or unseen values give all zeros.
* M2  ``exact_split`` — an exact 80/20 split ordered by a salted MD5 of the row key, without a global sort.
* M3  model registry of factories — every run gets fresh estimators.
* M4  ``regression_metrics`` — r², RMSE, MAE and n in one aggregate over (label, prediction).
* M5  ``select_best`` — highest r² *after rounding*, ties to the first trained.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.feature import IndexToString, OneHotEncoder, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillpoint.functions.numeric import safe_div
from tillpoint.operators.quality import round_even
from tillpoint.session import materialize

# The numeric features of the forecast (shares are appended per category) and the categoricals.
BASE_FEATURES = [
    "area_m2", "funcionarios",
    "ticket_medio", "n_clientes", "custo_pct", "margem",
    "crescimento_3m", "crescimento_6m",
    "ticket_3m_avg", "clientes_3m_avg",
    "sazonalidade_mes", "dia_semana_pico",
]
CATEGORICAL = ["regiao", "porte", "categoria_principal"]
TARGET = "target"
SPLIT_KEYS = ["loja_id", "mes"]
TEST_FRACTION = 0.2
SEED = 42
TRAIN_PARTITIONS = 8  # at least; the number depends on the row count only, as the forest depends on it
TRAIN_ROWS = 65_536  # rows of a training partition, about, once there are more than TRAIN_PARTITIONS of them
TRAIN_MANY = 48  # training partitions that are enough: from here on they grow ...
TRAIN_MOST_ROWS = 1_048_576  # ... up to about this many rows before there are more of them
NODE_ID_ROWS = 4_194_304  # rows of a table up to which a forest keeps the node of every training row in every tree
TINY_RIDGE = 1e-6
HASH_PREFIX_HEX = 4  # 16-bit buckets → histogram of at most 65,536 rows


def numeric_features(panel: DataFrame) -> list[str]:
    return BASE_FEATURES + [c for c in panel.columns if c.startswith("share_")]


# ---------------------------------------------------------------------------------------------------------------
# M1 — one-hot with the first level dropped
# ---------------------------------------------------------------------------------------------------------------
@dataclass(frozen=True)
class Dummies:
    """Fitted encoding of categoricals: stages, sparse vector columns, and the levels that each vector stands for."""
    stages: list
    vectors: dict[str, str]
    levels: dict[str, list[str]]

    def names(self) -> list[str]:
        return [f"{c}_{v}" for c, vs in self.levels.items() for v in vs]


def fit_dummies(df: DataFrame, columns: list[str]) -> Dummies:
    """Levels of each present column by name, the first one dropped; a column with one level gives nothing.

    ``StringIndexer`` counts the levels in the cluster. An indexer of the levels kept puts the first level, NULL and
    unseen values in its last slot, which ``OneHotEncoder`` drops: they are all zeros. The vectors are sparse, so a
    row costs one entry per column however many levels there are. The levels pass through the driver and are part of the
    model: this is for the few categoricals of a model; ``level_table`` has no such bound.
    """
    present = [c for c in columns if c in df.columns]
    if not present:
        return Dummies([], {}, {})
    fitted = StringIndexer(inputCols=present, outputCols=[f"_{c}_nivel" for c in present],
                           stringOrderType="alphabetAsc", handleInvalid="skip").fit(df)
    levels = {c: list(vs)[1:] for c, vs in zip(present, fitted.labelsArray) if len(vs) > 1}
    stages, work = [], df
    for c, kept in levels.items():
        indexer = StringIndexerModel.from_labels(kept, inputCol=c, outputCol=f"_{c}_idx", handleInvalid="keep")
        stages.append(indexer)
        work = indexer.transform(work)
    if levels:
        stages.append(OneHotEncoder(inputCols=[f"_{c}_idx" for c in levels], outputCols=[f"_{c}_vec" for c in levels],
                                    dropLast=True).fit(work))
    return Dummies(stages, {c: f"_{c}_vec" for c in levels}, levels)


def dummies_long(df: DataFrame, dummies: Dummies, keys: list[str], nonzero: bool = False) -> DataFrame:
    """(keys, coluna, valor): every level of every row, or with ``nonzero`` only the entries that are set."""
    out = PipelineModel(stages=dummies.stages).transform(df) if dummies.stages else df
    frames = []
    for c, vec in dummies.vectors.items():
        kept = dummies.levels[c]
        if nonzero:
            pos = out.select(*keys, F.explode(F.unwrap_udt(vec)["indices"].cast("array<double>")).alias("_pos"))
            named = IndexToString(inputCol="_pos", outputCol="_v", labels=kept).transform(pos)
            frames.append(named.select(*keys, F.concat(F.lit(f"{c}_"), F.col("_v")).alias("coluna"),
                                       F.lit(1.0).alias("valor")))
        else:
            pairs = F.arrays_zip(F.array(*[F.lit(f"{c}_{v}") for v in kept]).alias("coluna"),
                                 vector_to_array(vec).alias("valor"))
            frames.append(out.select(*keys, F.inline(pairs).alias("coluna", "valor")))
    if not frames:
        return df.select(*keys, F.lit("").alias("coluna"), F.lit(0.0).alias("valor")).where(F.lit(False))
    return reduce(DataFrame.unionByName, frames)


def level_table(df: DataFrame, column: str) -> DataFrame:
    """(nivel, posicao) of every level of ``column`` as text, by name from 0; NULL is none. The levels stay in the cluster.

    A range partitioning orders the distinct levels; a level's place is its place in its partition plus the number of
    levels in the partitions before. One count per partition is all that is gathered.
    """
    distinct = df.select(F.col(column).cast("string").alias("nivel")).dropna().distinct()
    dealt = distinct.repartitionByRange("nivel").sortWithinPartitions("nivel")
    # the id holds the partition above bit 33 and the row's place in it below
    dealt = materialize(dealt.withColumn("_id", F.monotonically_increasing_id())
                        .select("nivel", F.shiftright("_id", 33).alias("_parte"),
                                F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)).alias("_lugar")), "niveis")
    before = (dealt.groupBy(F.col("_parte").alias("_p")).agg(F.count(F.lit(1)).alias("n"))
              .select("_p", (F.sum("n").over(Window.orderBy("_p")) - F.col("n")).alias("_antes")))
    return (dealt.join(F.broadcast(before), F.col("_parte") == F.col("_p"))
            .select("nivel", (F.col("_lugar") + F.col("_antes")).alias("posicao")))


def dummies_by_table(df: DataFrame, column: str, levels: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, coluna, valor): the entries that are set, as ``dummies_long(..., nonzero=True)``, from a table of levels.

    The first level, NULL and values without a level are all zeros and give no row. ``column`` is joined as text. Both sides
    are shuffled: a written table of many similar levels is a small file, so Spark would take it for a small table and
    gather it on the driver for a broadcast.
    """
    kept = levels.where("posicao > 0").select(F.col("nivel").alias("_nivel")).hint("merge")
    rows = df.select(*keys, F.col(column).cast("string").alias("_valor"))
    return (rows.join(kept, F.col("_valor") == F.col("_nivel"))
            .select(*keys, F.concat(F.lit(f"{column}_"), F.col("_nivel")).alias("coluna"), F.lit(1.0).alias("valor")))


def prepare_features(panel: DataFrame, target: str = TARGET, loja_id=None,
                     categorical: list[str] = CATEGORICAL) -> tuple[DataFrame, list[str], PipelineModel]:
    """M1: filter (optional store), fit dummies *after* the filter, assemble ``features``; label = ``target``.

    Returns the assembled frame, the ordered feature names and the fitted feature pipeline.
    """
    df = panel if loja_id is None else panel.filter(F.col("loja_id") == F.lit(loja_id))
    dummies = fit_dummies(df, categorical)
    numeric = numeric_features(panel)
    assembler = VectorAssembler(inputCols=numeric + list(dummies.vectors.values()), outputCol="features",
                                handleInvalid="keep")
    feats = PipelineModel(stages=[*dummies.stages, assembler])
    out = feats.transform(df).withColumn("label", F.col(target).cast("double"))
    return out, numeric + dummies.names(), feats


# ---------------------------------------------------------------------------------------------------------------
# M2 — exact split
# ---------------------------------------------------------------------------------------------------------------
def split_hash(keys: list[str] = SPLIT_KEYS, seed: int = SEED):
    return F.md5(F.concat_ws("-", *[F.col(k).cast("string") for k in keys], F.lit(str(seed))))


def exact_split(df: DataFrame, keys: list[str] = SPLIT_KEYS, test_fraction: float = TEST_FRACTION,
                seed: int = SEED) -> DataFrame:
    """Adds ``is_test``: the ``ceil(test_fraction · n)`` rows with the smallest salted key hash are the test set.

    Exact in size (4,600 → 3,680 / 920) and independent of partitioning. A histogram of the first 16 bits of the hash
    (at most 65,536 rows by construction, so it is broadcast) decides every bucket but the one that holds the cut. Only
    that bucket's rows are shuffled and ranked: by hash, keys, then all other columns, so rows with equal keys
    have a fixed order as well. The input is read once for the histogram and once for each of the two parts: pass a
    written table when it is expensive to compute.
    """
    content = F.sha2(F.concat_ws("|", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\\N"))
                                        for c in df.columns]), 256)
    d = df.withColumn("_h", split_hash(keys, seed)).withColumn(
        "_b", F.conv(F.substring("_h", 1, HASH_PREFIX_HEX), 16, 10).cast("int"))
    hist = d.groupBy("_b").agg(F.count(F.lit(1)).alias("_cnt"))
    # the histogram has at most 16^HASH_PREFIX_HEX rows, so a single ordered window over it is bounded
    running = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    hist = hist.select("_b", "_cnt",
                       F.coalesce(F.sum("_cnt").over(running), F.lit(0)).alias("_before"),
                       F.ceil(F.sum("_cnt").over(everything) * F.lit(test_fraction)).alias("_ntest"))
    below = F.col("_before") + F.col("_cnt") <= F.col("_ntest")
    cut = ~below & (F.col("_before") < F.col("_ntest"))
    whole = d.join(F.broadcast(hist.where(~cut)), "_b").withColumn("is_test", below)
    place = F.row_number().over(Window.partitionBy("_b").orderBy("_h", *keys, "_content"))
    split = (d.join(F.broadcast(hist.where(cut)), "_b").withColumn("_content", content)
              .withColumn("is_test", F.col("_before") + place <= F.col("_ntest")))
    cols = [F.col(f"`{c}`") for c in df.columns] + [F.col("is_test")]
    return whole.select(*cols).unionAll(split.select(*cols))


# ---------------------------------------------------------------------------------------------------------------
# M3 — model registry (factories; the reference trains RandomForest first, then LinearRegression)
# ---------------------------------------------------------------------------------------------------------------
def random_forest(**kw) -> RandomForestRegressor:
    params = dict(numTrees=100, maxDepth=10, seed=SEED, featureSubsetStrategy="all", subsamplingRate=1.0,
                  bootstrap=True, cacheNodeIds=True)
    params.update(kw)
    return RandomForestRegressor(featuresCol="features", labelCol="label", **params)


def linear_regression(**kw) -> LinearRegression:
    params = dict(regParam=0.0, elasticNetParam=0.0, solver="normal", fitIntercept=True)
    params.update(kw)
    return LinearRegression(featuresCol="features", labelCol="label", **params)


def gradient_boosting(**kw) -> GBTRegressor:
    """Documented-only third model of the reference (100 rounds, depth 6, step 0.1); not trained by default."""
    params = dict(maxIter=100, maxDepth=6, stepSize=0.1, seed=SEED)
    params.update(kw)
    return GBTRegressor(featuresCol="features", labelCol="label", **params)


MODELS = {"RandomForest": random_forest, "LinearRegression": linear_regression}
OPTIONAL_MODELS = {"GradientBoosting": gradient_boosting}


def _memory_mb(value: str) -> int:
    """Spark memory string → MiB (a value without a unit is MiB, as Spark reads executor/driver memory)."""
    v = value.strip().lower()
    units = {"k": 1 / 1024, "m": 1, "g": 1024, "t": 1024 * 1024}
    if v.endswith("b") and len(v) > 1 and v[-2] in units:
        v = v[:-1]
    if v and v[-1] in units:
        return int(float(v[:-1]) * units[v[-1]])
    return int(float(v))


def tree_memory_budget_mb(spark) -> int:
    """Per-task memory for tree split statistics (``maxMemoryInMB``): a quarter of an executor's heap divided by
    the tasks that run on it at once, between 16 MB and 1 GB. Keeps deep forests from exhausting small heaps when
    many tasks aggregate histograms concurrently, and lets large heaps group more nodes per pass over the data."""
    conf = spark.sparkContext.getConf()
    local = spark.sparkContext.master.startswith("local")
    heap = _memory_mb(conf.get("spark.driver.memory" if local else "spark.executor.memory", "1g"))
    cores = spark.sparkContext.defaultParallelism if local else int(conf.get("spark.executor.cores", "1"))
    return max(16, min(1024, heap // (4 * max(1, cores))))


def training_partitions(rows: int) -> int:
    """Partitions of a training table of ``rows`` rows: about ``TRAIN_ROWS`` each, at least ``TRAIN_PARTITIONS``. From
    ``TRAIN_MANY`` on they grow instead, to ``TRAIN_MOST_ROWS``: at every level of a forest each partition shuffles the statistics
    of all its nodes, whose size hardly depends on the partition's rows."""
    return max(TRAIN_PARTITIONS, min(-(-rows // TRAIN_ROWS), TRAIN_MANY), -(-rows // TRAIN_MOST_ROWS))


def training_layout(data: DataFrame, keys: list[str] = SPLIT_KEYS, partitions: int | None = None) -> DataFrame:
    """Rows spread by a hash of their key over partitions and sorted inside them. Unless ``partitions`` is given, their
    number follows the row count (one pass over ``data``, see ``training_partitions``).
    A forest draws its samples per partition, so with this layout the same rows give the same forest on any cluster."""
    n = partitions or training_partitions(data.count())
    return data.repartition(n, *keys).sortWithinPartitions(*keys, "label")


def needed_ridge(train_df: DataFrame) -> float:
    """``TINY_RIDGE`` where least squares has no more rows than features, so no single solution; else 0."""
    first = train_df.select(F.size(vector_to_array("features")).alias("n")).first()
    width = first["n"] if first else 0
    return TINY_RIDGE if train_df.limit(width + 1).count() <= width else 0.0


def train(name: str, train_df: DataFrame, **params):
    """Fit a model of the registry. Least squares with no more rows than features has no single solution: a small ridge
    (``TINY_RIDGE``) is then added unless ``regParam`` is given; ``model.getRegParam()`` tells."""
    factory = MODELS.get(name) or OPTIONAL_MODELS[name]
    if name != "LinearRegression" and "maxMemoryInMB" not in params:
        params["maxMemoryInMB"] = tree_memory_budget_mb(train_df.sparkSession)
    if name == "LinearRegression" and "regParam" not in params:
        params["regParam"] = needed_ridge(train_df)
    return factory(**params).fit(train_df)


def storage_params(name: str, rows: int) -> dict:
    """How a model is trained on a table of ``rows`` rows, without an effect on the model: a forest of more than ``NODE_ID_ROWS``
    walks its trees at every level instead of keeping three generations of node ids (1.2 KB a row at 100 trees), which would
    go to disk."""
    return {"cacheNodeIds": False} if name == "RandomForest" and rows > NODE_ID_ROWS else {}


def train_split(name: str, data: DataFrame, **params):
    """Fit a model of the registry on the rows of a written table that are not ``is_test``, in the training layout of the table.

    Only these rows are shuffled, and what can be asked of the table is asked of it: every look at the layout is a shuffle."""
    rows, fit_rows = data.count(), data.where("NOT is_test")
    if name == "LinearRegression":
        params.setdefault("regParam", needed_ridge(fit_rows))
    layout = training_layout(fit_rows, partitions=training_partitions(rows))
    if name != "LinearRegression":  # trees keep binned rows of their own
        return train(name, layout, **(storage_params(name, rows) | params))
    layout.persist()  # least squares asks for its rows three times
    try:
        return train(name, layout, **params)
    finally:
        layout.unpersist()


# ---------------------------------------------------------------------------------------------------------------
# M4 / M5 — metrics and selection
# ---------------------------------------------------------------------------------------------------------------
def regression_metrics(pred: DataFrame, label: str = "label", prediction: str = "prediction",
                       by: tuple = ()) -> DataFrame:
    """r2 (4 dp), rmse (2 dp), mae (2 dp), n_amostras — half-even rounding like Python's ``round``; one row, or one
    per group of ``by``."""
    err = F.col(label).cast("double") - F.col(prediction).cast("double")
    a = pred.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.sum(err * err).alias("sse"), F.sum(F.abs(err)).alias("sae"),
        F.var_pop(F.col(label).cast("double")).alias("vy"))
    return a.select(
        *by,
        round_even(F.lit(1.0) - safe_div("sse", F.col("vy") * F.col("n")), 4).alias("r2"),
        round_even(F.sqrt(safe_div("sse", "n")), 2).alias("rmse"),
        round_even(safe_div("sae", "n"), 2).alias("mae"),
        F.col("n").cast("bigint").alias("n_amostras"))


def select_best(metrics: DataFrame) -> DataFrame:
    """M5: the row with the highest (rounded) r2; ties → smallest ``ordem`` (first trained)."""
    return metrics.orderBy(F.desc_nulls_last("r2"), F.asc("ordem")).limit(1)


# ---------------------------------------------------------------------------------------------------------------
# A6 / A7 / M6 — persistence and batch scoring
# ---------------------------------------------------------------------------------------------------------------
def full_model(features: PipelineModel, model) -> PipelineModel:
    """Feature stages + fitted regressor as one PipelineModel (raw panel rows in, ``prediction`` out)."""
    return PipelineModel(stages=list(features.stages) + [model])


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def predict(model: PipelineModel, df: DataFrame, keep: list[str] = SPLIT_KEYS) -> DataFrame:
    """M6: batch prediction of raw panel rows."""
    return model.transform(df).select(*keep, "prediction")


__all__ = ["Dummies", "fit_dummies", "dummies_long", "level_table", "dummies_by_table",
           "prepare_features", "exact_split", "train", "train_split", "storage_params", "regression_metrics", "select_best",
           "save_model", "load_model", "predict", "full_model"]
