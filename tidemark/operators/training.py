"""Training-set preparation, stable category encoding, evaluation, model fit/score."""

from __future__ import annotations

import math
import random

from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.tuning import TrainValidationSplit
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.joins import DEFAULT_BROADCAST_BYTES, row_bytes
from tidemark.operators.sinks import mapping_json_lines, metrics_json
from tidemark.session import materialize

# --- fixed values -----------------------------------------------------------
TRAINING_COLUMNS = ["brand", "price", "event_weekday", "category_code_level1", "category_code_level2",
                    "activity_count", "is_purchased"]
CATEGORICAL_COLUMNS = ["brand", "event_weekday", "category_code_level1", "category_code_level2"]
LABEL = "is_purchased"
TEST_FRACTION_TENTHS = 3          # test_size 0.3
UNSEEN_INDEX = -1
# Boosted-tree settings: binary logistic, depth, learning rate, row/column sampling.
# The source has one round; GBTClassifier gives its first tree the weight 1, so the
# learning rate needs more.  20 is the classifier's own default.
BOOST_ROUNDS = 20
GBT_PARAMS = {"maxDepth": 1, "stepSize": 0.3, "subsamplingRate": 0.8, "featureSubsetStrategy": "0.8"}
# Search space: depth 3 or 4; learning rate log-uniform; least rows of a leaf;
# row and column sampling and least gain of a split, summed over rows, uniform.
SEARCH_SPACE = {
    "maxDepth": ("choice", [3, 4]),
    "stepSize": ("log", [1e-4, 1e-1]),
    "minInstancesPerNode": ("choice", [1, 2, 3, 4, 5]),
    "subsamplingRate": ("uniform", [0.5, 1.0]),
    "featureSubsetStrategy": ("uniform", [0.5, 1.0]),
    "minInfoGain": ("uniform", [0.0, 1.0]),
}
TRIALS = 3
SEARCH_TRAIN_RATIO = 0.75
# -----------------------------------------------------------------------------


def training_columns(df: DataFrame, cols: list[str] = TRAINING_COLUMNS) -> DataFrame:
    return df.select(*cols)


def category_mapping(df: DataFrame, cols: list[str] = CATEGORICAL_COLUMNS) -> DataFrame:
    """(feature, value, idx): per column, sorted distinct non-null values -> 0..n-1.

    One pass unpivots the columns into (feature, sort keys, value) and takes the
    distinct set (partial-aggregated map-side).  Numeric columns sort
    numerically, text by code point.  The dense index is computed without
    gathering a vocabulary anywhere: a distributed sort, then
    ``monotonically_increasing_id`` (partition index in the upper bits, row
    position in the lower) materialised once so it is stable, then each row's
    position = rows in earlier partitions (a per-partition count table, one
    row per partition: a bounded broadcast) + its position in its partition.
    """
    entries = []
    for i, c in enumerate(cols):
        numeric = isinstance(df.schema[c].dataType, T.NumericType)
        entries.append(F.struct(
            F.lit(i).alias("col_no"), F.lit(c).alias("feature"),
            (F.col(c).cast("double") if numeric else F.lit(None).cast("double")).alias("num_key"),
            (F.lit(None).cast("string") if numeric else F.col(c).cast("string")).alias("str_key"),
            F.col(c).cast("string").alias("value")))
    vocab = materialize(df.select(F.inline(F.array(*entries))).filter(F.col("value").isNotNull()).distinct())
    ordered = materialize(vocab.orderBy("col_no", "num_key", "str_key")
                          .withColumn("_id", F.monotonically_increasing_id()))
    low_bits = (1 << 33) - 1
    ordered = ordered.withColumns({"_part": F.shiftright("_id", 33), "_pos": F.col("_id").bitwiseAND(low_bits)})
    sizes = ordered.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.withColumn(
        "_off", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)),
                           F.lit(0)))
    g = (ordered.join(F.broadcast(offsets.select("_part", "_off")), "_part")   # one row per partition
         .withColumn("_g", F.col("_off") + F.col("_pos")))
    starts = g.groupBy("col_no").agg(F.min("_g").alias("_start"))   # one row per feature
    return (g.join(F.broadcast(starts), "col_no")
            .select("feature", "value", (F.col("_g") - F.col("_start")).cast("int").alias("idx")))


def encode_categories(df: DataFrame, mapping: DataFrame, cols: list[str] = CATEGORICAL_COLUMNS,
                      max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Replace each categorical value by its index; unseen or null -> -1.

    The mapping (a vocabulary) is materialised once, and the measured size of
    each column's part decides that column's join: broadcast when within
    ``max_bytes`` (no shuffle of the rows, and no skew on low-cardinality
    values such as a weekday), otherwise a shuffle join that AQE can split.
    """
    mapping = materialize(mapping.select("feature", "value", "idx"))
    sizes = {r.feature: r.size for r in mapping.groupBy("feature").agg(F.sum(row_bytes(mapping)).alias("size")).collect()}
    out = df
    for c in cols:
        m = (mapping.filter(F.col("feature") == c)
             .select(F.col("value").alias(f"_v_{c}"), F.col("idx").alias(f"_i_{c}")))
        m = F.broadcast(m) if sizes.get(c, 0) <= max_bytes else m
        out = (out.join(m, out[c].cast("string") == m[f"_v_{c}"], "left")
               .withColumn(c, F.coalesce(F.col(f"_i_{c}"), F.lit(UNSEEN_INDEX)).cast("int"))
               .drop(f"_v_{c}", f"_i_{c}"))
    return out


def training_set(features: DataFrame, mapping: DataFrame | None = None) -> DataFrame:
    cols = training_columns(features).withColumn("price", F.col("price").cast("double"))
    mapping = mapping if mapping is not None else category_mapping(cols)
    return encode_categories(cols, mapping).select(*TRAINING_COLUMNS)


def split_bucket(key) -> F.Column:
    """Deterministic 0..9 bucket from the first 8 hex digits of sha256(key)."""
    k = F.col(key) if isinstance(key, str) else key
    return F.pmod(F.conv(F.substring(F.sha2(k.cast("string"), 256), 1, 8), 16, 10).cast("bigint"), F.lit(10))


def train_test_split(df: DataFrame, key: str) -> DataFrame:
    b = split_bucket(key)
    return df.withColumn("split", F.when(b < TEST_FRACTION_TENTHS, "test").otherwise("train"))


def eval_metrics(scored: DataFrame, label: str = "label", p: str = "p") -> DataFrame:
    """logloss, error (threshold 0.5), rmse, mae in one aggregation pass."""
    y, q = F.col(label).cast("double"), F.col(p).cast("double")
    eps = 1e-15
    qc = F.least(F.greatest(q, F.lit(eps)), F.lit(1 - eps))
    return scored.agg(
        (-F.avg(y * F.log(qc) + (1 - y) * F.log(1 - qc))).alias("logloss"),
        F.avg(F.when((q > 0.5).cast("double") != y, 1.0).otherwise(0.0)).alias("error"),
        F.sqrt(F.avg((q - y) * (q - y))).alias("rmse"),
        F.avg(F.abs(q - y)).alias("mae"),
        F.count(F.lit(1)).alias("n"))


def eval_auc(scored: DataFrame, label: str = "label", p: str = "p") -> DataFrame:
    """Exact area under ROC (ties averaged), distributed.

    Uses Spark's binary-classification metrics with binning disabled
    (numBins=0): scores are grouped per distinct value, sorted across the
    cluster and swept partition by partition; nothing is gathered in one task.
    """
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    ev = BinaryClassificationEvaluator(rawPredictionCol=p, labelCol=label, metricName="areaUnderROC",
                                       numBins=0)
    data = scored.select(F.col(p).cast("double").alias(p), F.col(label).cast("double").alias(label))
    auc = ev.evaluate(data)
    return scored.sparkSession.createDataFrame([(float(auc),)], "auc double")


def assemble(df: DataFrame, features: list[str]) -> DataFrame:
    return VectorAssembler(inputCols=features, outputCol="features", handleInvalid="keep").transform(df)


def gbt(params: dict | None = None, seed: int = 42):
    """The unfitted classifier: base settings, replaced where ``params`` says."""
    from pyspark.ml.classification import GBTClassifier
    return GBTClassifier(featuresCol="features", labelCol=LABEL, seed=seed, maxIter=BOOST_ROUNDS,
                         **{**GBT_PARAMS, **(params or {})})


def fit_gbt(train: DataFrame, features: list[str], params: dict | None = None, seed: int = 42):
    return gbt(params, seed).fit(assemble(train.withColumn(LABEL, F.col(LABEL).cast("double")), features))


def fit_pipeline(train: DataFrame, features: list[str], params: dict | None = None, seed: int = 42) -> PipelineModel:
    """Assembler, boosted trees and the probability column as one model, which
    can be saved and loaded as a whole."""
    return _pipeline(features, gbt(params, seed)).fit(train.withColumn(LABEL, F.col(LABEL).cast("double")))


def _pipeline(features: list[str], classifier) -> Pipeline:
    return Pipeline(stages=[VectorAssembler(inputCols=features, outputCol="features", handleInvalid="keep"),
                            classifier, PurchaseProbability()])


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    return model.transform(df).drop("features", "rawPrediction", "probability")


def predict(model, df: DataFrame, features: list[str]) -> DataFrame:
    from pyspark.ml.functions import vector_to_array
    out = model.transform(assemble(df, features))
    return out.withColumn("p", F.get(vector_to_array("probability"), 1)).drop("features", "rawPrediction",
                                                                                "probability")


class PurchaseProbability(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Pipeline stage: ``p`` = probability of the positive class (a column op)."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        from pyspark.ml.functions import vector_to_array
        return dataset.withColumn("p", F.get(vector_to_array("probability"), 1))


def sample_trials(n: int = TRIALS, space: dict = SEARCH_SPACE, seed: int = 42) -> list[dict]:
    """``n`` parameter sets drawn from the whole space."""
    rng = random.Random(seed)

    def draw(kind: str, values: list):
        if kind == "choice":
            return rng.choice(values)
        low, high = values
        return math.exp(rng.uniform(math.log(low), math.log(high))) if kind == "log" else rng.uniform(low, high)

    return [{k: draw(*v) for k, v in space.items()} for _ in range(n)]


def _typed(params: dict, rows: float) -> dict:
    """Parameters as the classifier takes them for a fit on ``rows`` rows.

    Column sampling is a text.  The least gain of a split is drawn as the source's
    gamma, a gain summed over rows, whereas the classifier compares the mean gain of
    a row (1 at most, with labels -1 and 1): undivided, no tree would split at all.
    """
    typed = {k: str(v) if k == "featureSubsetStrategy" else int(v) if k in ("maxDepth", "minInstancesPerNode") else v
             for k, v in params.items()}
    if "minInfoGain" in typed:
        typed["minInfoGain"] = typed["minInfoGain"] / max(rows, 1.0)
    return typed


def hyperparameter_search(train: DataFrame, features: list[str], trials: list[dict] | None = None,
                          seed: int = 42, parallelism: int = 2) -> DataFrame:
    """Sampled search with ``TrainValidationSplit``: each parameter set is fitted
    on a train split, with as many rounds as the final fit, and scored by the
    RMSE of the purchase probability on the held-out split; fits run
    ``parallelism`` at a time, each one distributed.  Returns the trial table
    (one row per parameter set)."""
    trials = trials if trials is not None else sample_trials(seed=seed)
    classifier = gbt(seed=seed)
    rows = train.count() * SEARCH_TRAIN_RATIO
    maps = [{classifier.getParam(k): v for k, v in _typed(t, rows).items()} for t in trials]
    tvs = TrainValidationSplit(estimator=_pipeline(features, classifier), estimatorParamMaps=maps,
                               trainRatio=SEARCH_TRAIN_RATIO, seed=seed,
                               evaluator=RegressionEvaluator(labelCol=LABEL, predictionCol="p", metricName="rmse"),
                               parallelism=parallelism)
    model = tvs.fit(train.withColumn(LABEL, F.col(LABEL).cast("double")))
    keys = sorted(trials[0])
    found = [(i, *[float(t[k]) for k in keys], float(m)) for i, (t, m) in enumerate(zip(trials, model.validationMetrics))]
    schema = "trial_id int, " + ", ".join(f"{k} double" for k in keys) + ", validation_rmse double"
    return train.sparkSession.createDataFrame(found, schema)


def fit_tuned(train: DataFrame, features: list[str], trials: list[dict] | None = None,
              seed: int = 42) -> tuple[PipelineModel, DataFrame]:
    """Search, then the final fit with the best trial's parameters; also the
    trial table."""
    table = hyperparameter_search(train, features, trials, seed)
    best = best_trial(table).first().asDict()
    params = {k: v for k, v in best.items() if k not in ("trial_id", "validation_rmse")}
    return fit_pipeline(train, features, _typed(params, train.count()), seed), table


def save_model(model: PipelineModel, mapping: DataFrame, metrics: DataFrame, path: str) -> None:
    """The model artefact: ``model``, ``mapping`` and ``metrics`` under ``path``."""
    model.write().overwrite().save(f"{path}/model")
    mapping_json_lines(mapping, f"{path}/mapping")
    metrics_json(metrics, f"{path}/metrics")


def load_model(spark: SparkSession, path: str) -> tuple[PipelineModel, DataFrame]:
    """Model and category mapping as saved."""
    return PipelineModel.load(f"{path}/model"), spark.read.schema("feature string, value string, idx int").json(f"{path}/mapping")


def best_trial(trials: DataFrame, metric: str = "validation_rmse") -> DataFrame:
    """The trial with the smallest metric (min_by; ties -> smallest trial_id)."""
    cols = [c for c in trials.columns]
    return (trials.agg(F.min_by(F.struct(*cols), F.struct(F.col(metric), F.col("trial_id"))).alias("b"))
            .select("b.*"))


SERVING_FEATURES = ["brand", "price", "event_weekday", "category_code_level1", "category_code_level2",
                    "activity_count"]


def select_present(df: DataFrame, cols: list[str] = SERVING_FEATURES, keep: list[str] | None = None) -> DataFrame:
    """Serving projection: the configured features that exist in the frame, in order."""
    return df.select(*(keep or []), *[c for c in cols if c in df.columns])


def coerce_numeric(df: DataFrame, cols: dict[str, str]) -> DataFrame:
    """Serving coercion: unparsable -> 0, then float/int per ``cols`` {name: 'float'|'int'}."""
    return df.withColumns({c: F.coalesce(F.col(c).cast("string").try_cast(t), F.lit(0).cast(t))
                           for c, t in cols.items()})
