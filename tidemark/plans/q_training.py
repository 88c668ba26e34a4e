"""Registered queries: training set, encoders, split, evaluation, model fit/score."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidemark.operators import features as FE
from tidemark.operators import training as TR
from tidemark.plans.oracles import with_ctes
from tidemark.plans.q_features import FEATURE_CTES, REQUEST_TS_SQL, _features, _requests
from tidemark.plans.registry import register
from tidemark.session import materialize, scratch_path
from tidemark.sources.testdata import read_table

MAPPING_CUTOFF = "2024-01-20 00:00:00"
ENCODED = ["brand", "event_weekday", "category_code_level1", "category_code_level2"]
MODEL_FEATURES = ["brand", "price", "event_weekday", "category_code_level1", "category_code_level2",
                  "activity_count"]

MAPPING_CTES = FEATURE_CTES + """,
vals AS (
  SELECT DISTINCT 'brand' AS feature, brand AS value, CAST(NULL AS DOUBLE) AS num_key, brand AS str_key
    FROM {src} WHERE brand IS NOT NULL
  UNION SELECT DISTINCT 'event_weekday', CAST(event_weekday AS VARCHAR), CAST(event_weekday AS DOUBLE), NULL
    FROM {src} WHERE event_weekday IS NOT NULL
  UNION SELECT DISTINCT 'category_code_level1', category_code_level1, NULL, category_code_level1
    FROM {src} WHERE category_code_level1 IS NOT NULL
  UNION SELECT DISTINCT 'category_code_level2', category_code_level2, NULL, category_code_level2
    FROM {src} WHERE category_code_level2 IS NOT NULL
),
mapping AS (
  SELECT feature, value,
         CAST(row_number() OVER (PARTITION BY feature ORDER BY num_key, str_key) - 1 AS INTEGER) AS idx
  FROM vals
)"""


def _encoded_sql(src: str, lead: str = "", tail: str = "") -> str:
    joins = "\n".join(
        f"LEFT JOIN mapping m{i} ON m{i}.feature = '{c}' AND m{i}.value = CAST(f.{c} AS VARCHAR)"
        for i, c in enumerate(ENCODED))
    sel = ", ".join(
        f"CAST(coalesce(m{ENCODED.index(c)}.idx, -1) AS INTEGER) AS {c}" if c in ENCODED
        else (f"CAST(f.{c} AS DOUBLE) AS {c}" if c == "price" else f"f.{c}")
        for c in TR.TRAINING_COLUMNS)
    return f"SELECT {lead}{sel}{tail} FROM {src} f\n{joins}"


@register("training_columns", with_ctes(f"SELECT {', '.join(TR.TRAINING_COLUMNS)} FROM features", FEATURE_CTES))
def q_training_columns(spark, sf):
    return TR.training_columns(_features(spark, sf))


@register("category_mapping", with_ctes("SELECT feature, value, idx FROM mapping",
                                        MAPPING_CTES.format(src="features")))
def q_category_mapping(spark, sf):
    return TR.category_mapping(_features(spark, sf))


@register("encode_categories", with_ctes(
    _encoded_sql("features"),
    MAPPING_CTES.format(src=f"(SELECT * FROM features WHERE event_timestamp < TIMESTAMP '{MAPPING_CUTOFF}')")))
def q_encode_categories(spark, sf):
    f = _features(spark, sf)
    early = f.filter(F.col("event_timestamp") < F.lit(MAPPING_CUTOFF).cast("timestamp"))
    mapping = TR.category_mapping(early)
    cols = TR.training_columns(f).withColumn("price", F.col("price").cast("double"))
    return TR.encode_categories(cols, mapping).select(*TR.TRAINING_COLUMNS)


@register("training_set", with_ctes(_encoded_sql("features"), MAPPING_CTES.format(src="features")))
def q_training_set(spark, sf):
    return TR.training_set(_features(spark, sf))


@register("train_test_split", with_ctes("""
SELECT ingest_seq, CASE WHEN CAST(('0x' || substr(sha256(CAST(ingest_seq AS VARCHAR)), 1, 8)) AS BIGINT) % 10 < 3
                        THEN 'test' ELSE 'train' END AS split
FROM features""", FEATURE_CTES))
def q_train_test_split(spark, sf):
    return TR.train_test_split(_features(spark, sf), "ingest_seq").select("ingest_seq", "split")


def _scores(spark, sf):
    li = read_table(spark, sf, "lineitem")
    return li.select(F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("label"),
                     ((F.col("l_discount") + F.col("l_tax") + 0.01) / 0.2).alias("p"))


SCORES_CTE = """scores AS (
  SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label,
         (l_discount + l_tax + 0.01) / 0.2 AS p FROM lineitem)"""


@register("eval_metrics", with_ctes("""
SELECT round(-avg(label * ln(greatest(least(p, 1 - 1e-15), 1e-15))
                 + (1 - label) * ln(1 - greatest(least(p, 1 - 1e-15), 1e-15))), 6) AS logloss,
       round(avg(CASE WHEN CAST(p > 0.5 AS DOUBLE) <> label THEN 1.0 ELSE 0.0 END), 6) AS error,
       round(sqrt(avg((p - label) * (p - label))), 6) AS rmse,
       round(avg(abs(p - label)), 6) AS mae, count(*) AS n
FROM scores""", SCORES_CTE))
def q_eval_metrics(spark, sf):
    return TR.eval_metrics(_scores(spark, sf))


@register("eval_auc", with_ctes("""
, s AS (SELECT label, p, rank() OVER (ORDER BY p) AS rmin, count(*) OVER (PARTITION BY p) AS c FROM scores),
a AS (SELECT sum(label) AS npos, count(*) - sum(label) AS nneg,
             sum(CASE WHEN label = 1 THEN rmin + (c - 1) / 2.0 ELSE 0 END) AS rs FROM s)
SELECT round((rs - npos * (npos + 1) / 2.0) / (npos * nneg), 6) AS auc FROM a""", SCORES_CTE))
def q_eval_auc(spark, sf):
    return TR.eval_auc(_scores(spark, sf))


BUCKET_SQL = "CAST(('0x' || substr(sha256(CAST(ingest_seq AS VARCHAR)), 1, 8)) AS BIGINT) % 10"
TEST_SQL = f"(SELECT * FROM features WHERE {BUCKET_SQL} < 3)"


def _train_test(spark, sf, features=None):
    f = TR.train_test_split(features if features is not None else _features(spark, sf), "ingest_seq")
    mapping = TR.category_mapping(f.filter(F.col("split") == "train"))
    enc = materialize(TR.encode_categories(f.withColumn("price", F.col("price").cast("double")), mapping))
    return enc, mapping


@register("test_split_encoded", with_ctes(
    _encoded_sql(TEST_SQL, "f.ingest_seq, "), MAPPING_CTES.format(src=f"(SELECT * FROM features WHERE {BUCKET_SQL} >= 3)")))
def q_test_split_encoded(spark, sf):
    """The test split under the train split's encoding, as the model sees it."""
    enc, _ = _train_test(spark, sf)
    return enc.filter(F.col("split") == "test").select("ingest_seq", *TR.TRAINING_COLUMNS)


@register("train_predict")
def q_train_predict(spark, sf):
    """Tuned boosted trees fitted on the train split, scoring the test split:
    inputs, label, purchase probability and prediction (0 or 1)."""
    enc, _ = _train_test(spark, sf)
    model, _ = TR.fit_tuned(enc.filter(F.col("split") == "train"), MODEL_FEATURES)
    return TR.score(model, enc.filter(F.col("split") == "test")).select(
        "ingest_seq", *TR.TRAINING_COLUMNS, "p", "prediction")


@register("trials")
def q_trials(spark, sf):
    """The trial table: every sampled parameter set and its error."""
    enc, _ = _train_test(spark, sf)
    return TR.hyperparameter_search(enc.filter(F.col("split") == "train"), MODEL_FEATURES)


@register("best_trial")
def q_best_trial(spark, sf):
    """The trial of least error: its number, parameters and error."""
    return TR.best_trial(materialize(q_trials(spark, sf)))


SERVED_FLOATS = {"price": "FLOAT", "activity_count": "INTEGER"}


def _served_sql() -> str:
    """Requests with their latest features, coerced and encoded."""
    cols = [c for c in TR.SERVING_FEATURES]
    looked = ", ".join(f"coalesce(CAST(l.{c} AS {SERVED_FLOATS[c]}), 0) AS {c}" if c in SERVED_FLOATS else f"l.{c}" for c in cols)
    picked = ", ".join(f"CAST(coalesce(m{ENCODED.index(c)}.idx, -1) AS INTEGER) AS {c}" if c in ENCODED
                       else (f"round(CAST(f.{c} AS DOUBLE), 6) AS {c}" if c == "price" else f"f.{c}") for c in cols)
    joins = "\n".join(f"LEFT JOIN mapping m{i} ON m{i}.feature = '{c}' AND m{i}.value = CAST(f.{c} AS VARCHAR)" for i, c in enumerate(ENCODED))
    return f""", f AS (
  SELECT r.user_id, r.product_id, {looked}
  FROM (SELECT DISTINCT user_id, product_id FROM behaviour WHERE event_type = 'purchase') r
  LEFT JOIN latest l ON r.user_id = l.user_id AND r.product_id = l.product_id
    AND l.event_timestamp >= {REQUEST_TS_SQL} - INTERVAL 1 DAY)
SELECT f.user_id, f.product_id, {picked} FROM f
{joins}"""


def _served(spark, sf, features, vocabulary):
    looked = FE.feature_lookup(_requests(spark, sf), FE.latest_per_key(features))
    looked = TR.select_present(looked, keep=["user_id", "product_id"])
    looked = TR.coerce_numeric(looked, {"price": "float", "activity_count": "int"})
    return TR.encode_categories(looked, vocabulary).withColumn("price", F.col("price").cast("double"))


@register("serving_features", with_ctes(_served_sql(), MAPPING_CTES.format(src=f"(SELECT * FROM features WHERE {BUCKET_SQL} >= 3)")))
def q_serving_features(spark, sf):
    """What the model is asked with: latest features of each request, projected,
    coerced and encoded by the train split's vocabulary."""
    features = materialize(_features(spark, sf))
    _, mapping = _train_test(spark, sf, features)
    return _served(spark, sf, features, mapping).select("user_id", "product_id", *TR.SERVING_FEATURES)


@register("score_features")
def q_score_features(spark, sf):
    """Serving features with the saved and reloaded model's probability and prediction."""
    features = materialize(_features(spark, sf))   # one validation for training and serving
    enc, mapping = _train_test(spark, sf, features)
    train = enc.filter(F.col("split") == "train")
    model, _ = TR.fit_tuned(train, MODEL_FEATURES)
    path = scratch_path(spark, f"model-{uuid.uuid4().hex[:12]}")
    held = TR.score(model, enc.filter(F.col("split") == "test"))
    TR.save_model(model, mapping, TR.eval_metrics(held, TR.LABEL, "p"), path)
    saved, vocabulary = TR.load_model(spark, path)
    return TR.score(saved, _served(spark, sf, features, vocabulary)).select(
        "user_id", "product_id", *TR.SERVING_FEATURES, "p", "prediction")
