"""Sampled search, tuned final fit, saved model."""
import random
import uuid

from pyspark.sql import functions as F

from tidemark.operators import training as TR
from tidemark.session import scratch_path

FEATURES = ["price", "activity_count"]


def _rows(spark, n=400):
    """A planted rule: dear and active means bought, with some noise."""
    rng = random.Random(1)
    rows = []
    for _ in range(n):
        price, active = rng.random(), float(rng.randrange(5))
        rows.append((price, active, int((price > 0.5) != (rng.random() < 0.05))))
    return spark.createDataFrame(rows, "price double, activity_count double, is_purchased int")


def test_trials_cover_the_space():
    trials = TR.sample_trials(200)
    assert set(trials[0]) == set(TR.SEARCH_SPACE) and len(TR.SEARCH_SPACE) == 6
    for k, (kind, values) in TR.SEARCH_SPACE.items():
        seen = [t[k] for t in trials]
        assert set(seen) == set(values) if kind == "choice" else min(seen) >= values[0] and max(seen) <= values[1]


def test_final_fit_has_the_best_trials_parameters_and_learns(spark, tmp_path):
    train = _rows(spark)
    trials = [dict(t, minInfoGain=0.0) for t in TR.sample_trials(2, seed=5)]
    model, table = TR.fit_tuned(train, FEATURES, trials)
    best = TR.best_trial(table).first()
    assert best.validation_rmse == min(r.validation_rmse for r in table.collect())
    classifier = model.stages[1]
    assert classifier.getOrDefault("maxDepth") == best.maxDepth and classifier.getOrDefault("stepSize") == best.stepSize
    assert classifier.getOrDefault("minInstancesPerNode") == best.minInstancesPerNode
    assert classifier.getOrDefault("featureSubsetStrategy") == str(best.featureSubsetStrategy)
    scored = TR.score(model, train)
    auc = TR.eval_auc(scored.select(F.col("is_purchased").alias("label"), "p")).first().auc
    assert auc > 0.85

    path = scratch_path(spark, f"test-model-{uuid.uuid4().hex[:8]}")
    mapping = spark.createDataFrame([("brand", "a", 0)], "feature string, value string, idx int")
    TR.save_model(model, mapping, TR.eval_metrics(scored.withColumnRenamed("is_purchased", "label")), path)
    loaded, vocabulary = TR.load_model(spark, path)
    assert [tuple(r) for r in vocabulary.collect()] == [("brand", "a", 0)]
    again = TR.score(loaded, train)
    assert sorted(r.p for r in again.collect()) == sorted(r.p for r in scored.collect())
    assert spark.read.json(f"{path}/metrics").first().n == 400


def test_best_trial_is_found_among_rates_that_matter(spark):
    """With one round the learning rate is never applied: every rate has the same error."""
    drawn = dict(TR.sample_trials(1)[0], minInfoGain=0.0)
    table = TR.hyperparameter_search(_rows(spark), FEATURES, [dict(drawn, stepSize=r) for r in (1e-4, 1e-1)])
    slow, quick = (r.validation_rmse for r in table.orderBy("trial_id").collect())
    assert quick < slow - 1e-3 and TR.best_trial(table).first().trial_id == 1


def test_final_fit_at_the_drawn_parameters_splits_and_boosts(spark):
    train = _rows(spark)
    model, _ = TR.fit_tuned(train, FEATURES)
    classifier = model.stages[1]
    assert classifier.getNumTrees == TR.BOOST_ROUNDS > 1
    assert all(tree.numNodes > 1 for tree in classifier.trees)
    scored = TR.score(model, train).select(F.col("is_purchased").alias("label"), "p")
    assert scored.distinct().count() > 2 and TR.eval_auc(scored).first().auc > 0.85


def test_every_drawn_trial_finds_a_weak_rule(spark):
    """The least gain is drawn as a sum over rows; as a gain of one row it forbids all but the strongest splits."""
    rng = random.Random(2)
    rows = [(p, float(rng.randrange(5)), int((p > 0.5) != (rng.random() < 0.3))) for p in (rng.random() for _ in range(2000))]
    train = spark.createDataFrame(rows, "price double, activity_count double, is_purchased int")
    table = TR.hyperparameter_search(train, FEATURES).collect()
    assert len(table) == TR.TRIALS and all(r.minInfoGain > 0.1 for r in table)
    assert all(r.validation_rmse < 0.48 for r in table)      # one probability for all rows: 0.5


def test_least_gain_is_per_row():
    got = TR._typed({"minInfoGain": 0.5, "maxDepth": 3.0, "featureSubsetStrategy": 0.7}, 1e6)
    assert got == {"minInfoGain": 0.5 / 1e6, "maxDepth": 3, "featureSubsetStrategy": "0.7"}
    assert TR._typed({"minInfoGain": 0.5}, 0)["minInfoGain"] == 0.5 and TR._typed({"maxDepth": 4}, 9) == {"maxDepth": 4}


def test_serving_helpers(spark):
    df = spark.createDataFrame([("1.5", "x", 3)], "price string, activity_count string, other int")
    got = TR.coerce_numeric(TR.select_present(df, ["brand", "price", "activity_count"]), {"price": "float", "activity_count": "int"})
    assert got.columns == ["price", "activity_count"] and tuple(got.first()) == (1.5, 0)
    assert TR.fit_gbt(_rows(spark, 60), FEATURES).getNumTrees == TR.BOOST_ROUNDS


def test_training_queries_return_what_the_model_says(spark):
    """Probabilities, predictions, parameters and errors of the queries belong together."""
    import math

    from conftest import SF_SMALL

    import __spark_entry__ as E
    q = E.queries()
    trials = [r.asDict() for r in q["trials"](spark, SF_SMALL).collect()]
    assert [t["trial_id"] for t in trials] == list(range(TR.TRIALS))
    want = TR.sample_trials()
    for t, w in zip(trials, want):
        assert all(abs(t[k] - float(w[k])) < 1e-6 for k in w) and 0 < t["validation_rmse"] < 1
    best = q["best_trial"](spark, SF_SMALL).first().asDict()
    least = min(trials, key=lambda t: (t["validation_rmse"], t["trial_id"]))
    assert best["trial_id"] == least["trial_id"] and abs(best["validation_rmse"] - least["validation_rmse"]) < 0.02
    for name in ("train_predict", "score_features"):
        rows = q[name](spark, SF_SMALL).collect()
        assert rows and all(0 <= r.p <= 1 and r.prediction == float(r.p > 0.5) for r in rows)
    rows = q["train_predict"](spark, SF_SMALL).collect()
    rmse = math.sqrt(sum((r.p - r.is_purchased) ** 2 for r in rows) / len(rows))
    assert abs(rmse - best["validation_rmse"]) < 0.15
    assert rmse < math.sqrt(sum((0.5 - r.is_purchased) ** 2 for r in rows) / len(rows))     # better than no opinion
    served = q["serving_features"](spark, SF_SMALL).collect()
    assert sorted(map(tuple, served)) == sorted(tuple(r)[:-2] for r in q["score_features"](spark, SF_SMALL).collect())
