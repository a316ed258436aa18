import warnings

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadledger.operators import model, scoring
from roadledger.operators.scoring import MODEL_FEATURES


def examples(spark, n=400, separable=False, with_null=0):
    rng = np.random.default_rng(7)
    x = np.column_stack([rng.uniform(20, 100, n), rng.uniform(0.5, 3, n), rng.integers(0, 60, n),
                         rng.uniform(0, 50, n), rng.uniform(2, 25, n)])
    z = 1.0 - 0.05 * x[:, 0] + 0.4 * x[:, 1] + 0.03 * x[:, 2] + 0.02 * x[:, 3] + 0.01 * x[:, 4]
    y = (x[:, 0] < 60).astype(int) if separable else (rng.uniform(size=n) < 1 / (1 + np.exp(-z))).astype(int)
    data = [(*map(float, row), int(label)) for row, label in zip(x, y)]
    data += [(50.0, 1.0, 1.0, 1.0, None, 1)] * with_null
    ddl = ", ".join(f"{name} double" for name in MODEL_FEATURES) + ", has_accident int"
    return spark.createDataFrame(data, ddl).withColumns({
        "driver_id": F.monotonically_increasing_id(), "total_events": F.lit(1), "accident_count": F.lit(0)}), x, y


def irls(x, y, steps=25):
    x = np.column_stack([np.ones(len(x)), x])
    beta = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-x @ beta))
        w = p * (1 - p)
        beta = beta + np.linalg.solve(x.T @ (x * w[:, None]), x.T @ (y - p))
    return beta


def test_coefficients_match_plain_irls(spark):
    df, x, y = examples(spark, with_null=3)
    fitted = model.train_accident_model(df).first()
    assert np.allclose(fitted["coef"], irls(x, y), rtol=1e-5, atol=1e-7)
    assert (fitted["rows_used"], fitted["rows_skipped"], fitted["separable"]) == (400, 3, False)
    assert len(fitted["std_err"]) == 6 and all(e > 0 for e in fitted["std_err"])
    assert 1 <= fitted["num_iterations"] <= 20


def test_stored_model_predicts_as_the_fitted_one(spark):
    df, x, y = examples(spark)
    table = model.train_accident_model(df)
    got = [r[0] for r in scoring.predict_accident_probability(df, table)
           .orderBy("driver_id").select("accident_probability").collect()]
    beta = np.array(table.first()["coef"])
    assert np.allclose(got, 1 / (1 + np.exp(-(beta[0] + x @ beta[1:]))))
    scores = scoring.score_logistic(df, table)
    assert scores.where("safe_driver_score < 0 or safe_driver_score > 100").count() == 0


def test_separable_data_is_reported(spark):
    df, _, _ = examples(spark, separable=True)
    with pytest.warns(UserWarning, match="separable"):
        fitted = model.train_accident_model(df, max_iter=60).first()
    assert fitted["separable"]
    with warnings.catch_warnings():
        warnings.simplefilter("error", UserWarning)
        tamed = model.train_accident_model(df, reg_param=0.1).first()
    assert not tamed["separable"] and tamed["max_abs_coef"] < fitted["max_abs_coef"]


def test_evaluation(spark):
    predicted = spark.createDataFrame([(1, 0.9), (1, 0.4), (0, 0.5), (0, 0.1), (0, 0.2), (1, None)],
                                      "has_accident int, accident_probability double")
    got = model.model_evaluate(predicted).first()
    assert (got["true_positive"], got["false_positive"], got["true_negative"], got["false_negative"]) == (1, 1, 2, 1)
    assert got["accuracy"] == pytest.approx(0.6) and got["area_under_roc"] == pytest.approx(5 / 6)
