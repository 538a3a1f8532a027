"""Registered queries against their SQL on the smallest tables."""

import os

import pytest

from caselode.plans.registry import QUERIES
from checks.compare import database, difference
from checks.sql import oracle_sql

FOLDER = "/root/testdata/sf0.001"
SQL = oracle_sql()
# their rows depend on the solver; the tests below hold them
SOLVER = {
    "svm_objective", "svm_predict", "svm_metrics", "svm_errors", "svm_error_profile", "model_comparison_svm", "f1_series_svm",
}


def test_every_query_but_the_svm_has_sql():
    assert set(QUERIES) - set(SQL) == SOLVER
    assert not set(SQL) - set(QUERIES)


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")
@pytest.mark.parametrize("name", SQL)
def test_query_equals_sql(spark, name):
    result = QUERIES[name](spark, FOLDER).toPandas()
    assert difference(result, database(FOLDER).execute(SQL[name]).df()) is None


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")
def test_result_does_not_depend_on_partitions(spark):
    name, key = "self_similarity_topk", "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    a = QUERIES[name](spark, FOLDER).toPandas()
    spark.conf.set(key, "13")
    try:
        assert difference(a, QUERIES[name](spark, FOLDER).toPandas()) is None
    finally:
        spark.conf.set(key, before)


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")
def test_svm_tables_fit_together(spark):
    got = {name: QUERIES[name](spark, FOLDER).collect() for name in SOLVER}
    pred = got["svm_predict"]
    right = sum(r.true_label == r.pred_label for r in pred)
    assert right > max(sum(r.true_label == c for r in pred) for c in {r.true_label for r in pred})
    assert abs(got["svm_metrics"][0].accuracy - right / len(pred)) < 1e-4
    assert len(got["svm_errors"]) == len(pred) - right
    assert sum(r.value for r in got["svm_error_profile"] if r.part == "true_label") == len(pred) - right
    assert {r.label for r in got["svm_objective"]} >= {r.pred_label for r in pred}
    assert all(0 < r.objective <= sum(x.n_train for x in got["svm_objective"]) for r in got["svm_objective"])
    models = {r.model: r for r in got["model_comparison_svm"]}
    others = database(FOLDER).execute(SQL["model_comparison"]).df()
    assert len(models) == 4 and set(others.model) == set(models) - {"TF-IDF + SVM"}
    for r in others.itertuples():
        assert abs(models[r.model].f1 - r.f1) < 1e-9
    assert {r.model for r in got["f1_series_svm"]} == set(models)
