"""Every query with SQL agrees with DuckDB; the others return sound rows."""

import pytest

import __spark_entry__ as entry_module
from check_oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"
QUERIES, SQLS = entry_module.queries(), entry_module.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(SQLS))
def test_agrees_with_sql(spark, con, name):
    _, found = compare(QUERIES[name](spark, FOLDER), con, SQLS[name])
    assert not found


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0


def test_outlier_shares(spark):
    total = spark.read.parquet(f"{FOLDER}/lineitem.parquet").count()
    for name in ("ml_kmeans_outlier", "ml_isolation_forest"):
        share = QUERIES[name](spark, FOLDER).count() / total
        assert 0.03 < share < 0.07, name


def test_regression_beats_the_mean(spark):
    rows = QUERIES["ml_risk_regression"](spark, FOLDER).toPandas()
    assert rows.rmse.iloc[0] < rows.failure_risk.std()


def test_reloaded_model_scores_alike(spark):
    assert QUERIES["model_save_load"](spark, FOLDER).filter("NOT equal").count() == 0


@pytest.mark.parametrize("name", ["tx_tfidf_lr_fast", "tx_mlp"])
def test_text_models_return_probabilities(spark, name):
    rows = QUERIES[name](spark, FOLDER).toPandas()
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").count()
    assert len(rows) == labels and rows.toxicity_score.between(0, 1).all()
