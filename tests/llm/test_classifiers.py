"""Toxicity and quality on labels that were not learned from."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortium.llm import mil_quality as Q
from cohortium.llm import ordinal_toxicity as O

from .frames import SF01, awkward, empty


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF01}/documents.parquet"), spark.read.parquet(f"{SF01}/labels.parquet")


def auc(score, y):
    """Area under the curve; equal scores share their mean rank."""
    _, group, size = np.unique(score, return_inverse=True, return_counts=True)
    rank = (np.cumsum(size) - (size - 1) / 2)[group]
    pos = y == 1
    return (rank[pos].sum() - pos.sum() * (pos.sum() + 1) / 2) / (pos.sum() * (~pos).sum())


@pytest.mark.parametrize("sf", [SF01, SF01.replace("0.01", "0.1")])
def test_toxicity_on_unseen_labels(spark, sf):
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    unseen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    model = O.train(docs, labels.where(~unseen))
    got = O.score_documents(docs, model).withColumnRenamed("toxic", "said").join(labels.where(unseen), "doc_id").toPandas()
    y = got["toxic"].to_numpy()
    assert auc(got["score"].to_numpy(), y) > 0.9
    assert got.loc[y == 0, "said"].mean() < 0.08 and got.loc[y == 1, "said"].mean() > 0.6
    assert got["expected_severity"].between(0, O.GRADES).all() and got["severity"].between(0, O.GRADES).all()


def test_thresholds_rise_and_weights_are_shared(tables):
    model = O.train(*tables)
    assert (np.diff(model.thresholds) > 0).all() and model.weights.shape == model.slots.shape
    p = model.grades(np.linspace(-5, 5, 50))
    assert np.allclose(p.sum(axis=1), 1) and (np.diff(p @ np.arange(O.GRADES + 1)) > 0).all()


def test_ordinal_fit():
    """The fit recovers weights and thresholds of data made by the model."""
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 3))
    eta = x @ np.array([1.5, -1.0, 0.0])
    grade = np.searchsorted([0.0, 1.0, 2.0], eta + rng.logistic(size=400))
    sparse = O.Sparse(np.repeat(np.arange(400), 3), np.tile(np.arange(3), 400), x.ravel(), x.shape)
    w, t = O._fit(sparse, grade, np.ones(400), steps=1500)
    assert abs(w[0] - 1.5) < 0.5 and abs(w[1] + 1.0) < 0.5 and abs(w[2]) < 0.4 and (np.abs(t - [0, 1, 2]) < 0.6).all()


def test_ordinal_gradient():
    """The fit's optimum: no small step of a weight raises the penalised likelihood."""
    rng = np.random.default_rng(3)
    x = np.abs(rng.normal(size=(120, 2)))
    grade = rng.integers(0, O.GRADES + 1, 120)
    w, t = O._fit(O.Sparse(np.repeat(np.arange(120), 2), np.tile(np.arange(2), 120), x.ravel(), x.shape), grade, np.ones(120), steps=3000)

    def loss(w):
        model = O.Model(np.arange(2), np.ones(2), w, t, 0.5)
        return -np.log(model.grades(x @ w)[np.arange(120), grade]).mean() + O.RIDGE / 2 * (w ** 2).sum()

    for d in (np.array([1e-2, 0]), np.array([0, 1e-2])):
        assert loss(w) <= min(loss(w + d), loss(w - d))


def test_quality_on_held_out_documents(tables):
    docs, labels = tables
    got = Q.quality(docs, labels).join(labels.drop("toxic"), "doc_id").where("held_out").toPandas()
    y = got["quality"].to_numpy()
    assert len(got) > 100 and auc(got["score"].to_numpy(), y) > 0.9
    assert (got["predicted"].to_numpy() == y).mean() > 0.9


def test_held_out_labels_are_not_learned(tables):
    docs, labels = tables
    flipped = labels.withColumn("quality", F.when(Q.is_held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    a = Q.quality(docs, labels).orderBy("doc_id").toPandas()
    b = Q.quality(docs, flipped).orderBy("doc_id").toPandas()
    assert np.allclose(a["score"], b["score"])


def test_attention_finds_the_telling_passage():
    rng = np.random.default_rng(1)
    sizes = rng.integers(1, 6, 200)
    x = rng.normal(size=(sizes.sum(), Q.SIZE)).astype("f4")
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    y = (np.maximum.reduceat(x[:, 0], starts) > 1.0).astype(int)  # one telling passage decides
    model = Q.fit(x, sizes, y, np.ones(200), steps=400)
    assert ((model.scores(x, sizes) >= 0.5) == y).mean() > 0.95


def test_awkward_rows(spark, tables):
    df = awkward(spark)
    docs, labels = tables
    for got in (O.score_documents(df, O.train(docs, labels)), Q.score_documents(df, Q.train(docs, labels))):
        rows = got.collect()
        assert len(rows) == df.count() and all(0 <= r.score <= 1 for r in rows)
    none = labels.where("false")
    assert {r.severity for r in O.severity(df, none).collect()} == {0}
    assert {r.score for r in Q.quality(df, none).collect()} == {0.5}
    assert O.severity(empty(spark), labels).count() == 0 and Q.quality(empty(spark), labels).count() == 0
