"""Kneser-Ney models: probabilities, held-out accuracy, rejection."""

import random

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from cohortium.llm import kn_langid as K

from .frames import SF01, awkward, empty


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF01}/documents.parquet")


@pytest.fixture(scope="module")
def model(documents):
    return K.train_on_documents(documents)


def naive_rows(words):
    """Counts of every order from a list of words, as the folded table has them."""
    level = K._grams({w: words.count(w) for w in set(words)})
    rows = []
    for m in range(K.ORDER, 0, -1):
        for g, c in level.items():
            slot, ctx, suf = K._xxhash_slots([g, g[:-1], g[1:]])
            rows.append(("xx", m, slot, ctx, suf, c))
        below = {}
        for g in level:
            below[g[1:]] = below.get(g[1:], 0) + 1
        level = below
    return pd.DataFrame(rows, columns=["lang", "m", "slot", "ctx", "suf", "c"])


def test_spark_counts_equal_plain_counts(spark):
    texts = ["the cat. The hat", "that 3rd thé"]
    df = spark.createDataFrame([(t, "xx") for t in texts] + [(None, "xx"), ("a", None)], "text string, lang string")
    got = K.folded_counts(K.gram_counts(df)).toPandas().sort_values(["m", "slot"]).reset_index(drop=True)
    words = [w for t in texts for p in t.lower().split() for w in K.LETTERS.findall(p)]
    want = naive_rows(words).groupby(["lang", "m", "slot"], as_index=False).agg(ctx=("ctx", "min"), suf=("suf", "min"), c=("c", "sum"))
    want = want.sort_values(["m", "slot"]).reset_index(drop=True)
    assert (got[want.columns].to_numpy() == want.to_numpy()).all()


def test_probabilities_sum_to_one():
    words = ["the", "then", "that", "hat", "cat", "catch", "other"] * 3
    model = K.Model.of(naive_rows(words))
    letters = sorted(set("".join(words))) + [K.END]
    for ctx in ("the", "\x02\x02t", "cat", "zzz", "xat"):
        grams = [ctx + c for c in letters]
        slots = [K._xxhash_slots([g[K.ORDER - m:] for g in grams]) for m in range(1, K.ORDER + 1)]
        contexts = [K._xxhash_slots([g[K.ORDER - m:-1] for g in grams]) for m in range(1, K.ORDER + 1)]
        total = np.exp(model.gram_scores(slots, contexts)[:, 0]).sum()
        # the alphabet has one place for unseen characters
        assert 0.8 < total <= 1.0001, (ctx, total)


def test_held_out_accuracy_and_few_rejections(documents, model):
    got = K.identify(documents.select("doc_id", "text", "lang", K.is_held_out().alias("held_out")), model, ["doc_id", "lang", "held_out"]).toPandas()
    out = got[got["held_out"]]
    assert len(out) > 150 and (out["lang"] == out["lang_pred"]).mean() > 0.97
    assert got["rejected"].mean() < 0.005 and got["score"].between(0, 1).all()


def test_every_training_row_sets_the_limit(spark):
    """More rows than a sample would hold, some long; the third language has too few of its own."""
    rnd = random.Random(3)
    sounds = {"aa": ["ba", "lo", "ti", "mer"], "bb": ["sch", "ung", "ver", "ein"], "cc": ["xo", "ka"]}
    rows = [(" ".join("".join(rnd.choices(sounds[x], k=rnd.randint(1, 4))) for _ in range(rnd.choice([1, 3, 9, 60]))), x)
            for x, n in (("aa", 6000), ("bb", 5000), ("cc", 7)) for _ in range(n)]
    rows += [("ver" * 40 + " qqq", "aa"), ("...", "bb"), (None, "aa"), ("lotimer", None)]
    model = K.train(spark.createDataFrame(rows, "text string, lang string"))
    own = [(x, t) for t, x in rows if t and x]
    k = np.array([model.langs.index(x) for x, _ in own])
    totals = K.Scorer(model).totals(pa.array([t for _, t in own]))
    some = totals[:, -1] > 0
    k, n, h = k[some], totals[some, -1], -totals[some, :][np.arange(some.sum()), k[some]] / totals[some, -1]
    usual = []
    for i in range(3):
        mine = k == i if (k == i).sum() >= 20 else np.full(len(k), True)
        mean = np.average(h[mine], weights=np.sqrt(n[mine]))
        square = (h[mine] - mean) ** 2
        wide = np.sqrt(square[n[mine] >= np.median(n[mine])].mean())
        usual.append((mean, wide, np.sqrt((np.maximum(square - wide ** 2, 0) * n[mine]).mean())))
    assert model.usual == pytest.approx(np.array(usual), rel=1e-6)
    z = (h - model.usual[k, 0]) / np.sqrt(model.usual[k, 1] ** 2 + model.usual[k, 2] ** 2 / n)
    assert model.limit == pytest.approx(K.MARGIN * max(1.0, np.quantile(z, K.TOLERANCE)), rel=1e-6)


def test_one_scoring_pass_equals_training_apart(documents, model):
    """The query's and the stage's rows are those of a model that was trained beforehand."""
    got = sorted(map(tuple, K.predict_documents(documents).select("doc_id", "lang_pred", "rejected").collect()))
    assert got == sorted(map(tuple, K.identify(documents, model, ["doc_id"]).select("doc_id", "lang_pred", "rejected").collect()))
    kept = K.keep_recognised(documents)
    assert kept.schema == documents.schema
    assert sorted(kept.collect(), key=repr) == sorted(K.keep_identified(documents, model).collect(), key=repr)


def test_foreign_text_is_rejected(spark, model):
    texts = ["zxqv kjwz pqxz vvkq zzxj qkwx xzqj vkqz " * 20, "Ωμέγα και άλφα στην αρχή " * 20, "12345 !!! ² ½", None, "The and that of it was for the are with"]
    df = spark.createDataFrame([(i, t, None) for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in K.identify(df, model, ["doc_id"]).collect()}
    assert got[0].rejected and got[1].rejected and not got[4].rejected and got[4].lang_pred == "en"
    assert [got[i].lang_pred for i in (2, 3)] == ["und", "und"] and got[2].score == 0


def test_awkward_rows(spark, model):
    df = awkward(spark)
    assert K.predict_documents(df).count() == df.count()
    assert K.predict_documents(empty(spark)).count() == 0
    none = df.withColumn("lang", df["lang"].substr(9, 1)).selectExpr("doc_id", "text", "cast(null as string) AS lang")
    assert {r.lang_pred for r in K.predict_documents(none).collect()} == {"und"}
    kept = K.keep_identified(df, model)
    assert kept.schema == df.schema and kept.where("text IS NULL").count() == 0


def test_inputs_of_a_prediction(documents, model):
    """lang, source and ids play no part in a prediction."""
    some = documents.limit(50)
    a = K.identify(some, model, ["doc_id"]).orderBy("doc_id").collect()
    other = some.selectExpr("doc_id", "text", "'zz' AS lang", "'none' AS source")
    assert a == K.identify(other, model, ["doc_id"]).orderBy("doc_id").collect()
