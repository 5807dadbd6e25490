"""Toxicity severity by cumulative-link ordinal regression over sparse text features.

Features are hashed words and word beginnings; a feature's value is the logarithm of
how often it occurs above what clean texts of that length lead to expect (0 if not
above), so absent and ordinary features are zero. The labels only say toxic or not;
grades 1 to 3 of toxic documents are the thirds of the rate at which the strongest
features occur in them, grade 0 is clean. P(grade <= k) = logistic(t[k] - w.x): one
weight vector, rising thresholds t. The result is the expected grade, the likeliest
grade, P(toxic) and whether that passes the cut that best separates the sample.

The model is fitted on a bounded, balanced sample (``PER_CLASS`` documents of each
class, weighted back); features are counted over all of the sample by Spark. Every
feature that ``LEAST_DOCS`` toxic documents hold, and that toxic documents hold more
often than clean ones, is learned: the sample bounds them, no number of features does,
and a ridge penalty keeps the weights of the many small.

Edge cases: NULL and wordless texts have no features and get the clean grade's
score; a NULL ``doc_id`` is scored; repeated rows each get their row; without labels
of both classes everything is grade 0; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortium.llm.common import doc_texts, stored
from cohortium.llm.labelled import adam, labelled_sample

PER_CLASS = 4000
SLOTS = 1 << 22
STARTS = range(4, 9)
LEAST_DOCS = 5
RIDGE = 2e-3
GRADES = 3
STRONG = 2.0
KNOWN_PIECES = 300_000
WORD = re.compile(r"[^\W\d_]+")


def features_of(word: str) -> list[int]:
    """Slots of the word and of its beginnings."""
    names = ["=" + word, *("^" + word[:k] for k in STARTS if k < len(word))]
    return [zlib.crc32(n.encode("utf-8")) % SLOTS for n in names]


class Counts:
    """Feature counts of texts; what a white-space separated piece holds is kept per worker."""

    def __init__(self, kept: dict[int, int] | None = None):
        self.kept = kept
        self.known: dict[str, tuple[tuple[int, ...], int]] = {}

    def piece(self, piece: str) -> tuple[tuple[int, ...], int]:
        got = self.known.get(piece)
        if got is None:
            words = WORD.findall(piece)
            slots = [s for w in words for s in features_of(w)]
            if self.kept is not None:
                slots = [self.kept[s] for s in slots if s in self.kept]
            got = tuple(slots), len(words)
            if len(self.known) < KNOWN_PIECES:
                self.known[piece] = got
        return got

    def text(self, text: str | None) -> tuple[Counter, int]:
        tf: Counter = Counter()
        n = 0
        for piece, times in Counter((text or "").lower().split()).items():
            slots, words = self.piece(piece)
            n += words * times
            for s in slots:
                tf[s] += times
        return tf, n


def _sample_features(batches):
    counts = Counts()
    for b in batches:
        got = [counts.text(t) for t in b.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), b.column("y"), b.column("weight"), pa.array([n for _, n in got], pa.int64()),
             pa.array([list(tf) for tf, _ in got], pa.list_(pa.int32())), pa.array([list(tf.values()) for tf, _ in got], pa.list_(pa.int32()))],
            names=["doc_id", "y", "weight", "n", "slots", "tf"])


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


class Model:
    def __init__(self, slots: np.ndarray, base: np.ndarray, weights: np.ndarray, thresholds: np.ndarray, cut: float):
        self.slots, self.base, self.weights, self.thresholds, self.cut = slots, base, weights, thresholds, cut
        self.at = {int(s): i for i, s in enumerate(slots)}

    def lift(self, idx: np.ndarray, tf: np.ndarray, n: float | np.ndarray) -> np.ndarray:
        return np.maximum(0.0, np.log((tf + 0.5) / (n * self.base[idx] + 0.5)))

    def grades(self, eta: np.ndarray) -> np.ndarray:
        """Probability of each grade, 0 to GRADES."""
        below = _sigmoid(self.thresholds[None, :] - eta[:, None])
        return np.diff(below, axis=1, prepend=0.0, append=1.0)


class Sparse:
    """The features of the sample: ``values[k]`` of document ``rows[k]`` and feature ``cols[k]``."""

    def __init__(self, rows: np.ndarray, cols: np.ndarray, values: np.ndarray, shape: tuple[int, int]):
        self.rows, self.cols, self.values, self.shape = rows, cols, values, shape

    def __matmul__(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.rows, self.values * w[self.cols], self.shape[0])

    def back(self, d: np.ndarray) -> np.ndarray:
        """The transposed product."""
        return np.bincount(self.cols, self.values * d[self.rows], self.shape[1])


def _fit(x: Sparse, grade: np.ndarray, weight: np.ndarray, steps: int = 600) -> tuple[np.ndarray, np.ndarray]:
    """Weights and rising thresholds (first one and logs of the steps) by Adam on the weighted likelihood."""
    weight = weight / weight.sum()

    def thresholds(t):
        return np.cumsum(np.concatenate([t[:1], np.exp(t[1:])]))

    def gradients(params):
        w, t = params
        eta, th = x @ w, thresholds(t)
        edges = np.concatenate([[-np.inf], th, [np.inf]])
        low, high = edges[grade] - eta, edges[grade + 1] - eta
        fl, fh = _sigmoid(low), _sigmoid(high)
        p = np.maximum(fh - fl, 1e-12)
        dl, dh = fl * (1 - fl), fh * (1 - fh)
        dl[grade == 0] = 0
        dh[grade == len(th)] = 0
        d_eta = weight * (dh - dl) / p
        d_th = np.zeros(len(th) + 2)
        np.add.at(d_th, grade + 1, -weight * dh / p)
        np.add.at(d_th, grade, weight * dl / p)
        d_th = d_th[1:-1]
        tail = np.cumsum(d_th[::-1])[::-1]
        return [x.back(d_eta) + RIDGE * w, np.concatenate([tail[:1], tail[1:] * np.exp(t[1:])])]

    w, t = adam([np.zeros(x.shape[1]), np.concatenate([[2.0], np.zeros(GRADES - 1)])], gradients, steps, 0.05)
    return w, thresholds(t)


def kept_features(rows: DataFrame, slots: np.ndarray) -> DataFrame:
    """(doc_id, slots, tf): the features among ``slots`` that each document holds."""
    wanted = F.broadcast(rows.sparkSession.createDataFrame([(int(s),) for s in slots], "slot int"))
    each = rows.select("doc_id", F.explode(F.arrays_zip("slots", "tf")).alias("f")).select("doc_id", F.col("f.slots").alias("slot"), F.col("f.tf").alias("tf"))
    held = each.join(wanted, "slot").groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("slot", "tf"))).alias("f"))
    return held.select("doc_id", F.col("f.slot").alias("slots"), F.col("f.tf").alias("tf"))


def train(documents: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model | None:
    sample = labelled_sample(documents, labels, "toxic", per_class)
    rows = stored(sample.select("doc_id", "y", "weight", "text").mapInArrow(
        _sample_features, "doc_id long, y int, weight double, n long, slots array<int>, tf array<int>"), "toxic-sample")
    totals = {r["y"]: (r["docs"], r["words"]) for r in rows.groupBy("y").agg(F.count("*").alias("docs"), F.sum("n").alias("words")).collect()}
    if set(totals) != {0, 1}:
        return None
    (clean, clean_words), (toxic, _) = totals[0], totals[1]
    each = rows.select("y", F.explode(F.arrays_zip("slots", "tf")).alias("f")).select("y", F.col("f.slots").alias("slot"), F.col("f.tf").alias("tf"))
    # per class: documents with the feature, and how often clean ones hold it
    per = each.groupBy("slot").agg(F.count(F.when(F.col("y") == 1, 1)).alias("pos"), F.count(F.when(F.col("y") == 0, 1)).alias("neg"),
                                   F.sum(F.when(F.col("y") == 0, F.col("tf")).otherwise(0)).alias("neg_tf"),
                                   F.sum(F.when(F.col("y") == 1, F.log2(1 + F.col("tf"))).otherwise(0)).alias("pos_log"),
                                   F.sum(F.when(F.col("y") == 0, F.log2(1 + F.col("tf"))).otherwise(0)).alias("neg_log"))
    gap = F.col("pos_log") / toxic - F.col("neg_log") / clean
    best = per.where((F.col("pos") >= LEAST_DOCS) & (gap > 0)).orderBy("slot").toPandas()  # bounded by the sample
    if not len(best):
        return None
    slots = best["slot"].to_numpy()
    base = (best["neg_tf"].to_numpy() + 0.5) / (clean_words + 1)
    odds = np.log((best["pos"].to_numpy() + 0.5) / (toxic + 1)) - np.log((best["neg"].to_numpy() + 0.5) / (clean + 1))
    model = Model(slots, base, np.zeros(len(slots)), np.zeros(GRADES), 0.5)
    got = rows.select("doc_id", "y", "weight", "n").join(kept_features(rows, slots), "doc_id", "left").orderBy("doc_id").toArrow()
    y, n, weight = (got.column(c).to_numpy() for c in ("y", "n", "weight"))  # at most about 2 x per_class rows
    slot, tf = (got.column(c).combine_chunks() for c in ("slots", "tf"))
    at = np.repeat(np.arange(len(y)), pc.fill_null(pc.list_value_length(slot), 0))
    cols = np.searchsorted(slots, slot.flatten().to_numpy())
    tf = tf.flatten().to_numpy().astype("f8")
    x = Sparse(at, cols, model.lift(cols, tf, n[at]), (len(y), len(slots)))
    rate = np.bincount(at, np.where(odds[cols] >= STRONG, tf, 0.0), len(y)) / np.maximum(1, n)
    bounds = np.quantile(rate[y == 1], np.arange(1, GRADES) / GRADES)
    grade = np.where(y == 1, 1 + np.searchsorted(bounds, rate, side="right"), 0)
    balance = np.where(y == 1, 0.5 / weight[y == 1].sum(), 0.5 / weight[y == 0].sum()) * weight
    model.weights, model.thresholds = _fit(x, grade, balance)
    p = 1 - model.grades(x @ model.weights)[:, 0]
    cuts = np.unique(np.quantile(p, np.linspace(0, 1, 401)))
    caught = np.array([weight[(y == 1) & (p >= c)].sum() for c in cuts])
    wrong = np.array([weight[(y == 0) & (p >= c)].sum() for c in cuts])
    f1 = 2 * caught / (caught + wrong + weight[y == 1].sum())
    model.cut = float(cuts[int(f1.argmax())])
    return model


def _score(shared):
    def run(batches):
        model: Model | None = shared.value
        counts = Counts(model.at if model else {})
        for b in batches:
            texts = b.column("text").to_pylist()
            eta = np.zeros(len(texts))
            if model:
                for i, t in enumerate(texts):
                    tf, n = counts.text(t)
                    if tf:
                        idx = np.fromiter(tf, "i8", len(tf))
                        eta[i] = model.weights[idx] @ model.lift(idx, np.fromiter(tf.values(), "f8", len(tf)), n)
                p = model.grades(eta)
            else:
                p = np.tile(np.eye(GRADES + 1)[0], (len(texts), 1))
            toxic = 1 - p[:, 0]
            cols = [b.column("doc_id"), pa.array(p @ np.arange(GRADES + 1.0)), pa.array(p.argmax(axis=1).astype("i4")),
                    pa.array(toxic), pa.array(toxic >= (model.cut if model else 2))]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "expected_severity", "severity", "score", "toxic"])
    return run


def score_documents(documents: DataFrame, model: Model | None) -> DataFrame:
    shared = documents.sparkSession.sparkContext.broadcast(model)
    return doc_texts(documents).mapInArrow(_score(shared), "doc_id long, expected_severity double, severity int, score double, toxic boolean")


def severity(documents: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    return score_documents(documents, train(documents, labels, per_class))
