"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages (lines, long ones cut). Every passage becomes a
vector of character-class shares, word statistics and hashed punctuation patterns; a
learned layer encodes it, gated attention (tanh times sigmoid) weighs the encoded
passages, and the weighted sum is scored. All weights are learned together from
document labels, on a bounded, balanced sample (``PER_CLASS`` documents of each
class, weighted back). Every passage of every document is encoded and weighed.

Edge cases: NULL, empty and blank texts are one empty passage, whose score the model
gives like any other; a NULL ``doc_id`` is scored (not held out); repeated rows each
get their row; without labels of both classes every score is 0.5; other columns are
ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortium.llm.common import stored
from cohortium.llm.labelled import adam, labelled_sample

PER_CLASS = 3000
PASSAGE = 800
SLICE = 4_000_000
ENCODED = 16
GATE = 12
STEPS = 300
SYMBOLS = "*&#$%|!?.,;:-_/\\()[]{}<>=+@'\""
_CLASSES = 6 + len(SYMBOLS)  # lower, upper, digit, space, other ASCII, non-ASCII, each symbol
_EXTRA = 7
SIZE = _CLASSES + _EXTRA


def _class_table() -> np.ndarray:
    t = np.full(129, 4, "u1")
    for c in range(128):
        ch = chr(c)
        t[c] = 0 if ch.islower() else 1 if ch.isupper() else 2 if ch.isdigit() else 3 if ch.isspace() else 6 + SYMBOLS.index(ch) if ch in SYMBOLS else 4
    t[128] = 5
    return t


CLASS = _class_table()


def passages(text: str | None) -> list[str]:
    out = []
    for line in (text or "").split("\n"):
        if line.strip():
            out += [line[i:i + PASSAGE] for i in range(0, len(line), PASSAGE)]
    return out or [""]


def encode_passages(texts: list[str]) -> np.ndarray:
    """One row of ``SIZE`` numbers per passage."""
    sizes = np.array([len(t) for t in texts], "i8")
    codes = np.minimum(np.frombuffer("".join(texts).encode("utf-32-le"), "<u4"), 128)
    owner = np.repeat(np.arange(len(texts)) * _CLASSES, sizes)
    counts = np.bincount(owner + CLASS[codes], minlength=len(texts) * _CLASSES).reshape(len(texts), _CLASSES)
    x = np.zeros((len(texts), SIZE), "f4")
    x[:, :_CLASSES] = np.sqrt(counts / np.maximum(sizes, 1)[:, None])
    for i, t in enumerate(texts):
        words = t.split()
        n = len(words)
        if n:
            unique = set(words)
            letters = sum(map(len, unique))
            x[i, _CLASSES:] = (np.log1p(n) / 5, len(unique) / n, letters / len(unique) / 10, len(unique) / (1 + n ** 0.75),
                               (words[0] == words[-1]) and n > 2, (len(set(words[:20])) / min(n, 20)), n >= 5)
    return x


def _flat(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """Passage rows of many documents and the number of passages of each."""
    bags = [passages(t) for t in texts]
    sizes = np.array([len(b) for b in bags], "i8")
    return encode_passages([p for b in bags for p in b]), sizes


class Model:
    def __init__(self, mean, spread, params):
        self.mean, self.spread, self.params = mean, spread, params

    def forward(self, x: np.ndarray, sizes: np.ndarray, raw: bool = True):
        """Scores of the bags, with all that a backward pass needs."""
        we, be, v, u, a, c, d = self.params
        if raw:
            x = (x - self.mean) / self.spread
        h = np.tanh(x @ we + be)
        tv, su = np.tanh(h @ v), 1 / (1 + np.exp(-np.clip(h @ u, -30, 30)))
        logit = np.clip((tv * su) @ a, -30, 30)
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        top = np.repeat(np.maximum.reduceat(logit, starts), sizes)
        e = np.exp(logit - top)
        att = e / np.repeat(np.add.reduceat(e, starts), sizes)
        z = np.add.reduceat(att[:, None] * h, starts)
        return 1 / (1 + np.exp(-np.clip(z @ c + d[0], -30, 30))), (x, h, tv, su, att, z, starts)

    def scores(self, x: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        return self.forward(x, sizes)[0]


def fit(x: np.ndarray, sizes: np.ndarray, y: np.ndarray, weight: np.ndarray, steps: int = STEPS) -> Model:
    mean, spread = x.mean(axis=0), x.std(axis=0) + 1e-3
    rng = np.random.default_rng(7)
    shapes = [(SIZE, ENCODED), (ENCODED,), (ENCODED, GATE), (ENCODED, GATE), (GATE,), (ENCODED,), (1,)]
    params = [rng.normal(0, 0.3 if len(s) > 1 else 0.1, s) for s in shapes]
    model = Model(mean, spread, params)
    xs = ((x - mean) / spread).astype("f4")
    weight = weight / weight.sum()

    def gradients(params):
        model.params = params
        we, be, v, u, a, c, d = params
        s, (_, h, tv, su, att, z, starts) = model.forward(xs, sizes, raw=False)
        ds = weight * (s - y)
        dz = ds[:, None] * c[None, :]
        dzp = np.repeat(dz, sizes, axis=0)
        datt = (dzp * h).sum(axis=1)
        mean_att = np.repeat(np.add.reduceat(att * datt, starts), sizes)
        dlogit = att * (datt - mean_att)
        dt, dg = dlogit[:, None] * su * a * (1 - tv ** 2), dlogit[:, None] * tv * a * su * (1 - su)
        dh = att[:, None] * dzp + dt @ v.T + dg @ u.T
        dx = dh * (1 - h ** 2)
        decay = 1e-4
        return [xs.T @ dx + decay * we, dx.sum(axis=0), h.T @ dt + decay * v, h.T @ dg + decay * u,
                (tv * su).T @ dlogit + decay * a, z.T @ ds + decay * c, np.array([ds.sum()])]

    model.params = adam(params, gradients, steps, 0.03)
    return model


def _slices(texts: list):
    at = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t or "") > SLICE:
            yield at, i
            at, size = i, 0
        size += len(t or "")
    yield at, len(texts)


def _sample_rows(batches):
    for b in batches:
        texts = b.column("text").to_pylist()
        for lo, hi in _slices(texts):
            if lo == hi:
                continue
            x, sizes = _flat(texts[lo:hi])
            bounds = np.concatenate([[0], np.cumsum(sizes)]) * SIZE
            flat = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([b.column(c).slice(lo, hi - lo) for c in ("doc_id", "y", "weight")] + [flat],
                                             names=["doc_id", "y", "weight", "x"])


def _predict(shared):
    def run(batches):
        model: Model | None = shared.value
        for b in batches:
            texts = b.column("text").to_pylist()
            out = np.full(len(texts), 0.5)
            if model:
                for lo, hi in _slices(texts):
                    if lo < hi:
                        out[lo:hi] = model.scores(*_flat(texts[lo:hi]))
            keep = [c for c in b.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([b.column(c) for c in keep] + [pa.array(out), pa.array((out >= 0.5).astype("i4"))],
                                             names=keep + ["score", "predicted"])
    return run


def is_held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(documents: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model | None:
    """From labels of documents that are not held out."""
    sample = labelled_sample(documents, labels, "quality", per_class, ~is_held_out())
    rows = stored(sample.select("doc_id", "y", "weight", "text").mapInArrow(
        _sample_rows, "doc_id long, y int, weight double, x array<float>"), "quality-sample")
    got = rows.orderBy("doc_id").toPandas()  # at most about 2 x per_class documents
    y = got["y"].to_numpy()
    if len(set(y.tolist())) < 2:
        return None
    sizes = np.array([len(v) // SIZE for v in got["x"]], "i8")
    x = np.concatenate(list(got["x"])).reshape(-1, SIZE)
    weight = got["weight"].to_numpy()
    return fit(x, sizes, y, np.sqrt(weight / weight.min()))


def score_documents(documents: DataFrame, model: Model | None) -> DataFrame:
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), is_held_out().alias("held_out"), F.col("text").cast("string").alias("text"))
    shared = documents.sparkSession.sparkContext.broadcast(model)
    return docs.mapInArrow(_predict(shared), "doc_id long, held_out boolean, score double, predicted int")


def quality(documents: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    return score_documents(documents, train(documents, labels, per_class))
