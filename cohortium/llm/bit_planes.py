"""Importance resampling towards a target, with weights summed over bit planes.

Words and pairs of words of a text are counted in ``BUCKETS`` hash buckets. A bucket's
gain is how much likelier the target holds it than the corpus does (a floored, scaled
logarithm, so an integer); a document's weight is the mean gain of its features.

The sum behind that mean is bit-sliced. A document's bucket counts become planes of
``BUCKETS`` bits: bit b of plane k is bit k of bucket b's count. The gains become planes
as well, of the magnitudes of the positive and of the negative ones. Every pair of planes
is ANDed, the ones are counted, and the counts, times the planes' powers of two, add up
to the exact integer sum, whatever the counts are.

Corpus and target counts cover every text: a task hands on one row per bucket, Spark
sums them, and the ``BUCKETS`` gains are computed on the driver and broadcast. The draw
adds Gumbel noise from a hash of the id and takes the best scores; ranks come from range
partitions, so no task sees all documents.

Edge cases: NULL and wordless texts have no features, weight 0, and are not drawn (they
have too few words); a NULL ``doc_id`` hashes as if written with no digits and comes last
among equal scores; repeated rows each get their row, and of equal rows each its own
rank; without documents there are no rows, and without target texts the gains compare
with an even spread; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortium.llm.common import doc_texts, stored
from cohortium.operators.ordinals import Key, within_group_ordinals

BUCKETS = 10_000
SCALE = 1000
SEED = 7
LEAST_WORDS = 20
PERCENT = 25
KNOWN_WORDS = 200_000
#: A-Z to a-z; every other byte below 128 that is no digit or small letter breaks words
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8").translate(FOLD).split()


class WordSums(dict):
    """CRC-32 of a word, and of the word and a space; forgotten when too many are held."""

    def __missing__(self, word: bytes) -> tuple[int, int]:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        crc = zlib.crc32(word)
        self[word] = got = crc, zlib.crc32(b" ", crc)
        return got


def bucket_counts(ws: list[bytes], known: WordSums, buckets: int) -> np.ndarray:
    """Counts of single words and of neighbours joined by a space, per bucket."""
    sums = [known[w] for w in ws]
    crc = zlib.crc32
    pairs = [crc(w, before) for (_, before), w in zip(sums, ws[1:])]
    slots = np.fromiter((s for s, _ in sums), "i8", len(sums))
    return np.bincount(np.concatenate([slots, np.array(pairs, "i8")]) % buckets, minlength=buckets)


def planes(values: np.ndarray, width: int | None = None) -> np.ndarray:
    """Bit planes of non-negative integers, lowest first, as rows of 64-bit words."""
    width = width if width is not None else int(values.max(initial=0)).bit_length()
    size = -(-len(values) // 64) * 64
    bits = np.zeros((width, size), "u1")
    bits[:, :len(values)] = values[None, :] >> np.arange(width)[:, None] & 1
    return np.packbits(bits, axis=1).view("u8")


class Gains:
    """Signed gains as bit planes: magnitudes of the positive and of the negative ones."""

    def __init__(self, gains: np.ndarray):
        gains = gains.astype("i8")
        width = max(1, int(np.abs(gains).max(initial=0)).bit_length())
        self.planes = np.concatenate([planes(np.maximum(gains, 0), width), planes(np.maximum(-gains, 0), width)])
        power = [1 << j for j in range(width)]
        self.value = power + [-p for p in power]

    def total(self, counts: np.ndarray) -> int:
        """Sum of count times gain over all buckets, exactly."""
        out = 0
        for k, plane in enumerate(planes(counts)):
            ones = np.bitwise_count(self.planes & plane).sum(axis=1, dtype="i8").tolist()
            out += sum(n * v for n, v in zip(ones, self.value)) << k
        return out


def gain(t: int, total_t: int, s: int, total_s: int, buckets: int = BUCKETS, scale: int = SCALE) -> int:
    return math.floor(scale * math.log((t + 1.0) * (total_s + buckets) / ((s + 1.0) * (total_t + buckets))))


def noise(doc_id: int | None, seed: int = SEED, scale: int = SCALE) -> int:
    """Floored, scaled Gumbel noise of a document."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-scale * math.log(-math.log((h + 0.5) / 4294967296)))


def _count(buckets: int):
    def run(batches):
        known, sums = WordSums(), np.zeros(buckets, "i8")
        for b in batches:
            for text in b.column("text").to_pylist():
                ws = words(text)
                if ws:
                    sums += bucket_counts(ws, known, buckets)
        held = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(held.astype("i4")), pa.array(sums[held])], names=["bucket", "n"])
    return run


def corpus_counts(texts: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Feature counts per bucket over all texts: at most ``buckets`` rows a task, and to the driver."""
    each = texts.select(F.col("text").cast("string").alias("text")).mapInArrow(_count(buckets), "bucket int, n long")
    got = each.groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(buckets, "i8")
    out[got["bucket"].to_numpy()] = got["n"].to_numpy()
    return out


def learn_gains(documents: DataFrame, target: DataFrame, buckets: int = BUCKETS, scale: int = SCALE) -> np.ndarray:
    s, t = corpus_counts(documents, buckets).tolist(), corpus_counts(target, buckets).tolist()
    total_s, total_t = sum(s), sum(t)
    return np.array([gain(b, total_t, a, total_s, buckets, scale) for a, b in zip(s, t)], "i8")


def _weigh(shared, seed: int, scale: int):
    def run(batches):
        gains = shared.value
        known, sliced = WordSums(), Gains(gains)
        for b in batches:
            n_words, n_features, weight = [], [], []
            for text in b.column("text").to_pylist():
                ws = words(text)
                n = max(0, 2 * len(ws) - 1)
                n_words.append(len(ws))
                n_features.append(n)
                weight.append(sliced.total(bucket_counts(ws, known, len(gains))) // n if n else 0)
            score = [w + noise(i, seed, scale) for w, i in zip(weight, b.column("doc_id").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("th"), *(pa.array(c, pa.int64()) for c in (n_words, n_features, weight, score))],
                names=["doc_id", "th", "n_words", "n_features", "weight", "score"])
    return run


def importance(documents: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS,
               buckets: int = BUCKETS, scale: int = SCALE, seed: int = SEED) -> DataFrame:
    """``doc_id, th, n_words, n_features, weight, score, rank`` of every document (``th`` is
    its text's hash); ``rank`` numbers the drawn ones from 1, NULL for the others."""
    spark = documents.sparkSession
    shared = spark.sparkContext.broadcast(learn_gains(documents, target, buckets, scale))
    docs = doc_texts(documents).select("doc_id", F.xxhash64("text").alias("th"), "text")
    each = stored(docs.mapInArrow(_weigh(shared, seed, scale), "doc_id long, th long, n_words long, n_features long, weight long, score long"), "weights")
    able = each.where(F.col("n_words") >= least_words)
    drawn = percent * able.count() // 100
    numbered = within_group_ordinals(able.withColumn("all", F.lit(0)), ["all"], [Key("score", ascending=False)],
                                     [Key("doc_id", nulls_first=False), Key("th")], rn_col="nth", rank_col=None)
    ranked = numbered.select(*each.columns, F.when(F.col("nth") <= drawn, F.col("nth")).alias("rank"))
    few = each.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(few)


def resample(documents: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The drawn documents, all their columns kept."""
    drawn = importance(documents, target, **options).where("rank IS NOT NULL").select(F.struct("doc_id", "th").alias("drawn")).distinct()
    given = documents.select(F.struct(*(F.col(f"`{c}`") for c in documents.columns)).alias("row"))
    key = F.struct(F.col("row.doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("row.text").cast("string")).alias("th"))
    kept = given.join(drawn, key.eqNullSafe(F.col("drawn")), "left_semi")
    return kept.select("row.*")
