"""Importance resampling against counts, logarithms and sums in plain Python."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from cohortium.llm import bit_planes as B

from .frames import SF, awkward, documents, empty

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text):
    w = WORD.findall((text or "").translate(FOLD))
    return len(w), Counter(zlib.crc32(f.encode()) % 10_000 for f in w + [f"{a} {b}" for a, b in zip(w, w[1:])])


def plain_way(docs, target):
    each = [(i, *features(t)) for i, t in docs]
    s, t = Counter(), Counter()
    for _, _, c in each:
        s.update(c)
    for text in target:
        t.update(features(text)[1])
    total_s, total_t = sum(s.values()), sum(t.values())
    rows = []
    for i, n, c in each:
        size = sum(c.values())
        gains = sum(k * math.floor(1000 * math.log((t[b] + 1) * (total_s + 10_000) / ((s[b] + 1) * (total_t + 10_000)))) for b, k in c.items())
        weight = gains // size if size else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, n, size, weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    able = sorted((r for r in rows if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0]))
    rank = {id(r): k + 1 for k, r in enumerate(able[:25 * len(able) // 100])}
    return sorted(((*r[:1], *r[2:], rank.get(id(r))) for r in rows), key=repr)


def result(docs, target):
    got = B.importance(docs, target).collect()
    return sorted(((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in got), key=repr)


def test_table_equals_plain_sums(spark):
    docs, target = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    want = plain_way([(r.doc_id, r.text) for r in docs.collect()], [r.text for r in target.collect()])
    assert result(docs, target) == want and any(r[4] for r in want) and {r[2] < 0 for r in want} == {True, False}


def test_awkward_rows(spark):
    target = spark.read.parquet(f"{SF}/benchmark.parquet").unionByName(spark.createDataFrame([(None, None)], "item_id long, text string"))
    docs = awkward(spark).withColumns({c: F.lit(3) for c in ("th", "rank", "score", "weight", "all", "nth", "n_words")})
    assert result(docs, target) == plain_way([(r.doc_id, r.text) for r in docs.collect()], [r.text for r in target.collect()])
    assert B.importance(empty(spark), target).count() == 0
    assert result(docs, target.limit(0)) == plain_way([(r.doc_id, r.text) for r in docs.collect()], [])


def test_equal_scores_go_by_id(spark):
    docs = documents(spark, ["one two " * 15] * 40)
    target = spark.createDataFrame([(1, "one two")], "item_id long, text string")
    got = {r.doc_id: (r.score, r["rank"]) for r in B.importance(docs.unionByName(docs), target).collect()}
    assert sum(r is not None for _, r in got.values()) >= 10
    drawn = [r["rank"] for r in B.importance(docs.unionByName(docs), target).collect() if r["rank"]]
    assert sorted(drawn) == list(range(1, 21))


def test_bit_planes_sum_exactly():
    rng = np.random.default_rng(5)
    gains = rng.integers(-9000, 9000, 10_000)
    sliced = B.Gains(gains)
    for high in (2, 100, 1 << 40):
        counts = rng.integers(0, high, 10_000) * (rng.random(10_000) < 0.1)
        assert sliced.total(counts) == sum(int(c) * int(g) for c, g in zip(counts, gains))
    assert B.Gains(np.zeros(10_000)).total(counts) == 0 and sliced.total(np.zeros(10_000, "i8")) == 0


def test_drawn_documents_keep_their_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumns({c: F.lit("x") for c in ("th", "row", "drawn")})
    target = spark.read.parquet(f"{SF}/benchmark.parquet")
    got = B.resample(docs, target)
    want = {r.doc_id for r in B.importance(docs, target).collect() if r["rank"]}
    assert got.columns == docs.columns and {r.doc_id for r in got.collect()} == want and want
    assert got.exceptAll(docs).count() == 0
