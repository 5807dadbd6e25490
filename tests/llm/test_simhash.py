"""SimHash groups against a pairwise search with union-find."""

import random

import numpy as np
import pytest
import xxhash

from cohortium.llm import simhash_wildcards as S

from .frames import SF, awkward, documents, empty


def naive_simhash(text):
    words = [w for w in (text or "").encode().translate(S.LOWER).replace(b"\x0b", b" ").replace(b"\x0c", b" ").split() if w]
    if not words:
        return 0
    k = min(3, len(words))
    grams = [b" ".join(words[i:i + k]) for i in range(len(words) - k + 1)]
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def naive_groups(docs):
    fp = [naive_simhash(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if bin(fp[i] ^ fp[j]).count("1") <= 2:
                root[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            low[find(i)] = min(d, low.get(find(i), d))
    return sorted(((d, f"{fp[i]:016x}", low.get(find(i))) for i, (d, _) in enumerate(docs)), key=repr)


def result(df):
    return sorted(((r.doc_id, r.fingerprint, r.component_id) for r in S.near_duplicates(df).collect()), key=repr)


def test_table_equals_pairwise(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert result(docs) == naive_groups([(r.doc_id, r.text) for r in docs.collect()])


def test_awkward_rows_and_columns(spark):
    docs = awkward(spark)
    assert result(docs) == naive_groups([(r.doc_id, r.text) for r in docs.collect()])
    assert S.near_duplicates(empty(spark)).count() == 0


@pytest.mark.parametrize("bucket", [2, 1024])
def test_links_near_one_centre(spark, bucket):
    """Many fingerprints around one value, in chains, with both ways of dealing with a bucket."""
    rnd = random.Random(3)
    fps = set()
    for base in (0x0123456789ABCDEF, 0xFFFFFFFF00000000):
        for _ in range(120):
            x = base
            for _ in range(rnd.randint(0, 4)):
                x ^= 1 << rnd.randrange(64)
            fps.add(x)
    fps |= {rnd.getrandbits(64) for _ in range(50)}
    signed = [int(np.uint64(x).astype("i8")) for x in fps]
    links = S.fingerprint_links(spark.createDataFrame([(x,) for x in signed], "fp long"), bucket=bucket)
    pairs = {(r.a, r.b) for r in links.collect()}
    assert all(bin((a ^ b) & (1 << 64) - 1).count("1") <= 2 for a, b in pairs) or bucket > 2
    got = {r.node: r.root for r in S.connected_components(links).collect()}
    root = {x: x for x in signed}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, x in enumerate(signed):
        for y in signed[:i]:
            if bin((x ^ y) & (1 << 64) - 1).count("1") <= 2:
                a, b = find(x), find(y)
                root[max(a, b)] = min(a, b)
    assert {x: got.get(x, x) for x in signed} == {x: find(x) for x in signed}


def test_one_row_of_a_group_stays(spark):
    docs = documents(spark, ["alpha beta gamma delta"] * 3 + ["one two three four five six"])
    docs = docs.unionByName(docs.where("doc_id = 0")).unionByName(
        spark.createDataFrame([(None, "alpha beta gamma delta", "en", "s", 1, 1, "x")], docs.schema))
    kept = S.keep_one_per_group(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [0, 3, None]
    assert S.keep_one_per_group(empty(spark)).count() == 0


def test_components_of_a_long_chain(spark):
    n = 300
    links = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(1000, 1001), (5, 5), (None, 3)], "a long, b long")
    got = {r.node: r.root for r in S.connected_components(links).collect()}
    assert got == {**{i: 0 for i in range(n + 1)}, 1000: 1000, 1001: 1000}


def test_one_id_with_two_texts_and_clashing_columns(spark):
    from pyspark.sql import functions as F

    from .test_lines import CLASH

    texts = [(1, "a quick brown fox jumps over it"), (5, "a quick brown fox jumps over it"), (5, "another text of its own here"), (7, "another text of its own here"),
             (8, None), (None, "a quick brown fox jumps over it"), (9, "third one entirely different words"), (9, "third one entirely different words")]
    df = spark.createDataFrame(texts, "doc_id long, text string").withColumn("extra", F.monotonically_increasing_id() % 2)
    df = df.withColumns({c: F.concat(F.lit(c), F.coalesce(F.col("doc_id").cast("string"), F.lit("?"))) for c in CLASH})
    got = S.keep_one_per_group(df)
    rows = got.collect()
    assert got.columns == df.columns
    assert sorted(((r.doc_id, r.text) for r in rows), key=repr) == sorted([texts[0], texts[2], texts[4], texts[5], texts[6]], key=repr)
    assert all(r[c] == f"{c}{'?' if r.doc_id is None else r.doc_id}" for r in rows for c in CLASH)
