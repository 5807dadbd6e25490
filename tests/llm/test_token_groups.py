"""Jaccard components against a comparison of all pairs of sets."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortium.llm import token_groups as T

from .frames import SF, awkward, documents, empty

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(FOLD))
    return frozenset(" ".join(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def plain_way(docs):
    """All pairs of different sets that share anything, joined by union-find."""
    sets = {}
    for i, t in docs:
        sets.setdefault(shingles(t), []).append(i)
    names = [s for s in sets if s]
    root = list(range(len(names)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    by_token = {}
    for i, s in enumerate(names):
        for t in s:
            by_token.setdefault(t, []).append(i)
    for i, s in enumerate(names):
        near = {j for t in s for j in by_token[t] if j < i}
        for j in near:
            both = len(s & names[j])
            if 100 * both >= 80 * (len(s) + len(names[j]) - both):
                root[find(i)] = find(j)
    low = {}
    for i, s in enumerate(names):
        ids = [d for d in sets[s] if d is not None]
        if ids:
            low[find(i)] = min(ids + ([low[find(i)]] if find(i) in low else []))
    comp = {s: low.get(find(i)) for i, s in enumerate(names)}
    return sorted(((d, len(shingles(t)), comp[shingles(t)] if shingles(t) else d) for d, t in docs), key=repr)


def check(df, **options):
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in T.jaccard_components(df, **options).collect()), key=repr)
    want = plain_way([(r.doc_id, r.text) for r in df.collect()])
    assert got == want
    return got


def test_table_equals_all_pairs(spark):
    got = check(spark.read.parquet(f"{SF}/documents.parquet"))
    assert sum(d != c for d, _, c in got) > 5


def test_awkward_rows_and_columns(spark):
    df = awkward(spark).withColumns({c: F.lit("x") for c in ("n", "sid", "th", "doc", "token", "grp", "comp", "n_shingles", "component_id")})
    check(df)
    assert T.jaccard_components(empty(spark)).count() == 0


def edited(rnd, words, share):
    out = list(words)
    for _ in range(round(share * len(out))):
        out[rnd.randrange(len(out))] = f"w{rnd.randrange(10 ** 6)}"
    return " ".join(out)


@pytest.mark.parametrize("group, queries", [(3, 2), (128, 2000)])
def test_families_of_near_copies(spark, monkeypatch, group, queries):
    """Chains, families round one text, a passage that most texts hold, small sets at the limit."""
    monkeypatch.setattr(T, "GROUP", group)
    monkeypatch.setattr(T, "QUERIES", queries)
    rnd = random.Random(7)
    words = [f"v{i}" for i in range(400)]
    passage = [rnd.choice(words) for _ in range(60)]
    texts = []
    for _ in range(4):
        base = [rnd.choice(words) for _ in range(rnd.choice([40, 150, 300]))]
        texts += [edited(rnd, base, s) for s in (0, 0, 0.005, 0.01, 0.01, 0.02, 0.02, 0.03, 0.05, 0.1)]
        step = base
        for _ in range(8):
            step = edited(rnd, step, 0.015).split()
            texts.append(" ".join(step))
    for _ in range(40):
        own = [f"o{rnd.randrange(10 ** 6)}" for _ in range(rnd.choice([2, 8, 15, 40]))]
        texts.append(" ".join(passage + own))
    texts += ["a b c d", "a b c d e", "a b c d e f g h", "a b c d e f g h i", "a b c d e f g h i j", "A b C d", "x"]
    rnd.shuffle(texts)
    got = check(documents(spark, texts))
    assert len({c for *_, c in got}) < len(texts) - 40


def test_order_of_tokens_changes_nothing(spark, monkeypatch):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    want = check(df)
    rng = np.random.default_rng(2)
    monkeypatch.setattr(T, "token_levels", lambda *_: rng.integers(0, 9, T.MIN_SLOTS).astype("u1"))
    assert check(df) == want


def test_prefixes_of_linked_sets_meet():
    """For every pair of sizes that can link, the fewest common tokens are too many to miss both prefixes."""
    for big in range(1, 120):
        for small in range(1, big + 1):
            for both in range(small + 1):
                if 100 * both >= 80 * (big + small - both):
                    assert T.query_prefix(big) >= big - both + 1
                    assert small - (160 * small + 179) // 180 + 1 >= small - both + 1


def test_group_bound_is_never_too_low():
    rnd = np.random.default_rng(0)
    for _ in range(200):
        members = [(i, i, np.unique(rnd.integers(0, 60, rnd.integers(1, 40)))) for i in range(6)]
        q = np.unique(rnd.integers(0, 60, rnd.integers(1, 40)))
        want = [i for i, _, m in members if 100 * len(np.intersect1d(m, q)) >= 80 * len(np.union1d(m, q))]
        assert T.Group(members, 80).linked(q).tolist() == want
