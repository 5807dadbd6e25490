"""Decontamination against a search for every window of every item."""

import random
import re

import pytest
from pyspark.sql import functions as F

from cohortium.llm import winnowing as W

from .frames import awkward, documents, empty

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall((t or "").translate(str.maketrans(W.UPPER, W.LOWER)))


def naive(docs, items):
    out = []
    for d, t in docs:
        w = words(t)
        hit, found = set(), set()
        for i, it in items:
            iw = words(it)
            k = min(10, len(iw))
            if i is None or not k:
                continue
            grams = {tuple(iw[a:a + k]) for a in range(len(iw) - k + 1)}
            for a in range(len(w) - k + 1):
                if tuple(w[a:a + k]) in grams:
                    hit |= set(range(a, a + k))
                    found.add(str(i))
        out.append((d, len(w), len(hit), sorted(found)))
    return sorted(out, key=repr)


def result(docs, bench):
    got = W.contamination(docs, bench).collect()
    assert all(r.contaminated == (r.n_hit > 0) for r in got)
    return sorted(((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in got), key=repr)


ITEM = "item_id long, text string, words int"


def bench(spark, items):
    return spark.createDataFrame([(i, t, 1) for i, t in items], ITEM)


def cases():
    rnd = random.Random(4)
    vocabulary = ["ab", "É", "é", "x1", "漢", "k", "K", "the", "the"]
    items = [(i, " ".join(rnd.choice(vocabulary) for _ in range(n))) for i, n in enumerate([1, 3, 9, 10, 11, 30, 60])]
    items += [(7, None), (8, ""), (9, "..."), (None, "ab the x1"), (3, items[3][1]), (10, items[5][1]), (11, "same " * 25)]
    texts = []
    for _ in range(40):
        t = [rnd.choice(vocabulary) for _ in range(rnd.randint(0, 80))]
        for _ in range(rnd.randint(0, 2)):
            iw = (rnd.choice(items)[1] or "").split()
            a = rnd.randint(0, len(iw))
            t[rnd.randint(0, len(t)):0] = iw[a:a + rnd.randint(5, 40)]
        texts.append(rnd.choice([" ", ", ", "\n"]).join(t))
    return items, texts + [("same " * 40).upper(), None, "K" * 5, "K " * 12]


@pytest.mark.parametrize("limit", [W.BROADCAST_ROWS, 0])
def test_equals_window_search(spark, limit, monkeypatch):
    """With the benchmark broadcast, and with the shuffled join beyond the bound."""
    monkeypatch.setattr(W, "BROADCAST_ROWS", limit)
    items, texts = cases()
    assert result(documents(spark, texts), bench(spark, items)) == naive(list(enumerate(texts)), items)


def test_chunks_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(W, "CHUNK", 7)
    items, texts = cases()
    assert result(documents(spark, texts), bench(spark, items)) == naive(list(enumerate(texts)), items)


def test_awkward_rows(spark):
    docs = awkward(spark)
    items = [(1, "same text here again"), (2, "ab " * 15)]
    assert result(docs, bench(spark, items)) == naive([(r.doc_id, r.text) for r in docs.collect()], items)
    assert W.contamination(empty(spark), bench(spark, items)).count() == 0
    assert W.contamination(docs, bench(spark, [])).where("contaminated").count() == 0


def test_clean_documents_stay(spark):
    docs = awkward(spark)
    kept = W.drop_contaminated(docs, bench(spark, [(1, "same text here again")]))
    assert kept.columns == docs.columns
    assert kept.count() == docs.where(~F.coalesce(F.col("text") == "same text here again", F.lit(False))).count()


def test_main_path_is_native(spark):
    items, texts = cases()
    plan = W.contamination(documents(spark, texts), bench(spark, items))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


@pytest.mark.parametrize("period", [2, 3])
def test_periodic_ends(spark, period):
    """A new minimum in the last gram that equals the gram a period earlier is kept."""
    items = []
    for i in range(60):
        head, own = [f"z{i}", f"y{i}", f"x{i}"][:4 - period % 2 - 1], [f"{c}{i}" for c in "abc"[:period]]
        items.append((i, " ".join([*head, *(own * 10)[:10 - len(head)]])))
    texts = [f"before {t}" for _, t in items]
    assert result(documents(spark, texts), bench(spark, items)) == naive(list(enumerate(texts)), items)


def test_a_gram_is_kept_once(spark):
    rnd = random.Random(9)
    text = " ".join(f"w{rnd.randint(0, 10 ** 6)}" for _ in range(2000))
    rows = W.winnow(documents(spark, [text]), ["doc_id"]).collect()
    assert len(rows) == len({r.pos for r in rows}) < 2000 / 2


def test_letters_whose_lower_case_depends_on_neighbours(spark):
    """A capital sigma at a word's end: the contract's words are equal, whatever stands behind them."""
    eleven = " ".join(f"w{i}" for i in range(9)) + " ΟΔΟΣ ΑΒ"
    docs = documents(spark, ["ΟΔΟΣ.Α τεστ", "x " + eleven.replace("ΟΔΟΣ ΑΒ", "ΟΔΟΣ.ΑΒ") + " y", "οδος"])
    items = spark.createDataFrame([(1, "ΟΔΟΣ"), (2, eleven)], "item_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_hit, list(r["items"])) for r in W.contamination(docs, items).collect()}
    assert got == {0: (3, 1, ["1"]), 1: (13, 11, ["1", "2"]), 2: (1, 0, [])}


def test_periodic_texts_and_block_edges(spark, monkeypatch):
    """Alignments in every block of a text, items that reach over a block's end."""
    monkeypatch.setattr(W, "BLOCK", 16)
    item = "same " * 25
    other = " ".join(f"u{i}" for i in range(40))
    docs = documents(spark, ["same " * 300, "q " * 13 + other + " r" * 13, other, "same " * 9, "q " * 16 + "same " * 10])
    items = spark.createDataFrame([(1, item), (2, other)], "item_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_hit, list(r["items"])) for r in W.contamination(docs, items).collect()}
    assert got == {0: (300, 300, ["1"]), 1: (66, 40, ["2"]), 2: (40, 40, ["2"]), 3: (9, 0, []), 4: (26, 10, ["1"])}


def test_clashing_columns_are_kept(spark):
    from pyspark.sql import functions as F

    from .test_lines import CLASH

    item = " ".join(f"u{i}" for i in range(12))
    df = documents(spark, [item, "own words only", None]).withColumns({c: F.concat(F.lit(c), F.col("doc_id").cast("string")) for c in CLASH})
    got = W.drop_contaminated(df, spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert got.columns == df.columns
    rows = {r.doc_id: r for r in got.collect()}
    assert set(rows) == {1, 2} and all(rows[i][c] == f"{c}{i}" for i in rows for c in CLASH)
