"""Line deduplication: patience alignment and its effect on texts."""

import random

from cohortium.llm import line_alignment as L

from .frames import awkward, documents, empty


def line(k, words=8):
    return " ".join(f"word{k}x{i}" for i in range(words))


def test_alignment_is_a_common_subsequence():
    rnd = random.Random(11)
    for _ in range(300):
        a = [(i, rnd.randint(0, 6)) for i in range(rnd.randint(0, 12))]
        b = [(i, rnd.randint(0, 6)) for i in range(rnd.randint(0, 12))]
        got = L.patience(a, b)
        ha, hb = dict(a), dict(b)
        assert all(ha[i] == hb[j] for i, j in got)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(got, got[1:]))


def test_unique_lines_anchor_the_alignment():
    a = list(enumerate([1, 9, 2, 9, 3]))
    b = list(enumerate([9, 1, 2, 3, 9]))
    assert [(0, 1), (2, 2), (4, 3)] == L.patience(a, b)
    same = list(enumerate([5, 5, 7, 5]))
    assert L.patience(same, same) == [(i, i) for i in range(4)]


def test_blocks_of_later_documents_go(spark):
    block = [line(k) for k in range(3)]
    texts = ["\n".join([line(10), *block, line(11)]), "\n".join([*block, "short", line(12)]), "\n".join([line(13), "short"]),
             "\n".join([line(10), *block, line(11)]), line(12) + "\n" + line(14), "tiny\nline"]
    got = {r.doc_id: r for r in L.dedupe_lines(documents(spark, texts)).collect()}
    assert [got[i].text for i in range(6)] == [texts[0], "short\n" + line(12), texts[2], "", line(14), texts[5]]
    assert got[1]._removed == [0, 1, 2] and got[1]._partners == [0] and got[4]._partners == [1] and got[0]._removed == []


def test_moved_and_repeated_blocks_go(spark):
    a, b, c = (line(k) for k in range(3))
    texts = ["\n".join([a, b, c]), "\n".join([c, line(9), a, b, a, b] + [c] * 20)]
    got = {r.doc_id: r for r in L.dedupe_lines(documents(spark, texts)).collect()}
    assert got[1].text == line(9) and got[0].text == texts[0]


def test_every_holder_but_the_first_loses_a_common_line(spark):
    """No cap on frequency: a line of all documents goes from all but one."""
    texts = [f"{line(0)}\n{line(100 + i)}" for i in range(300)]
    got = L.dedupe_lines(documents(spark, texts))
    assert got.where("size(_removed) = 1").count() == 299
    assert {r.text for r in got.where("doc_id > 0").collect()} == {line(100 + i) for i in range(1, 300)}


def test_awkward_rows(spark):
    df = awkward(spark)
    out = L.dedupe_lines(df)
    assert out.columns == [*df.columns, "_removed", "_partners"] and out.count() == df.count()
    long = {r.doc_id: r.text for r in out.collect() if r.doc_id is not None}
    before = {r.doc_id: r.text for r in df.collect() if r.doc_id is not None}
    assert long == before  # nothing of a line's length repeats here
    assert L.dedupe_lines(empty(spark)).count() == 0


def test_ids_missing_or_repeated(spark):
    t = line(1) + "\n" + line(2)
    rows = [(None, t), (1, t), (1, t), (2, t), (None, t)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.text) for r in L.dedupe_lines(df).collect()), key=repr)
    assert got == sorted([(None, t), (None, t), (1, t), (1, t), (2, "")], key=repr)


def test_short_lines_go_with_their_block(spark):
    """An exact copy loses every line, and a passage needs no long line to be found."""
    verse = [f"verse {k} is so short" for k in range(6)]
    code = ["def f(x):", "    y = x", "", "    return y + 100", "}", "漢字の行", "漢字の別の行", "後の行です"]
    copy = "\n".join(["", line(1), "short", "", line(2), "end", ""])
    texts = ["\n".join([line(10), *verse, line(11)]), "\n".join(["own words", *verse, "others"]), copy, copy,
             "\n".join([line(12), *code]), "\n".join([*code, line(13)]), "tiny\nline", "tiny\nline"]
    got = {r.doc_id: r for r in L.dedupe_lines(documents(spark, texts)).collect()}
    assert [got[i].text for i in range(8)] == [texts[0], "own words\nothers", copy, "", texts[4], line(13), texts[6], texts[7]]
    assert got[1]._partners == [0] and got[3]._removed == list(range(7))


def naive_lines(texts, least):
    """Lines, by document, that lie in a run of ``least`` characters of an earlier one; blank lines left out."""
    out, seen = [], set()
    for t in texts:
        own = [x.strip(" ") for x in t.split("\n") if x.strip(" ")]
        runs = [(a, b) for a in range(len(own)) for b in range(a + 1, len(own) + 1) if sum(map(len, own[a:b])) >= least]
        gone = {i for a, b in runs if tuple(own[a:b]) in seen for i in range(a, b)}
        out.append([x for i, x in enumerate(own) if i not in gone])
        seen |= {tuple(own[a:b]) for a, b in runs}
    return out


def test_equals_search_for_every_run(spark):
    rnd = random.Random(8)
    words = ["", " ", "x", "yy" * 4, "漢字" * 6, "z" * 19, "long" * 7, "longer" * 8, *(f"line {i}" * 3 for i in range(5))]
    texts = ["\n".join(rnd.choice(words) for _ in range(rnd.randint(0, 14))) for _ in range(120)]
    texts += [texts[7], "\n" + texts[9], "x\n" * 50, "x\n" * 70]
    got = {r.doc_id: r for r in L.dedupe_lines(documents(spark, texts)).collect()}
    for i, want in enumerate(naive_lines(texts, L.BLOCK_CHARS)):
        assert [x.strip(" ") for x in got[i].text.split("\n") if x.strip(" ")] == want, i
        lines = texts[i].split("\n")
        assert got[i].text == "\n".join(x for k, x in enumerate(lines) if k not in set(got[i]._removed))
        assert want or not got[i]._removed or got[i].text == ""


def test_a_line_found_earlier_alone_does_not_split_a_block(spark):
    """Each of the lines is too short for a block by itself; their block has a partner in common."""
    a, b = line(1, 4), line(2, 4)
    assert 25 <= len(a) < L.BLOCK_CHARS and 25 <= len(b) < L.BLOCK_CHARS
    texts = ["\n".join([line(10), a, line(11)]), "\n".join([line(12), a, b, line(13)]), "\n".join([line(14), a, b, line(15)])]
    got = {r.doc_id: r for r in L.dedupe_lines(documents(spark, texts)).collect()}
    assert [got[i].text for i in range(3)] == [texts[0], texts[1], line(14) + "\n" + line(15)]
    assert got[2]._partners == [1]


def test_nothing_goes_without_the_alignment(spark, monkeypatch):
    """The lines cut are those that patience aligns: without it no text changes."""
    docs = [[(i, rnd_h) for i, rnd_h in enumerate(hs)] for hs in ([1, 2, 3, 1], [3, 1, 2, 9, 1])]
    found = {a for aligned in L._stretches(docs[1], docs[0]) for a, _ in aligned}
    assert found == {0, 1, 2, 4}
    monkeypatch.setattr(L, "patience", lambda later, earlier: [])
    assert not list(L._stretches(docs[1], docs[0]))
    match = {"p_doc": 0, "p_th": 0, "h": 1, "at": [0], "after": [-1], "lead": True, "p_at": [0]}
    assert L._doomed([match]) == ([], [])


def test_repeats_are_aligned_in_few_steps():
    """Every common run is aligned, with alignments whose sizes add up to little more than linear."""
    rnd = random.Random(2)
    for _ in range(100):
        earlier = [(i, rnd.randint(0, 9)) for i in range(rnd.randint(1, 12))]
        later = [(i, rnd.randint(0, 12)) for i in range(rnd.randint(1, 40))]
        held = {h for _, h in earlier}
        assert {a for al in L._stretches(later, earlier) for a, _ in al} == {a for a, h in later if h in held}
    work = []
    real = L.patience

    def counted(a, b):
        work.append(len(a) + len(b))
        return real(a, b)

    L.patience = counted
    try:
        n = 4000
        later, earlier = [(i, i % 7) for i in range(n)], [(i, i % 7) for i in range(50)]
        assert sum(len(a) for a in L._stretches(later, earlier)) == n
    finally:
        L.patience = real
    assert sum(work) < 40 * n


CLASH = ("gone", "partners", "_key", "_removed", "_partners", "doc", "th", "_doc", "_th", "row", "removed", "lines", "copies", "fp", "leader")


def test_clashing_columns_are_kept(spark):
    from pyspark.sql import functions as F

    block = "\n".join(line(k) for k in range(3))
    df = documents(spark, [block, block + "\n" + line(8), "own"]).withColumns({c: F.concat(F.lit(c), F.col("doc_id").cast("string")) for c in CLASH})
    for got in (L.dedupe_lines(df), L.cut_lines(df)):
        rows = {r.doc_id: r for r in got.collect()}
        assert len(rows) == 3 and rows[1].text == line(8)
        assert all(rows[i][c] == f"{c}{i}" for i in rows for c in CLASH)
    assert L.cut_lines(df).columns == df.columns and L.dedupe_lines(df).columns == [*df.columns, "__removed", "__partners"]
    assert {r.doc_id: r.n_chars for r in L.cut_lines(df).collect()}[1] == len(line(8))
