"""Fill-in-middle against slices of code points, and exact round trips."""

import hashlib
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from cohortium.llm import block_rotation as R

from .frames import SF, awkward, documents, empty


def plain_way(doc_id, text, percent=100, spm_percent=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(units)
    x = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(x[i:i + 8], 16) for i in (0, 8, 16, 24)]
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= percent:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    pre, mid, suf = ("".join(u) for u in (units[:a], units[a:b], units[b:]))
    if h[3] % 100 < spm_percent:
        return n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


@given(st.integers(0, 300), st.text(alphabet="ab\n<PSM>é漢🙂\r\x0b ", max_size=60))
@settings(max_examples=400, deadline=None)
def test_any_text(doc_id, text):
    n, form, prefix, middle, out = R.transform_text(doc_id, text.encode())
    assert (n, form, prefix, middle, out.decode()) == plain_way(doc_id, text)
    assert R.restore_text(out, form).decode() == text


def test_rotation_of_long_buffers():
    whole = np.random.default_rng(0).integers(0, 256, 5 * R.BLOCK + 7).astype("u1")
    for lo, mid, hi in ((0, 1, len(whole)), (3, 2 * R.BLOCK, len(whole) - 5), (0, len(whole), len(whole)), (9, 9, 12)):
        got = whole.copy()
        R.rotate(got, lo, mid, hi)
        assert (got == np.concatenate([whole[:lo], whole[mid:hi], whole[lo:mid], whole[hi:]])).all()


def check(df, rows=None):
    got = R.restored(R.fill_in_middle(df)).collect()
    given_rows = sorted(((r.doc_id, r.text or "") for r in df.collect()), key=repr)
    assert sorted(((r.doc_id, r.restored) for r in got), key=repr) == given_rows
    want = sorted(((i, *plain_way(i, t)) for i, t in given_rows), key=repr)
    assert sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in got), key=repr) == want
    return got


def test_table_and_awkward_rows(spark):
    got = check(spark.read.parquet(f"{SF}/documents.parquet"))
    assert {r.form for r in got} == {"psm", "spm"}
    check(awkward(spark))
    check(documents(spark, ["<P>", "a <M> b\nc", "<", "<S", "P>\n<", "line\n" * 30_000 + "end"]))
    assert R.restored(R.fill_in_middle(empty(spark))).count() == 0


def test_shares_and_clashing_columns(spark):
    from pyspark.sql import functions as F

    df = documents(spark, [f"a{i}\nb\nc\n" for i in range(400)])
    df = df.withColumns({c: F.lit(1) for c in ("n", "form", "output", "_output", "_form", "restored", "prefix_chars")})
    got = R.fill_in_middle(df, percent=40, spm_percent=20).collect()
    assert sorted((r.doc_id, r.form, r.output) for r in got) == [(i, p[1], p[4]) for i in range(400) for p in [plain_way(i, f"a{i}\nb\nc\n", 40, 20)]]
    assert 100 < sum(r.form != "plain" for r in got) < 220
