"""Fill-in-middle transformation by rotating blocks of a byte buffer in place.

A text is cut into lines (each with its line break); two of the cuts between lines,
drawn by a hash of the document's id, make prefix, middle and suffix. The sentinels
are inserted before each of the three in a bytearray, and neighbouring segments are
exchanged by three reversals of the buffer itself:

* ``psm``: ``<P>prefix <M>middle <S>suffix``, the last two exchanged;
* ``spm``: the same buffer, the first two together exchanged with the last.

``restore`` finds the sentinels of an output, undoes the same rotation and takes them
out again. No sentinel can arise where segments meet (each begins with ``<`` and holds
no other), so a text without sentinels is restored exactly.

Work is per row and needs no shuffle; reversals use a scratch block of ``BLOCK`` bytes,
so a very long text needs little more than its own buffer.

Edge cases: NULL is the empty text; empty texts and texts that hold a sentinel stay as
they are (``plain``, no segment lengths); prefix, middle and suffix may be empty, and a
text without a line break is one line; a NULL ``doc_id`` is hashed as if written with no
digits; repeated rows each get their (equal) row; other columns are ignored, whatever
their names; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SENTINELS = (PREFIX, SUFFIX, MIDDLE)
SEED = 7
PERCENT = 100
SPM_PERCENT = 50
BLOCK = 1 << 16


def reverse(buf: np.ndarray, lo: int, hi: int) -> None:
    """Reverse ``buf[lo:hi]`` in place, a block from each end at a time."""
    while hi - lo > 1:
        k = min(BLOCK, (hi - lo) // 2)
        head = buf[lo:lo + k].copy()
        buf[lo:lo + k] = buf[hi - k:hi][::-1]
        buf[hi - k:hi] = head[::-1]
        lo, hi = lo + k, hi - k


def rotate(buf: np.ndarray, lo: int, mid: int, hi: int) -> None:
    """Exchange the neighbours ``buf[lo:mid]`` and ``buf[mid:hi]`` by three reversals."""
    reverse(buf, lo, mid)
    reverse(buf, mid, hi)
    reverse(buf, lo, hi)


def line_ends(text: bytes) -> np.ndarray:
    """Byte places of the cuts: 0 and the end of every line."""
    ends = np.flatnonzero(np.frombuffer(text, "u1") == 10) + 1
    last = [len(text)] if text and (not len(ends) or ends[-1] < len(text)) else []
    return np.concatenate([[0], ends, last]).astype("i8")


def draws(doc_id: int | None, seed: int = SEED) -> tuple[int, ...]:
    """The first four 8-digit groups of the hash of seed and id."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return tuple(int(digest[i:i + 8], 16) for i in range(0, 32, 8))


def transform_text(doc_id: int | None, text: bytes, seed: int = SEED, percent: int = PERCENT,
                   spm_percent: int = SPM_PERCENT) -> tuple[int, str, int | None, int | None, bytes]:
    """Lines, form, code points of prefix and middle, and the output of one text."""
    cuts = line_ends(text)
    n = len(cuts) - 1
    h1, h2, h3, h4 = draws(doc_id, seed)
    if not text or any(s in text for s in SENTINELS) or h3 % 100 >= percent:
        return n, "plain", None, None, text
    a, b = (int(cuts[i]) for i in sorted((h1 % (n + 1), h2 % (n + 1))))
    whole = bytearray(text)
    # the later place first, so that the earlier one stays where it is
    whole[b:b] = SUFFIX
    whole[a:a] = MIDDLE
    whole[0:0] = PREFIX
    middle = a + len(PREFIX)
    suffix = b + len(PREFIX) + len(MIDDLE)
    spm = h4 % 100 < spm_percent
    rotate(np.frombuffer(whole, "u1"), 0 if spm else middle, suffix, len(whole))
    return n, "spm" if spm else "psm", len(text[:a].decode()), len(text[a:b].decode()), bytes(whole)


def restore_text(output: bytes, form: str) -> bytes:
    """The text that ``transform_text`` made ``output`` of."""
    if form == "plain":
        return output
    whole = bytearray(output)
    start = 0 if form == "spm" else output.index(SUFFIX)
    moved = output.index(PREFIX if form == "spm" else MIDDLE)  # where the segments put last begin
    # exchange back: what was put last comes first again
    rotate(np.frombuffer(whole, "u1"), start, moved, len(whole))
    suffix = start + len(whole) - moved
    middle = whole.index(MIDDLE)
    del whole[suffix:suffix + len(SUFFIX)]
    del whole[middle:middle + len(MIDDLE)]
    del whole[:len(PREFIX)]
    return bytes(whole)


def _transform(seed: int, percent: int, spm_percent: int):
    def run(batches):
        for b in batches:
            rows = [transform_text(i, t or b"", seed, percent, spm_percent)
                    for i, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist())]
            n, form, prefix, middle, output = zip(*rows) if rows else ((),) * 5
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(prefix, pa.int64()),
                 pa.array(middle, pa.int64()), pa.array(output, pa.binary()).cast(pa.string())],
                names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])
    return run


def _restore(batches):
    for b in batches:
        texts = [None if o is None else restore_text(o, f) for o, f in zip(b.column("_output").to_pylist(), b.column("_form").to_pylist())]
        yield pa.RecordBatch.from_arrays([*b.columns[2:], pa.array(texts, pa.binary()).cast(pa.string())],
                                         names=[*b.schema.names[2:], "restored"])


def fill_in_middle(documents: DataFrame, seed: int = SEED, percent: int = PERCENT, spm_percent: int = SPM_PERCENT) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` of every document; about
    ``percent`` of them are transformed, of these ``spm_percent`` with the suffix first."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    return docs.mapInArrow(_transform(seed, percent, spm_percent),
                           "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(outputs: DataFrame) -> DataFrame:
    """``outputs`` (with ``output`` and ``form``) plus ``restored``, the text rebuilt from these two alone."""
    others = outputs.columns
    given = outputs.select(F.col("output").cast("binary").alias("_output"), F.col("form").alias("_form"), *others)
    schema = ", ".join(f"`{c}` {outputs.schema[c].dataType.simpleString()}" for c in others)
    return given.mapInArrow(_restore, f"{schema}, restored string")
