"""Line deduplication by pairwise patience alignment.

What is compared are runs of neighbouring lines: for every line that isn't blank, the
shortest runs of at least ``BLOCK_CHARS`` characters that begin or end there, so short
lines (verse, code) count together. Every run of a later document points to the earliest
document that holds it (smallest id): one partner per run, so the pairs number at most
the shared runs, however many documents share one, and no run is left out for being
frequent. For each pair the shared runs are aligned as patience diff does: runs that
occur once on both sides and rise in both (longest increasing subsequence) are anchors,
the gaps between them are aligned the same way, and equal neighbours extend them. What the
alignment of a stretch of the later document leaves out, because a block was moved or
repeated, is cut into halves, each of which is aligned with the earlier document anew; a
moved block thus meets its place once the stretch holds little else. The lines of aligned
runs are deleted from the later document, no others. Every line of a block of that many
characters that an earlier document holds lies in such a run within the block.

Rare and frequent runs alike choose the partner: a run that a third of all documents hold
has one partner in each of them, the earliest, so frequency costs no pairs, and leaving
frequent runs out would keep the most repeated passages.

Blank lines are not compared; they go with the lines on both their sides.

Edge cases: NULL texts stay NULL, empty ones empty; a document without an id is
neither earlier nor later and stays as it is; rows that repeat id and text are one
document and treated alike; of rows that share an id but not the text, the order of
their hashes decides; line order and untouched lines stay byte for byte; other
columns are kept, whatever their names. A text that loses all lines becomes empty; one of fewer characters
than a block is never touched.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortium.llm.common import lean, packed_rows, stored

BLOCK_CHARS = 40
MULTIPLIER = 0x9E3779B97F4A7C15
BATCH_RUNS = 100_000


def _rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest chain that rises in both places (pairs are sorted by the first)."""
    tails: list[int] = []
    at: list[int] = []
    back: list[int] = []
    for i, (_, b) in enumerate(pairs):
        k = bisect_left(tails, b)
        if k == len(tails):
            tails.append(b)
            at.append(i)
        else:
            tails[k], at[k] = b, i
        back.append(at[k - 1] if k else -1)
    out, i = [], at[-1] if at else -1
    while i >= 0:
        out.append(pairs[i])
        i = back[i]
    return out[::-1]


def patience(later: list[tuple[int, int]], earlier: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Aligned places of two lists of (place, line hash), each in order."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(later), 0, len(earlier))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and later[a0][1] == earlier[b0][1]:
            out.append((later[a0][0], earlier[b0][0]))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and later[a1 - 1][1] == earlier[b1 - 1][1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((later[a1][0], earlier[b1][0]))
        if a0 >= a1 or b0 >= b1:
            continue
        once: dict[int, list] = {}
        for i in range(a0, a1):
            once.setdefault(later[i][1], [0, 0, 0, 0])
            once[later[i][1]][0] += 1
            once[later[i][1]][1] = i
        for j in range(b0, b1):
            if (x := once.get(earlier[j][1])) is not None:
                x[2] += 1
                x[3] = j
        anchors = _rising(sorted((x[1], x[3]) for x in once.values() if x[0] == 1 and x[2] == 1))
        if not anchors:
            # only repeated lines are left: the first common place of each, in order
            j = b0
            places: dict[int, list[int]] = {}
            for k in range(b0, b1):
                places.setdefault(earlier[k][1], []).append(k)
            for i in range(a0, a1):
                own = places.get(later[i][1], [])
                k = bisect_left(own, j)
                if k < len(own):
                    out.append((later[i][0], earlier[own[k]][0]))
                    j = own[k] + 1
            continue
        i0, j0 = a0, b0
        for i, j in anchors:
            out.append((later[i][0], earlier[j][0]))
            todo.append((i0, i, j0, j))
            i0, j0 = i + 1, j + 1
        todo.append((i0, a1, j0, b1))
    return sorted(out)


def _stretches(later: list[tuple[int, int]], earlier: list[tuple[int, int]]):
    """Alignments of ever smaller stretches of ``later``, until each run that ``earlier`` has is aligned."""
    places: dict[int, list[int]] = {}
    for b, h in earlier:
        places.setdefault(h, []).append(b)
    todo = [(later, earlier)]
    while todo:
        stretch, other = todo.pop()
        aligned = patience(stretch, other)
        if aligned:
            yield aligned
        done = {a for a, _ in aligned}
        rest = [x for x in stretch if x[0] not in done]
        if not rest or len(stretch) == 1:
            continue
        half = (len(rest) + 1) // 2
        for part in (rest[:half], rest[half:]):
            # of the earlier runs only those that the part holds; as many copies of each as it can use
            held = Counter(h for _, h in part)
            own = sorted((b, h) for h, n in held.items() for b in places.get(h, [])[:n])
            if own:
                todo.append((part, own))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, "u8")
    out[:1] = 1
    return np.cumprod(out)  # modulo 2^64


def _runs(text: str, least: int) -> tuple[np.ndarray, ...] | None:
    """Of each run of ``text``: hash, first and last line, the line after it that isn't
    blank (minus the number of lines if there is none), and whether none is before it."""
    import xxhash

    lines = [x.strip(" ") for x in text.split("\n")]
    own = np.array([i for i, x in enumerate(lines) if x], "i8")
    before = np.concatenate([[0], np.cumsum([len(lines[i]) for i in own])]).astype("i8")
    if before[-1] < least:
        return None
    n = len(own)
    stop = np.searchsorted(before, before[:-1] + least)
    first = np.searchsorted(before, before[1:] - least, side="right") - 1
    begin, end = np.flatnonzero(stop <= n), np.flatnonzero(first >= 0)
    pairs = np.unique(np.concatenate([begin * (n + 1) + stop[begin], first[end] * (n + 1) + end + 1]))
    first, stop = np.divmod(pairs, n + 1)
    h = np.array([xxhash.xxh64_intdigest(lines[i]) for i in own], "u8")
    sums = np.concatenate([np.zeros(1, "u8"), np.cumsum(h * _powers(MULTIPLIER, len(h)))])
    runs = (sums[stop] - sums[first]) * _powers(pow(MULTIPLIER, -1, 1 << 64), len(h))[first]
    after = np.append(own, -len(lines))[stop]
    return runs.view("i8"), own[first], own[stop - 1], after, first == 0


def _shingle(least: int):
    """(doc, th, h, at, after, lead): a row per distinct run of a text, with its places."""
    names = ["doc", "th", "h", "at", "after", "lead"]

    def batch(rows):
        doc, th, h, at, after, lead, sizes = (np.concatenate(c) for c in zip(*rows))
        offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
        lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (at, after)]
        return pa.RecordBatch.from_arrays([pa.array(doc), pa.array(th), pa.array(h), *lists, pa.array(lead)], names=names)

    def run(batches):
        rows, size = [], 0
        for b in batches:
            for doc, th, text in zip(*(b.column(c).to_pylist() for c in ("doc", "th", "text"))):
                if (got := _runs(text, least)) is None:
                    continue
                h, lo, hi, after, lead = got
                order = np.argsort(h, kind="stable")
                h = h[order]
                new = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
                rows.append((np.full(len(new), doc, "i8"), np.full(len(new), th, "i8"), h[new], (lo << 32 | hi)[order],
                             after[order].astype("i4"), np.logical_or.reduceat(lead[order], new), np.diff(np.append(new, len(h)))))
                size += len(h)
                if size >= BATCH_RUNS:
                    yield batch(rows)
                    rows, size = [], 0
        if rows:
            yield batch(rows)
    return run


def _doomed(matches: list[dict]) -> tuple[list[int], list[int]]:
    """Lines to delete of one later document, and the partners they repeat."""
    pairs: dict[tuple, list[dict]] = {}
    for m in matches:
        pairs.setdefault((m["p_doc"], m["p_th"]), []).append(m)
    cut: set[int] = set()
    partners: set[int] = set()
    for (doc, _), own in pairs.items():
        later = sorted((at, m["h"]) for m in own for at in m["at"])
        earlier = sorted((q, m["h"]) for m in own for q in m["p_at"])
        for aligned in _stretches(later, earlier):
            cut.update(a for a, _ in aligned)
            partners.add(doc)
    gone: set[int] = set()
    for at in cut:
        gone.update(range(at >> 32, (at & 0xFFFFFFFF) + 1))
    # blank lines between two lines that go; if no other line is left, the outer ones too
    lead, lines = False, 0
    for m in matches:
        for at, after in zip(m["at"], m["after"]):
            if at in cut:
                lead |= m["lead"]
                lines = max(lines, -after)
                if after in gone:
                    gone.update(range((at & 0xFFFFFFFF) + 1, after))
    if lead and lines and len(gone) == max(gone) - min(gone) + 1:
        gone = set(range(lines))
    return sorted(gone), sorted(partners)


def _align(batches):
    for b in batches:
        found = [_doomed(m) for m in b.column("matches").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [b.column("doc"), b.column("th"), pa.array([f[0] for f in found], pa.list_(pa.int32())),
             pa.array([f[1] for f in found], pa.list_(pa.int64()))], names=["doc", "th", "gone", "partners"])


def deletions(documents: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(doc, th, gone, partners) of each later document that loses lines; ``th`` is its text's hash."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc"), F.col("text").cast("string").alias("text")).where("doc IS NOT NULL AND text IS NOT NULL")
    runs = docs.select("doc", F.xxhash64("text").alias("th"), "text").mapInArrow(
        lean(_shingle(block_chars)), "doc long, th long, h long, at array<long>, after array<int>, lead boolean")
    own = F.struct("doc", "th")
    # both small tables are stored: a join straight above an aggregate on its key could not be split by skew
    shared = (runs.groupBy("h").agg(F.min(own).alias("first"), F.max(own).alias("last")).where("first <> last")
              .select("h", F.col("first.doc").alias("p_doc"), F.col("first.th").alias("p_th")))
    met = stored(runs.join(stored(shared, "run-firsts"), "h"), "shared-runs")
    is_first = (F.col("doc") == F.col("p_doc")) & (F.col("th") == F.col("p_th"))
    places = met.where(is_first).groupBy("h").agg(F.min("at").alias("p_at"))  # repeated rows have equal places
    later = met.where(~is_first).distinct().join(stored(places, "run-places"), "h")
    each = later.groupBy("doc", "th").agg(F.collect_list(F.struct("h", "at", "after", "lead", "p_doc", "p_th", "p_at")).alias("matches"))
    found = each.mapInArrow(lean(_align), "doc long, th long, gone array<int>, partners array<long>")
    return found.where(F.size("gone") > 0)


def _cut(documents: DataFrame, block_chars: int) -> DataFrame:
    """(row, text, removed, partners) of every document: the row as it came and its text without the lines cut."""
    keyed = packed_rows(documents).select("row", F.col("row.doc_id").cast("long").alias("doc"),
                                          F.xxhash64(F.col("row.text").cast("string")).alias("th"))
    x = keyed.join(deletions(documents, block_chars), ["doc", "th"], "left")
    given = F.col("row.text").cast("string")
    lines = F.split(given, "\n", -1)
    rest = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("gone"))
    cut = F.array_join(F.transform(rest, lambda i: F.get(lines, i)), "\n")
    return x.select("row", F.when(F.col("gone").isNull(), given).otherwise(cut).alias("text"),
                    F.coalesce("gone", F.array().cast("array<int>")).alias("removed"),
                    F.coalesce("partners", F.array().cast("array<bigint>")).alias("partners"))


def _columns(documents: DataFrame, **new) -> list:
    """The columns of the rows, those in ``new`` replaced."""
    return [(new[c] if c in new else F.col(f"row.`{c}`")).alias(c) for c in documents.columns]


def dedupe_lines(documents: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``documents`` with the blocks that repeat an earlier document cut from ``text``,
    plus ``_removed`` (places of the lines cut) and ``_partners`` (ids they repeat), with
    more underscores in front where ``documents`` has columns of these names."""
    names = []
    for name in ("_removed", "_partners"):
        while name.lower() in {c.lower() for c in documents.columns}:
            name = "_" + name
        names.append(name)
    return _cut(documents, block_chars).select(*_columns(documents, text=F.col("text")), F.col("removed").alias(names[0]), F.col("partners").alias(names[1]))


def cut_lines(documents: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``documents`` with its own columns alone: ``text`` without repeated blocks, ``n_chars`` (if present) following."""
    new = {"text": F.col("text")}
    if "n_chars" in documents.columns:
        size = F.length("text").cast(documents.schema["n_chars"].dataType)
        new["n_chars"] = F.when(F.size("removed") > 0, size).otherwise(F.col("row.n_chars"))
    return _cut(documents, block_chars).select(*_columns(documents, **new))
