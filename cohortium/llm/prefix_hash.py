"""Document fingerprints from prefix polynomial hashes.

The prefix array H[i] = sum of c[j] * B^j (mod p) over j < i answers whether
two spans are equal (difference of two entries, shifted), and a binary search
over it finds the longest common extension of two positions, forwards or back.
The stored fingerprint keeps H at block ends, counted from the start and from the
end, on a grid of power-of-two steps (at most ``GRID`` blocks), the length and a
62-bit hash of the whole text.

How alike two documents are is found on their whole prefix arrays, which the sorted
stream holds for a document and the next one: the common beginning and end, and then
every stretch that both hold, wherever it stands. Stretches are met at anchors (``GRAM`` characters whose
hash, taken from the prefix array, is the smallest of some ``ANCHOR`` neighbours, so they
are chosen by content and not by place, and every common stretch of GRAM + ANCHOR - 1
characters holds one) and extended both ways; likeness is the part of the longer text that such stretches cover in both. So
neither shifted text nor edits scattered over it hide what is common.

Edge cases: NULL text is empty; two empty texts are alike (1.0), an empty and
a non-empty one are not (0.0). NULL ``doc_id`` orders as the smallest; rows of
equal id are ordered by their text's hash. A single document is its own next.
"""

from __future__ import annotations

import hashlib
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortium.llm.common import doc_texts, parts

P = (1 << 31) - 1
BASES = (911_382_323, 972_663_749)
GRID = 64
BLOCK = 1 << 16
GRAM = 24
ANCHOR = 24

_NEXT = "doc_id long, text string, next_text string"


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, "i8")
    k = 1
    while k < n:
        m = min(k, n - k)
        out[k:k + m] = out[:m] * pow(base, k, P) % P
        k += m
    return out


POW = [_powers(b, BLOCK) for b in BASES]
INVERSE = pow(BASES[0], P - 2, P)
INV_POW = _powers(INVERSE, BLOCK)


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), "<u4")


class PrefixHashes:
    """Prefix hashes of one text; entry i covers its first i code points."""

    def __init__(self, c: np.ndarray):
        self.n = len(c)
        self.h = np.zeros(self.n + 1, "i8")
        whole = 0
        for at in range(0, self.n, BLOCK):
            part = c[at:at + BLOCK].astype("i8") + 1
            m = len(part)
            local = np.cumsum(part * POW[0][:m] % P)
            self.h[at + 1:at + m + 1] = (self.h[at] + local % P * pow(BASES[0], at, P)) % P
            whole = (whole + int((part * POW[1][:m] % P).sum()) % P * pow(BASES[1], at, P)) % P
        self.whole = (int(self.h[-1]) << 31) | whole

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of the spans, each shifted to begin at 0."""
        shift = INV_POW[start % BLOCK]
        if self.n >= BLOCK:
            blocks = np.array([pow(INVERSE, int(b) * BLOCK, P) for b in range(self.n // BLOCK + 1)], "i8")
            shift = shift * blocks[start // BLOCK] % P
        return (self.h[end] - self.h[start]) % P * shift % P

    def span(self, start: int, end: int) -> int:
        return int(self.spans(np.array([start]), np.array([end]))[0])

    def common_extension(self, i: int, other: PrefixHashes, j: int) -> int:
        """Length of the longest common run from ``i`` here and ``j`` there."""
        return _longest(min(self.n - i, other.n - j), lambda m: self.span(i, i + m) == other.span(j, j + m))

    def common_extension_back(self, i: int, other: PrefixHashes, j: int) -> int:
        """Length of the longest common run that ends before ``i`` here and ``j`` there."""
        return _longest(min(i, j), lambda m: self.span(i - m, i) == other.span(j - m, j))

    @cached_property
    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Places whose next ``GRAM`` characters are an anchor, and the hashes of those."""
        n = self.n - GRAM + 1
        if n < 1:
            return np.zeros(0, "i8"), np.zeros(0, "i8")
        h = np.empty(n, "i8")
        for start in range(0, n, BLOCK):
            place = np.arange(start, min(start + BLOCK, n))
            h[start:start + BLOCK] = self.spans(place, place + GRAM)
        key = (h * 0x9E3779B1) >> 7 & 0xFFFFFFFF  # an order that the characters have no part in
        least = _sliding(key, min(ANCHOR, n), np.minimum)
        # the smallest key of some window: the largest of the minima around it is its own
        pad = np.full(len(key) - len(least), -1)
        own = _sliding(np.concatenate([pad, least, pad]), min(ANCHOR, n), np.maximum) == key
        at = np.flatnonzero(own)
        return at, h[at]


def _sliding(x: np.ndarray, width: int, best) -> np.ndarray:
    """``best`` (minimum or maximum) of every ``width`` neighbours, from running ones inside blocks of ``width``."""
    n = len(x)
    blocks = np.concatenate([x, np.repeat(x[-1:], -n % width)]).reshape(-1, width)
    ahead = best.accumulate(blocks, axis=1).ravel()[:n]
    behind = best.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()[:n]
    return best(behind[:n - width + 1], ahead[width - 1:])


def _longest(limit: int, same) -> int:
    """The largest m up to ``limit`` for which ``same`` holds; it holds for all smaller ones too."""
    low, high, step = 0, limit, 64
    # a short run is told by a few steps, a long one by doubling
    while low < high and step < high:
        if not same(step):
            high = step - 1
            break
        low, step = step, 2 * step
    while low < high:
        mid = (low + high + 1) // 2
        if same(mid):
            low = mid
        else:
            high = mid - 1
    return low


def _covered(spans: list[tuple[int, int]]) -> int:
    """How many places the spans cover together."""
    out = stop = 0
    for a, b in sorted(spans):
        out += max(0, b - max(a, stop))
        stop = max(stop, b)
    return out


def overlap(x: PrefixHashes, y: PrefixHashes) -> float:
    """Part of the longer text that stretches held by both cover, 0 to 1."""
    if x.n == y.n and x.whole == y.whole:
        return 1.0
    if not x.n or not y.n:
        return 0.0
    if (x.n, x.whole) > (y.n, y.whole):  # the same result both ways round
        x, y = y, x
    head = x.common_extension(0, y, 0)
    tail = min(x.common_extension_back(x.n, y, y.n), x.n - head)
    found = [(0, 0, head), (x.n - tail, y.n - tail, tail)]
    at, h = x.anchors
    other_at, other_h = y.anchors
    order = np.lexsort((other_at, other_h))
    other_at, other_h = other_at[order], other_h[order]
    low, high = np.searchsorted(other_h, h, "left"), np.searchsorted(other_h, h, "right")
    meets = np.flatnonzero((high > low) & (at >= head) & (at < x.n - tail))
    done, shift = head, 0
    for k in meets.tolist():
        i = int(at[k])
        if i < done:
            continue
        # of several places take the one nearest to where the last stretch went on
        places = other_at[low[k]:high[k]]
        near = int(np.searchsorted(places, i + shift))
        j = int(min(places[max(0, near - 1):near + 1], key=lambda p: abs(p - i - shift)))
        ahead = x.common_extension(i, y, j)
        if not ahead:
            continue
        back = min(x.common_extension_back(i, y, j), i - done)
        found.append((i - back, j - back, back + ahead))
        done, shift = i + ahead, j - i
    both = min(_covered([(i, i + m) for i, _, m in found]), _covered([(j, j + m) for _, j, m in found]))
    return both / y.n


class Fingerprint:
    """Length, step, whole hash and the grids from the start and from the end."""

    def __init__(self, n: int, step: int, whole: int, front: np.ndarray, back: np.ndarray):
        self.n, self.step, self.whole, self.front, self.back = n, step, whole, front, back

    @classmethod
    def of(cls, c: np.ndarray) -> Fingerprint:
        return cls.from_hashes(PrefixHashes(c))

    @classmethod
    def from_hashes(cls, hashes: PrefixHashes) -> Fingerprint:
        n = hashes.n
        step = 1 << max(0, (max(1, -(-n // GRID)) - 1).bit_length())
        k = np.arange(1, n // step + 1)
        return cls(n, step, hashes.whole, hashes.h[k * step], hashes.spans(n - k * step, np.full(len(k), n)))

    def __str__(self) -> str:
        grid = np.concatenate([self.front, self.back]).astype(">u4").tobytes().hex()
        return f"{self.n:x}.{self.step.bit_length() - 1:x}.{self.whole:016x}.{grid}"

    @classmethod
    def parse(cls, s: str) -> Fingerprint:
        n, step, whole, grid = s.split(".")
        g = np.frombuffer(bytes.fromhex(grid), ">u4").astype("i8")
        return cls(int(n, 16), 1 << int(step, 16), int(whole, 16), g[:len(g) // 2], g[len(g) // 2:])


def _leading(a: np.ndarray, b: np.ndarray) -> int:
    """Equal blocks at the front: equality of prefixes is monotone, so by binary search."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        if a[mid - 1] == b[mid - 1]:
            low = mid
        else:
            high = mid - 1
    return low


def likeness(a: Fingerprint, b: Fingerprint) -> float:
    """Part of the longer text that equal blocks of the other cover, 0 to 1: a quick lower
    bound from the stored grids alone, which sees blocks at one distance from the start and
    the common end. ``overlap`` finds shifted blocks too."""
    if a.n == b.n and a.whole == b.whole:
        return 1.0
    short, long = min(a.n, b.n), max(a.n, b.n)
    if not short:
        return 0.0
    step = max(a.step, b.step)
    blocks = short // step
    every = np.arange(1, blocks + 1) * step
    fa, fb = a.front[every // a.step - 1], b.front[every // b.step - 1]
    ba, bb = a.back[every // a.step - 1], b.back[every // b.step - 1]
    same = np.zeros(short, bool) if blocks else np.zeros(0, bool)
    head, tail = _leading(fa, fb), _leading(ba, bb)
    same[:head * step] = True
    if tail:
        same[short - tail * step:] = True
    if blocks:
        # blocks after the first difference that are equal again, at one distance from the start
        da, db = np.diff(fa, prepend=0) % P, np.diff(fb, prepend=0) % P
        for k in np.flatnonzero(da == db):
            if k >= head:
                same[k * step:(k + 1) * step] = True
    return float(same.sum()) / long


def _deal(bounds: np.ndarray):
    """Bucket of each document; a bucket's largest id also goes to the bucket
    above it (or, for the largest of all, to the lowest) as what follows there."""
    def run(batches):
        for b in batches:
            keys = np.asarray(b.column("k"))
            bucket = np.searchsorted(bounds, keys)
            head = np.flatnonzero(bounds[bucket] == keys)
            rows = pa.array(np.concatenate([np.arange(len(keys)), head]))
            place = np.concatenate([bucket, (bucket[head] + 1) % len(bounds)])
            halo = np.concatenate([np.zeros(len(keys), bool), np.ones(len(head), bool)])
            t = pa.table(b).take(rows) if isinstance(b, pa.RecordBatch) else b.take(rows)
            t = t.append_column("bucket", pa.array(place, pa.int32())).append_column("halo", pa.array(halo))
            yield from t.combine_chunks().to_batches()
    return run


def with_next(documents: DataFrame, buckets: int | None = None) -> DataFrame:
    """Pairs of consecutive documents, by descending id, as rows of one sorted
    stream per bucket of ids: each text is shuffled once. ``halo`` rows only
    serve as the next of the last document of their bucket."""
    docs = doc_texts(documents).select("doc_id", F.coalesce("text", F.lit("")).alias("text"),
                                       F.coalesce("doc_id", F.lit(-(1 << 63))).alias("k"))
    buckets = buckets or 4 * parts(docs.sparkSession)
    at = [i / buckets for i in range(1, buckets)]
    got = docs.agg(F.percentile_approx("k", at + [1.0], 10 * buckets).alias("q"), F.max("k").alias("top")).head()
    if got["top"] is None:
        return docs.withColumns({"bucket": F.lit(0), "halo": F.lit(False)}).drop("k")
    bounds = np.array(sorted({*got["q"], got["top"]}), "i8")
    dealt = docs.mapInArrow(_deal(bounds), "doc_id long, text string, k long, bucket int, halo boolean")
    return (dealt.repartition(parts(docs.sparkSession), "bucket")
            .sortWithinPartitions("bucket", "halo", F.desc("k"), F.xxhash64("text")).drop("k"))


def _pairs(batches):
    """(row, next row) along the sorted stream, each with its characters and prefix hashes."""
    last = None
    for b in batches:
        for row in zip(*(b.column(c).to_pylist() for c in ("bucket", "halo", "doc_id", "text"))):
            c = codes(row[3])
            now = (*row, c, PrefixHashes(c))
            if last and not last[1] and last[0] == now[0]:
                yield last, now
            last = now


def _fingerprints(batches):
    out: list[tuple] = []
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def batch():
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

    for (_, _, doc, text, c, h), (_, _, _, next_text, next_c, next_h) in _pairs(batches):
        cut = len(c) // 3
        edited = text[:len(text) - cut] + next_text[:cut]
        edited_h = PrefixHashes(np.concatenate([c[:len(c) - cut], next_c[:cut]]))
        out.append((doc, len(c), hashlib.sha256(edited.encode("utf-8")).hexdigest(), str(Fingerprint.from_hashes(h)),
                    str(Fingerprint.from_hashes(edited_h)), overlap(h, edited_h), overlap(h, next_h)))
        if len(out) == 1000:
            yield batch()
            out = []
    if out:
        yield batch()


def fingerprint_documents(documents: DataFrame, buckets: int | None = None) -> DataFrame:
    """Each document's fingerprint, that of its edited text (its last third
    replaced by the start of the next document) and their likeness."""
    return with_next(documents, buckets).mapInArrow(
        _fingerprints, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                       "edited_fingerprint string, near_edited double, near_next double")
