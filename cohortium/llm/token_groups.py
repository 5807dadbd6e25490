"""Exact Jaccard join of documents by word shingles, through a token-group matrix.

A document is the set of its distinct shingles (64-bit hashes of ``SHINGLE`` words). Equal
sets are one class with one representative; everything below works on classes.

1. **Token order.** Shingles are counted over all documents in hash slots. The slots only
   order the tokens (rare ones first, equal ones by hash), so a collision costs time but
   never a link.
2. **Prefixes.** Two sets of sizes a <= b that link share a token among the first
   b - ceil(0.8 b) + 1 of the larger one and the first a - ceil(8a / 9) + 1 of the smaller
   one, in any common order. Classes none of whose prefix tokens is in another class's
   prefix are done.
3. **Groups.** The rest is partitioned by the prefix token that most classes share (near
   copies mostly agree on it); a group of more than ``GROUP`` sets or ``GROUP_TOKENS``
   tokens is cut by a hash. A group is opened against itself: every pair of it is compared,
   and the links of a spanning forest are kept. Groups that were cut are cut a second time
   by another hash, so that the parts of a large family of near copies meet, and the family
   is mostly one component before the next step.
4. **Matrix.** A row (token, group) for every prefix token of a group's members, with the
   range of their sizes and components. Queries are joined to it by their own prefix
   tokens; what has one component on both sides is left out.
5. **Bound and open.** A query first meets the parity bitmaps of a group's members: two
   bitmaps differ in at most as many bits as the sets do in tokens, so too many differing
   bits rule a link out, at an eighth of a byte a token. If any member is left the query
   meets the group's token union: if that holds less than 0.8 of the query, no member can
   link and the group stays shut; otherwise the overlap with every member is counted
   exactly, and a link to one member of each component is kept.

Steps 3 and 5 stream rows sorted by group, bitmaps first and whole sets only for what they
leave; a group asked by many queries is copied to several tasks. Links between components
are found whatever the order, the slots or the bitmaps are, so the components are exact
(up to equal 64-bit hashes of different shingles or sets).

Edge cases: NULL, empty and blank texts have no shingles, are linked with nothing and are
their own component; fewer words than ``SHINGLE`` are one shingle; a NULL ``doc_id``
shares its class's component but never names it (alone it gets NULL); repeated rows
each get their row; other columns are ignored, whatever their names; an empty table
gives no rows.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortium.llm.common import doc_texts, parts, stored
from cohortium.llm.components import connected_components

SHINGLE = 5
PERCENT = 80
SLOT_TOKENS = 8
MIN_SLOTS, MAX_SLOTS = 1 << 16, 1 << 25
SLOT_BLOCK = 1 << 16
GROUP = 128
GROUP_TOKENS = 4_000_000
QUERIES = 2000
BROADCAST_ROWS = 200_000
KNOWN_WORDS = 500_000
BATCH_TOKENS = 2_000_000
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


class WordHashes(dict):
    """64-bit hash of a word; forgotten when too many are held."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


def tokens(text: str | None, known: WordHashes, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted distinct shingle hashes of a text."""
    words = (text or "").encode("utf-8").translate(LOWER).split()
    if not words:
        return np.zeros(0, "i8")
    h = np.fromiter(map(known.__getitem__, words), "u8", len(words))
    k = min(shingle, len(words))
    out = np.full(len(words) - k + 1, k, "u8")
    for j in range(k):
        out = out * MULTIPLIER + h[j:len(words) - k + 1 + j]
    # spread the bits, so that the order of the hashes is arbitrary
    out = (out ^ (out >> np.uint64(30))) * MIX[0]
    out = (out ^ (out >> np.uint64(27))) * MIX[1]
    return np.unique((out ^ (out >> np.uint64(31))).view("i8"))


def query_prefix(n: int, percent: int = PERCENT) -> int:
    """Length of the prefix that a set of ``n`` tokens asks with."""
    return n - (n * percent + 99) // 100 + 1


# -- token order ---------------------------------------------------------------


def _slot(toks: np.ndarray, slots: int) -> np.ndarray:
    return (toks.view("u8") >> np.uint64(64 - slots.bit_length() + 1)).astype("i4")


def _count_slots(shingle: int, slots: int):
    def run(batches):
        known, sums = WordHashes(), np.zeros(slots, "i4")
        for b in batches:
            held, size = [], 0
            for text in b.column("text").to_pylist():
                held.append(_slot(tokens(text, known, shingle), slots))
                size += len(held[-1])
                if size > slots // 4:
                    np.add.at(sums, np.concatenate(held), 1)
                    held, size = [], 0
            if size:
                np.add.at(sums, np.concatenate(held), 1)
        for block in range(slots // SLOT_BLOCK):
            part = sums[block * SLOT_BLOCK:(block + 1) * SLOT_BLOCK]
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([zlib.compress(part.tobytes(), 1)])], names=["block", "counts"])
    return run


def _sum_slots(batches):
    sums: dict[int, np.ndarray] = {}
    for b in batches:
        for block, counts in zip(b.column("block").to_pylist(), b.column("counts").to_pylist()):
            part = np.frombuffer(zlib.decompress(counts), "i4")
            sums[block] = sums[block] + part if block in sums else part.astype("i8")
    for block, counts in sums.items():
        yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([counts.astype("f4").tobytes()])], names=["block", "counts"])


def token_levels(texts: DataFrame, shingle: int = SHINGLE) -> np.ndarray:
    """How frequent the tokens of each slot are, as a small number: 0 up to some three times
    the mean of all slots, two more for every doubling.

    There is a slot for about ``SLOT_TOKENS`` shingles (``MAX_SLOTS`` at most), so that a level
    stands for the same number of documents at every size. A number per slot to the driver.
    """
    spark = texts.sparkSession
    chars = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    slots = min(MAX_SLOTS, max(MIN_SLOTS, 1 << round(math.log2(1 + chars / 6 / SLOT_TOKENS))))
    schema = "block int, counts binary"
    each = texts.select("text").mapInArrow(_count_slots(shingle, slots), schema)
    rows = each.repartition(min(parts(spark), slots // SLOT_BLOCK), "block").mapInArrow(_sum_slots, schema).collect()
    counts = np.zeros(slots, "f4")
    for r in rows:
        counts[r.block * SLOT_BLOCK:(r.block + 1) * SLOT_BLOCK] = np.frombuffer(r.counts, "f4")
    mean = max(0.5, float(counts.mean(dtype="f8")))
    return (2 * np.log2(np.maximum(1.0, counts / (2 * mean)))).astype("u1")


# -- sets and prefixes ---------------------------------------------------------


def _lists(values: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype("i4")
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(values) if values else np.zeros(0, "i8")))


def _arrays(column) -> list[np.ndarray]:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    offsets, values = np.asarray(column.offsets), np.asarray(column.flatten())
    return [values[a:b] for a, b in zip(offsets - offsets[0], offsets[1:] - offsets[0])]


def _set_id(toks: np.ndarray) -> int | None:
    if not len(toks):
        return None
    h = xxhash.xxh64_intdigest(toks.tobytes())
    return h - (1 << 64) if h >> 63 else h


def _prefixes(shared, shingle: int, percent: int):
    def run(batches):
        levels, known = shared.value, WordHashes()

        def batch(rows):
            doc_id, doc, th, n, sid, bits, prefix = zip(*rows)
            longs = [pa.array(c, pa.int64()) for c in (doc_id, doc, th, n, sid)]
            return pa.RecordBatch.from_arrays([*longs, pa.array(bits, pa.binary()), _lists(list(prefix))],
                                              names=["doc_id", "doc", "th", "n", "sid", "bits", "prefix"])
        for b in batches:
            rows, size = [], 0
            for doc_id, doc, th, text in zip(*(b.column(c).to_pylist() for c in ("doc_id", "doc", "th", "text"))):
                toks = tokens(text, known, shingle)
                # equal levels stay in the order of the hashes
                order = np.argsort(levels[_slot(toks, len(levels))], kind="stable")
                rows.append((doc_id, doc, th, len(toks), _set_id(toks), parity_bits(toks), toks[order[:query_prefix(len(toks), percent)]] if len(toks) else toks))
                size += len(rows[-1][-1])
                if size > BATCH_TOKENS:
                    yield batch(rows)
                    rows, size = [], 0
            if rows:
                yield batch(rows)
    return run


def _whole_sets(shingle: int):
    def run(batches):
        known = WordHashes()
        for b in batches:
            rows, size = [], 0
            for sid, text in zip(b.column("sid").to_pylist(), b.column("text").to_pylist()):
                rows.append((sid, tokens(text, known, shingle)))
                size += len(rows[-1][1])
                if size > BATCH_TOKENS:
                    yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), _lists([r[1] for r in rows])], names=["sid", "toks"])
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), _lists([r[1] for r in rows])], names=["sid", "toks"])
    return run


# -- bitmaps -------------------------------------------------------------------


def parity_bits(toks: np.ndarray) -> bytes:
    """One bit per token and more (a power of two): odd or even number of tokens there."""
    size = max(64, 1 << (len(toks) - 1).bit_length()) if len(toks) else 64
    odd = np.bincount((toks.view("u8") & np.uint64(size - 1)).astype("i8"), minlength=size) & 1
    return np.packbits(odd.astype("u1"), bitorder="little").tobytes()


def _folded(words: np.ndarray, size: int) -> np.ndarray:
    """Bitmaps (last axis) of ``size`` 64-bit words: halves laid over each other."""
    while words.shape[-1] > size:
        half = words.shape[-1] // 2
        words = words[..., :half] ^ words[..., half:]
    return words


class Screen:
    """Bitmaps of a group's members, by their size."""

    def __init__(self, members: list[tuple], percent: int):
        self.members, self.percent = members, percent
        by_size: dict[int, list[int]] = {}
        for i, m in enumerate(members):
            by_size.setdefault(len(m[3]) // 8, []).append(i)
        self.levels = [(size, np.array(at), np.stack([np.frombuffer(members[i][3], "<u8") for i in at]),
                        np.array([members[i][2] for i in at], "i8")) for size, at in by_size.items()]

    def left(self, n: int, bits: bytes) -> np.ndarray:
        """Members that a set of ``n`` tokens with these bits may link with."""
        own, out = np.frombuffer(bits, "<u8"), []
        for size, at, words, sizes in self.levels:
            low, high = np.minimum(sizes, n), np.maximum(sizes, n)
            near = 100 * low >= self.percent * high
            if not near.any():
                continue
            common = min(size, len(own))
            apart = np.bitwise_count(_folded(words[near], common) ^ _folded(own, common)).sum(axis=1, dtype="i8")
            both = sizes[near] + n
            least = (self.percent * both + 99 + self.percent) // (100 + self.percent)
            out.append(at[near][apart <= both - 2 * least])
        return np.concatenate(out) if out else np.zeros(0, "i8")


def _screen(percent: int):
    """Along rows sorted by group, members before queries: those that some bitmap leaves."""
    def run(batches):
        key, members, screen, kept = None, [], None, set()

        def close():
            if screen is None and len(members) > 1:  # a group that is opened against itself
                own = Screen(members, percent)
                for i, m in enumerate(members):
                    rest = [j for j in own.left(m[2], m[3]).tolist() if members[j][0] != m[0]]
                    kept.update([i, *rest] if rest else [])
            return [(*key, False, *members[i][:2]) for i in sorted(kept)]

        for b in batches:
            out = []
            for grp, salt, query, *row in zip(*(b.column(c).to_pylist() for c in ("grp", "salt", "query", "sid", "comp", "n", "bits"))):
                if (grp, salt) != key:
                    out += close()
                    key, members, screen, kept = (grp, salt), [], None, set()
                if not query:
                    if not members or members[-1][0] != row[0]:
                        members.append(row)
                    continue
                screen = screen or Screen(members, percent)
                left = [j for j in screen.left(row[2], row[3]).tolist() if members[j][1] != row[1]]
                if left:
                    kept.update(left)
                    out.append((grp, salt, True, *row[:2]))
            yield _rows(out)
        yield _rows(close())
    return run


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int32(), pa.bool_(), pa.int64(), pa.int64()]
    columns = list(zip(*rows)) if rows else [()] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["grp", "salt", "query", "sid", "comp"])


# -- opening groups ------------------------------------------------------------


class Group:
    """Members of a group and the matrix of their tokens: one entry per token and member."""

    def __init__(self, members: list[tuple[int, int, np.ndarray]], percent: int):
        self.ids = [m[0] for m in members]
        self.comps = [m[1] for m in members]
        self.percent = percent
        self.sizes = np.array([len(m[2]) for m in members], "i8")
        toks = np.concatenate([m[2] for m in members])
        order = np.argsort(toks, kind="stable")
        self.toks, self.who = toks[order], np.repeat(np.arange(len(members)), self.sizes)[order]

    def linked(self, toks: np.ndarray) -> np.ndarray:
        """Members that link with the set ``toks``; none if their union holds too little of it."""
        low, high = np.searchsorted(self.toks, toks, "left"), np.searchsorted(self.toks, toks, "right")
        held = high - low
        if 100 * np.count_nonzero(held) < self.percent * len(toks):
            return np.zeros(0, "i8")
        first = np.cumsum(held) - held
        at = np.repeat(low - first, held) + np.arange(held.sum())
        both = np.bincount(self.who[at], minlength=len(self.ids))
        return np.flatnonzero(100 * both >= self.percent * (self.sizes + len(toks) - both))

    def forest(self) -> list[tuple[int, int]]:
        """Links that connect the members as all their links do."""
        root = list(range(len(self.ids)))

        def find(i):
            while root[i] != i:
                root[i] = i = root[root[i]]
            return i

        out = []
        order = np.argsort(self.who, kind="stable")
        own = np.split(self.toks[order], np.cumsum(self.sizes)[:-1])
        for i, toks in enumerate(own):
            for j in self.linked(toks).tolist():
                a, b = find(i), find(j)
                if a != b:
                    root[max(a, b)] = min(a, b)
                    out.append((self.ids[i], self.ids[j]))
        return out


def _open(percent: int):
    """Along rows sorted by group, members before queries: links within a group that has no
    queries, and of each query to one member of every component."""
    def run(batches):
        key, members, group = None, {}, None

        def close():
            return Group(list(members.values()), percent).forest() if group is None and len(members) > 1 else []

        for b in batches:
            out = []
            keys = zip(*(b.column(c).to_pylist() for c in ("grp", "salt", "query", "sid", "comp")))
            for (grp, salt, query, sid, comp), toks in zip(keys, _arrays(b.column("toks"))):
                if (grp, salt) != key:
                    out += close()
                    key, members, group = (grp, salt), {}, None
                if not query:
                    members[sid] = (sid, comp, toks)
                    continue
                group = group or Group(list(members.values()), percent)
                met = {}
                for j in group.linked(toks).tolist():
                    if group.comps[j] != comp:
                        met.setdefault(group.comps[j], group.ids[j])
                out += [(sid, other) for other in met.values()]
            yield _links(out)
        yield _links(close())
    return run


def _links(rows: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64())], names=["a", "b"])


def _streamed(rows: DataFrame, fn, schema: str) -> DataFrame:
    """``fn`` along ``rows``, sorted by group, copy of the group, and members before queries."""
    met = rows.repartition(parts(rows.sparkSession), "grp", "salt").sortWithinPartitions("grp", "salt", "query", "sid")
    return met.mapInArrow(fn, schema)


def _cut(heads: DataFrame, sizes: DataFrame, seed: int) -> DataFrame:
    """(grp, sid, n) of rows (key, sid, n): groups by key; those in ``sizes`` (key, k) cut into k by a hash."""
    cut = heads.join(sizes, "key", "left")
    part = F.coalesce(F.pmod(F.xxhash64("sid", F.lit(seed)), F.col("k")), F.lit(0))
    return cut.select(F.xxhash64("key", part.cast("long")).alias("grp"), "sid", "n")


class Sets:
    """Bitmaps and whole sets of classes, the latter read from the texts when asked for."""

    def __init__(self, docs: DataFrame, classes: DataFrame, shingle: int, percent: int):
        self.docs, self.classes, self.shingle, self.percent = docs, classes, shingle, percent

    def whole(self, sids: DataFrame) -> DataFrame:
        """(sid, toks) of the classes ``sids``."""
        wanted = stored(self.classes.select("sid", "who.doc", "who.th").join(_sized(stored(sids.distinct(), "asked")), "sid", "left_semi"), "wanted")
        texts = self.docs.select("doc", "th", "text").join(_sized(wanted), ["doc", "th"])
        return stored(texts.select("sid", "text").mapInArrow(_whole_sets(self.shingle), "sid long, toks array<long>"), "sets")

    def links(self, rows: DataFrame, label: str) -> DataFrame:
        """Links of the groups in ``rows`` (grp, salt, query, sid, comp): bitmaps first, then sets."""
        columns = ["grp", "salt", "query", "sid", "comp"]
        given = rows.select(*columns).join(self.classes.select("sid", "n", "bits"), "sid").select(*columns, "n", "bits")
        left = stored(_streamed(given, _screen(self.percent), "grp long, salt int, query boolean, sid long, comp long"), "left")
        opened = left.join(self.whole(left.select("sid")), "sid").select(*columns, "toks")
        return stored(_streamed(opened, _open(self.percent), "a long, b long"), label)

    def within(self, groups: DataFrame, label: str) -> DataFrame:
        """Links that span what every group (grp, sid) holds."""
        many = stored(groups.groupBy("grp").count().where("count > 1").select("grp"), "open-groups")
        members = groups.join(many, "grp").select("grp", F.lit(0).alias("salt"), F.lit(False).alias("query"), "sid", F.lit(0).cast("long").alias("comp"))
        return self.links(members, label)


def _sized(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _components(rows: DataFrame, links: DataFrame) -> DataFrame:
    """``rows`` with the component ``comp`` of each ``sid`` under ``links``."""
    roots = connected_components(links).select(F.col("node").alias("sid"), "root")
    return rows.join(stored(roots, "roots"), "sid", "left").withColumn("comp", F.coalesce("root", "sid")).drop("root")


def jaccard_components(documents: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every document; the component's name is the
    smallest ``doc_id`` reachable over links of at least ``percent`` hundredths."""
    spark = documents.sparkSession
    docs = doc_texts(documents).select("doc_id", F.coalesce("doc_id", F.lit(-(1 << 63))).alias("doc"), F.xxhash64("text").alias("th"), "text")
    levels = spark.sparkContext.broadcast(token_levels(docs, shingle))
    rows = stored(docs.mapInArrow(_prefixes(levels, shingle, percent),
                                  "doc_id long, doc long, th long, n long, sid long, bits binary, prefix array<long>"), "prefixes")

    who = F.struct("doc", "th")
    one = F.min_by(F.struct("n", "bits", "prefix"), who).alias("one")
    classes = rows.where("sid IS NOT NULL").groupBy("sid").agg(F.min("doc_id").alias("first_doc"), F.min(who).alias("who"), one)
    classes = stored(classes.select("sid", "first_doc", "who", "one.*"), "classes")
    each = classes.select("sid", "n", F.posexplode("prefix").alias("pos", "token"))
    # a class holds a token once, so the count is that of classes
    mixed = each.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
    active = stored(each.join(_sized(stored(mixed, "mixed-tokens")), "token"), "active")
    heads = stored(active.groupBy("sid").agg(F.max("n").alias("n"), F.max_by("token", F.struct("df", "token")).alias("key")), "heads")
    sets = Sets(docs, classes, shingle, percent)

    sizes = heads.groupBy("key").agg(F.ceil(F.greatest(F.count("*") / GROUP, F.sum("n") / GROUP_TOKENS)).alias("k"))
    sizes = stored(sizes.where("k > 1"), "group-sizes")
    groups = stored(_cut(heads, sizes, 0), "groups")
    links = sets.within(groups.select("grp", "sid"), "links-within")
    again = heads.join(sizes.select("key"), "key", "left_semi")
    links = links.unionByName(sets.within(_cut(again, sizes, 1).select("grp", "sid"), "links-again"))
    labels = stored(_components(groups, links), "labels")

    # the matrix, of tokens that still join different components
    known = active.drop("df").join(labels.select("sid", "grp", "comp"), "sid")
    open_tokens = known.groupBy("token").agg(F.min("comp").alias("a"), F.max("comp").alias("b")).where("a < b").select("token")
    known = stored(known.join(_sized(stored(open_tokens, "open-tokens")), "token", "left_semi"), "queries")
    # under its index prefix a set is found by sets that are no smaller
    found = known.where(f"pos <= n - (2 * {percent} * n + {99 + percent}) div {100 + percent}")
    matrix = stored(found.groupBy("token", "grp").agg(F.min("n").alias("least"), F.max("n").alias("most"), F.min("comp").alias("c0"), F.max("comp").alias("c1")), "matrix")
    asks = known.join(matrix.withColumnRenamed("grp", "other"), "token").where(
        f"grp <> other AND least <= n AND 100 * most >= {percent} * n AND NOT (c0 = comp AND c1 = comp)")
    asks = stored(asks.select(F.col("other").alias("grp"), "sid", "comp").distinct(), "asks")

    shares = stored(asks.groupBy("grp").agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("k")), "shares")
    queries = asks.join(shares, "grp").select("grp", F.pmod(F.xxhash64("sid", F.lit("salt")), F.col("k")).cast("int").alias("salt"), F.lit(True).alias("query"), "sid", "comp")
    members = labels.join(shares, "grp").select("grp", F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("salt"), F.lit(False).alias("query"), "sid", "comp")
    links = links.unionByName(sets.links(queries.unionByName(members), "links-across"))

    final = _components(classes.select("sid", "first_doc"), links)
    final = stored(final, "final")
    names = stored(final.groupBy("comp").agg(F.min("first_doc").alias("component_id")), "names")
    by_sid = stored(final.join(names, "comp").select("sid", "component_id"), "component-of")
    out = rows.select("doc_id", "n", "sid").join(by_sid, "sid", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("sid").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
