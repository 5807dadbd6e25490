"""SimHash near-duplicates found through one-wildcard segment variants.

A 64-bit SimHash over word shingles is cut into two 32-bit halves: if two
fingerprints differ in at most two bits, one half differs in at most one. Each
distinct fingerprint is therefore indexed under 64 keys, each half with one bit
wildcarded; equal keys meet, and the whole fingerprints are compared. A bucket
gives the links of a spanning forest of its verified pairs, not all pairs.

A bucket of more than ``BUCKET`` distinct fingerprints is not compared pair by
pair: its members go by their variants with two of all 64 bits wildcarded. Any
two fingerprints of such a group differ in at most those two bits, so a link
to the group's smallest member is exact, and no pair is missed.

Edge cases: NULL and blank texts have fingerprint zero, linked like any other;
fewer words than the shingle length make one shingle; a NULL ``doc_id`` belongs
to a group but never names it; repeated rows share their class; other columns
are ignored (``keep_one_per_group`` keeps them), whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortium.llm.common import doc_texts, lean, packed_rows, parts, stored
from cohortium.llm.components import connected_components

SHINGLE = 3
SEED = 42
MAX_BITS = 2
BUCKET = 1024
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def simhash(text: str | None, shingle: int = SHINGLE) -> int:
    """Signed 64-bit SimHash of the A-Z lower-cased, white-space separated words."""
    words = (text or "").encode("utf-8").translate(LOWER).split()
    if not words:
        return 0
    line = b" ".join(words)
    sizes = np.fromiter(map(len, words), "i8", len(words))
    ends = np.cumsum(sizes + 1) - 1
    k = min(shingle, len(words))
    starts = (ends - sizes)[:len(words) - k + 1].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = [digest(line[a:b], SEED) for a, b in zip(starts, ends[k - 1:].tolist())]
    ones = np.zeros(64, "i8")
    for at in range(0, len(hashes), 1 << 16):
        part = np.array(hashes[at:at + (1 << 16)], ">u8").view("u1").reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype="i8")
    return int(np.packbits(2 * ones > len(hashes)).view(">i8")[0])


def _simhashes(shingle: int):
    def run(batches):
        for b in batches:
            fps = [simhash(t, shingle) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("th"), pa.array(fps, pa.int64())], names=["doc_id", "th", "fp"])
    return run


def _bits(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x.astype("u8"))


def _forest(fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (member, smallest member) of the components within one bucket."""
    near = _bits(fps[:, None] ^ fps[None, :]) <= max_bits
    label = np.arange(len(fps))
    while True:
        now = np.where(near, label[None, :], len(fps)).min(axis=1)
        now = now[now]
        if (now == label).all():
            break
        label = now
    rest = label != np.arange(len(fps))
    return fps[rest], fps[label[rest]]


def _verify(max_bits: int, bucket: int):
    """Along rows sorted by key: links of each bucket; members of a large one as (fp, NULL)."""
    def run(batches):
        key, held, large = None, [], False

        def close():
            if held and not large:
                fps = np.unique(np.concatenate(held))
                if len(fps) > 1:
                    a, b = _forest(fps, max_bits)
                    if len(a):
                        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        def hot(fps):
            return pa.RecordBatch.from_arrays([pa.array(fps), pa.nulls(len(fps), pa.int64())], names=["a", "b"])

        for batch in batches:
            keys, fps = np.asarray(batch.column("key")), np.asarray(batch.column("fp"))
            if not len(keys):
                continue
            cuts = np.flatnonzero(np.diff(keys)) + 1
            starts, ends = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(keys)]])
            # a bucket of one row within the batch links nothing
            keep = (ends - starts > 1) | (starts == 0) | (ends == len(keys))
            for s, e in zip(starts[keep].tolist(), ends[keep].tolist()):
                if keys[s] != key:
                    yield from close()
                    key, held, large = keys[s], [], False
                if large:
                    yield hot(fps[s:e])
                    continue
                held.append(fps[s:e])
                if sum(map(len, held)) > bucket:
                    yield hot(np.concatenate(held))
                    held, large = [], True
        yield from close()
    return run


def fingerprint_links(fps: DataFrame, max_bits: int = MAX_BITS, bucket: int = BUCKET) -> DataFrame:
    """Links ``(a, b)`` that connect all distinct ``fp`` within ``max_bits`` = 2 bits."""
    if max_bits != 2:
        raise ValueError("two segments with one wildcard serve exactly two differing bits")
    spark = fps.sparkSession
    # 64 keys: (half, wildcarded bit, the half without that bit)
    half = F.when(F.col("w") < 32, F.shiftrightunsigned("fp", 32)).otherwise(F.col("fp")).bitwiseAND(F.lit(0xFFFFFFFF))
    clear = F.bitwise_not(F.expr("shiftleft(1L, cast(w % 32 as int))"))
    keys = (fps.withColumn("w", F.explode(F.sequence(F.lit(0), F.lit(63))))
            .select(F.shiftleft(F.col("w").cast("long"), 32).bitwiseOR(half.bitwiseAND(clear)).alias("key"), "fp"))
    met = keys.repartition(parts(spark), "key").sortWithinPartitions("key")
    found = stored(met.mapInArrow(lean(_verify(max_bits, bucket)), "a long, b long"), "simhash-links")
    links = found.where("b IS NOT NULL").distinct()
    hot = found.where("b IS NULL").select(F.col("a").alias("fp")).distinct()
    pairs = F.expr("transform(filter(sequence(0, 4095), x -> x div 64 < x % 64), "
                   "x -> shiftleft(1L, cast(x div 64 as int)) | shiftleft(1L, cast(x % 64 as int)))")
    masks = hot.withColumn("mask", F.explode(pairs))
    group = [F.col("mask"), F.col("fp").bitwiseAND(F.bitwise_not(F.col("mask"))).alias("rest")]
    cliques = masks.select(*group, "fp")
    least = cliques.groupBy("mask", "rest").agg(F.min("fp").alias("b"), F.count("*").alias("n")).where("n > 1")
    stars = (cliques.join(least, ["mask", "rest"]).where("fp <> b").select(F.col("fp").alias("a"), "b"))
    return links.unionByName(stars).distinct()


def _classified(documents: DataFrame, shingle: int, max_bits: int) -> DataFrame:
    """(doc_id, th, fp, leader) of every row; ``leader`` is the smallest (doc_id, th) of its group, ``th`` a hash of the text."""
    given = doc_texts(documents).select("doc_id", F.xxhash64("text").alias("th"), "text")
    docs = stored(given.mapInArrow(lean(_simhashes(shingle)), "doc_id long, th long, fp long"), "simhash")
    fps = docs.groupBy("fp").agg(F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "th"))).alias("first"))
    roots = connected_components(fingerprint_links(fps.select("fp"), max_bits))
    classes = (fps.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
               .select("fp", "first", F.coalesce("root", "fp").alias("root")))
    classes = stored(classes, "simhash-classes")
    leaders = stored(classes.groupBy("root").agg(F.min("first").alias("leader")), "simhash-leaders")
    by_fp = stored(classes.join(leaders, "root").select("fp", "leader"), "simhash-by-print")
    return docs.join(by_fp, "fp")


def near_duplicates(documents: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id``, the
    smallest id reachable over links of at most ``max_bits`` differing bits."""
    found = _classified(documents, shingle, max_bits)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("leader.doc_id").alias("component_id"))


def keep_one_per_group(documents: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One document of each group, that of the smallest id, with all its columns.

    Of an id with several texts only the one that leads its group stays. Rows without
    an id are kept (nothing can name them). Of rows that agree in id and text one stays,
    that of the smallest hash of all columns.
    """
    found = _classified(documents, shingle, max_bits)
    leads = (F.col("doc_id") == F.col("leader.doc_id")) & F.col("th").eqNullSafe(F.col("leader.th"))
    kept = stored(found.where(leads).groupBy(F.col("doc_id").alias("doc"), "th").agg(F.count("*").alias("copies")), "simhash-kept")
    keyed = packed_rows(documents).select("row", F.col("row.doc_id").cast("long").alias("doc"), F.xxhash64(F.col("row.text").cast("string")).alias("th"))
    named = keyed.join(kept, ["doc", "th"])
    once = named.where("copies = 1").select("row")
    # only rows that are there several times are compared as a whole
    several = named.where("copies > 1").groupBy("doc", "th").agg(F.min_by("row", F.xxhash64(F.to_json("row"))).alias("row")).select("row")
    return once.unionByName(several).unionByName(keyed.where("doc IS NULL").select("row")).select("row.*")
