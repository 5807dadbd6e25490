"""Benchmark decontamination by winnowing, in DataFrame operations only.

Both sides are words (A-Z lower-cased runs of letters, digits and non-ASCII
characters). Hashes of ``GRAM`` consecutive words are winnowed: of every
``WINDOW - GRAM + 1`` neighbouring hashes the smallest (rightmost on ties) is
kept, so any ``WINDOW`` words that a document and an item share give both the
same fingerprint. Fingerprints are joined, each hit is an alignment of a
document with an item, and every alignment is extended over the whole item by
comparing the words themselves; runs of at least ``WINDOW`` equal words count.
Items of fewer words are one window: their documents are found by the hash of
as many words, and extended the same way.

The benchmark's fingerprints, and the keys (two numbers) of the documents that are
hit, are broadcast up to ``BROADCAST_ROWS`` rows; beyond that the joins shuffle both
sides. Documents of more than ``CHUNK``
words are hashed in chunks that overlap by a window, and the alignments of a document are
extended a block of ``BLOCK`` words at a time, each with only the words it may reach, so
memory is bounded and the work on periodic text grows with its length.

Edge cases: NULL and blank texts have no words and no hits; an item without
words or id never hits; repeated items count once; repeated documents each get
their row; a NULL ``doc_id`` is kept; other columns are ignored, whatever their names
(``drop_contaminated`` keeps them as they are).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortium.llm.common import doc_texts, packed_rows, stored, text_key

WINDOW = 10
GRAM = 5
CHUNK = 20_000
BLOCK = 4096
BROADCAST_ROWS = 200_000
BREAKS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _split(text: Column) -> Column:
    """Words as they are spelt: capitals are letters here, as if lower-cased."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BREAKS), "")


def exact_words(text: Column) -> Column:
    return _split(F.translate(text, UPPER, LOWER))


def word_hashes(text: Column) -> Column:
    """A hash for each of ``exact_words``, in the same places. ``lower`` is many times
    faster than ``translate``. It is taken of each word by itself, as the lower case of a
    letter may depend on its neighbours (a final sigma does), so equal words have equal
    hashes; it may also equate words that differ in a non-ASCII capital, which extension
    tells apart."""
    return F.transform(_split(text), lambda w: F.xxhash64(F.lower(w)))


def _grams(texts: DataFrame, key: list[str], behind: int, ahead: int) -> DataFrame:
    """A row per word position: ``pos`` and the word hashes ``h0..`` of the next
    ``ahead`` words, with ``behind`` (0 or 1) words before them. NULL past the ends."""
    x = texts.select(*key, word_hashes(F.col("text")).alias("_h"))
    x = x.withColumn("_at", F.explode(F.sequence(F.lit(0), F.greatest(F.size("_h") - 1, F.lit(0)), F.lit(CHUNK))))
    # chunk: its own positions and the ``ahead - 1`` words after them
    chunk = F.slice("_h", F.col("_at") + 1, F.lit(CHUNK + ahead - 1))
    x = x.select(*key, "_at", chunk.alias("_h"))
    first = F.array(F.lit(None).cast("long"))
    lag = F.concat(first, F.col("_h"))
    shifted = ([lag.alias("p")] if behind else []) + [F.slice("_h", i + 1, F.lit(CHUNK + ahead)).alias(f"h{i}") for i in range(ahead)]
    names = (["p"] if behind else []) + [f"h{i}" for i in range(ahead)]
    z = F.arrays_zip(*shifted)
    x = x.select(*key, "_at", F.posexplode(z).alias("_i", "_z"))
    x = x.where((F.col("_i") < CHUNK) & F.col(f"_z.{names[-1]}").isNotNull())
    return x.select(*key, (F.col("_at") + F.col("_i")).alias("pos"), *(F.col(f"_z.{n}").alias(n) for n in names))


def winnow(texts: DataFrame, key: list[str], window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``fp`` and ``pos`` (word index) of the kept k-gram hashes of each text."""
    n = window - gram + 1
    rows = _grams(texts, key, 1, window)
    words = ["p", *(f"h{i}" for i in range(window))]
    hashes = {f"g{i}": F.xxhash64(*words[i:i + gram]) for i in range(n + 1)}
    rows = _computed(rows.select(*key, "pos", "p", *words[1:]), [*key, "pos", "p"], hashes)

    # the low bits hold how far from the window's end the gram stands: ties go to the right
    def smallest(first: int) -> Column:
        return F.least(*(F.col(f"g{first + j}").bitwiseAND(F.lit(~15)).bitwiseOR(F.lit(n - 1 - j)) for j in range(n)))

    rows = _computed(rows, [*key, "pos", "p"], {"m": smallest(1), "before": smallest(0)})
    place = F.col("m").bitwiseAND(F.lit(15))
    # a gram is one place further from the end of the window before
    moved = place != F.col("before").bitwiseAND(F.lit(15)) + 1
    other = F.col("m").bitwiseAND(F.lit(~15)) != F.col("before").bitwiseAND(F.lit(~15))
    rows = rows.where(F.col("p").isNull() | moved | other)
    return rows.select(*key, (F.col("pos") + (n - 1) - place).cast("int").alias("pos"),
                       F.col("m").bitwiseAND(F.lit(~15)).alias("fp"))


def _computed(rows: DataFrame, keep: list[str], new: dict[str, Column]) -> DataFrame:
    """``keep`` and the ``new`` columns, each computed once per row.

    The one-row ``inline`` keeps the optimiser from copying the expressions into
    every later use (a filter would repeat all hashes several times).
    """
    return rows.select(*keep, F.inline(F.array(F.struct(*(c.alias(n) for n, c in new.items())))).alias(*new))


def _whole(texts: DataFrame, key: list[str], n: int) -> DataFrame:
    """Hash of every ``n`` consecutive words."""
    rows = _grams(texts, key, 0, n)
    return rows.select(*key, F.col("pos").cast("int").alias("pos"), F.xxhash64(*(f"h{i}" for i in range(n))).alias("fp"))


def _sized(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if df.count() <= rows else df


def _mask(equal: Column, least: Column) -> Column:
    """Of a text of 0 and 1, the runs of at least ``least`` ones."""
    return F.array_join(F.transform(F.split(equal, "0", -1), lambda r: F.when(F.length(r) >= least, r)
                                    .otherwise(F.translate(r, "1", "0"))), "0")


def occurrences(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM) -> tuple[DataFrame, DataFrame]:
    """(documents keyed by ``doc`` and ``th``, alignments that hold a hit).

    An alignment row has the item, the document word at which it starts, and a
    ``mask`` with 1 for each word within a hit.
    """
    docs = doc_texts(documents).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.select(F.coalesce("doc_id", F.lit(-(1 << 63))).alias("doc"), F.xxhash64("text").alias("th"), "doc_id", "text")
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("string").alias("text"))
    items = items.where("item IS NOT NULL").withColumn("words", exact_words(F.col("text"))).withColumn("n", F.size("words")).where("n > 0")
    items = stored(items.select("item", F.xxhash64("text").alias("ith"), "text", "words", "n").distinct(), "items")
    key, ikey = ["doc", "th"], ["item", "ith", "n"]
    test = winnow(items.where(F.col("n") >= window), ikey, window, gram).withColumnRenamed("pos", "q")
    hits = winnow(docs, key, window, gram).join(_sized(stored(test, "item-prints"), BROADCAST_ROWS), "fp")
    hits = hits.select(*key, *ikey, (F.col("pos") - F.col("q")).alias("delta"))
    for (n,) in items.where(F.col("n") < window).select("n").distinct().collect():  # at most window - 1 lengths
        short = _whole(items.where(F.col("n") == n), ikey, n).drop("pos")
        found = _whole(docs, key, n).join(_sized(short, BROADCAST_ROWS), "fp")
        hits = hits.unionByName(found.select(*key, *ikey, F.col("pos").alias("delta")))
    hits = stored(hits.distinct(), "hits")
    # few documents are hit: their keys filter the texts before any text is shuffled
    near = docs.select(*key, "text").join(_sized(stored(hits.select(*key).distinct(), "hit-keys"), BROADCAST_ROWS), key, "left_semi")
    longest = items.agg(F.max("n")).first()[0] or 0
    near = near.select(*key, exact_words(F.col("text")).alias("words"))
    # a row per block: its own words and as many more as an item may reach
    blocks = F.transform(F.sequence(F.lit(0), F.greatest(F.size("words") - 1, F.lit(0)), F.lit(BLOCK)), lambda b: F.struct(
        b.alias("first"), F.slice("words", b + 1, F.lit(BLOCK + longest)).alias("words"), F.size("words").alias("size")))
    near = near.select(*key, F.explode(blocks).alias("block")).select(*key, "block.*").dropDuplicates([*key, "first"])
    start = F.greatest(F.col("delta"), F.lit(0))
    at = hits.withColumn("first", start - start % BLOCK).groupBy(*key, "first").agg(F.collect_list(F.struct(*ikey, "delta")).alias("at"))
    near = near.join(at.hint("merge"), [*key, "first"])

    def part(a: Column) -> Column:
        """An alignment with the document's words that stand against the item's."""
        low = F.greatest(F.lit(0), -a["delta"])
        size = F.least(a["n"], F.col("size") - a["delta"]) - low
        return F.struct(*(a[c].alias(c) for c in (*ikey, "delta")), low.alias("low"),
                        F.slice("words", a["delta"] + low - F.col("first") + 1, size).alias("part"))

    near = near.select(*key, F.explode(F.transform("at", part)).alias("a")).select(*key, "a.*")
    near = near.join(_sized(items.select("item", "ith", F.col("words").alias("iw")), BROADCAST_ROWS // 20), ["item", "ith"])
    equal = F.array_join(F.zip_with("part", F.slice("iw", F.col("low") + 1, F.size("part")),
                                    lambda a, b: F.when(a == b, F.lit("1")).otherwise(F.lit("0"))), "")
    mask = _mask(equal, F.least(F.col("n"), F.lit(window)))
    found = near.select(*key, "item", (F.col("delta") + F.col("low")).alias("start"), mask.alias("mask")).where(F.instr("mask", "1") > 0)
    return docs, stored(found, "alignments")


def contamination(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Per document: words, words within a hit, the items that occur, and whether any does."""
    docs, found = occurrences(documents, benchmark, window, gram)
    key = ["doc", "th"]
    words = found.select(*key, "start", F.posexplode(F.split("mask", "")).alias("i", "hit")).where("hit = '1'")
    n_hit = words.select(*key, (F.col("start") + F.col("i")).alias("word")).distinct().groupBy(*key).agg(F.count("*").alias("n_hit"))
    items = found.groupBy(*key).agg(F.sort_array(F.collect_set("item")).alias("items"))
    hit = n_hit.join(items, key)
    every = docs.select("doc_id", *key, F.size(_split(F.col("text"))).cast("long").alias("n_words"))
    every = every.join(hit, key, "left")
    none = F.array().cast("array<string>")
    return every.select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                        F.coalesce("items", none).alias("items")).withColumn("contaminated", F.col("n_hit") > 0)


def drop_contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without any hit, all columns kept."""
    _, found = occurrences(documents, benchmark)
    bad = _sized(stored(found.select("doc", "th").distinct(), "bad-keys"), BROADCAST_ROWS)
    keyed = packed_rows(documents).select("row", *text_key())
    return keyed.join(bad, ["doc", "th"], "left_anti").select("row.*")
