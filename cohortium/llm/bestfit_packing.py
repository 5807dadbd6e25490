"""Best-fit packing of tokenised documents by hierarchical residual packing.

Documents become token ids plus an end id; longer ones are cut so that only
their first piece is shorter than the capacity. A piece of full capacity is a
sequence of its own. The others are dealt at random over shards, each shard
packs best-fit (longest first), nearly full bins are final, and underfull bins
go up a tree as rigid items: eight sibling shards meet, best-fit again, until
one shard is left. Only piece lengths travel, never tokens.

A shard hands up at most ``carry`` bins, those with most room left (best-fit
leaves at most one bin per shard that is half empty, so more could hardly be
merged); the others are final as they are. Nothing is dropped.

Edge cases: NULL and empty texts are one piece holding the end id alone; a
NULL ``doc_id`` is kept; repeated rows are packed once per row; an empty table
gives no rows; other columns are ignored. Ties are broken by the row id.
"""

from __future__ import annotations

import zlib
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortium.llm.common import doc_texts, give_back, lean, stored

CAPACITY = 1024
END_ID = 2
SHARD_ITEMS = 20_000
FAN_IN = 8
CARRY = 4096
SLACK = 16
# what a worker has in hand at once (16 to 39 bytes a character were measured), not a limit on texts: a longer one goes whole
BATCH_CHARS = 2_000_000
# fixed value: how byte-level BPE vocabularies of this family split a text before merging
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_PACKED = "item long, bin long, at long, fill long, up boolean"


class Tokens:
    """Token ids of whole batches of texts, by a byte-level BPE file.

    A byte-level BPE never merges across a single space between two other
    characters. Texts are cut there, each distinct piece of a batch is encoded
    once (all in one call; token lengths tell where each ends), and the texts are
    put together from the pieces. Texts with other spacing, or with an added token of the
    file spelt out, are encoded whole.
    """

    def __init__(self, path: str):
        import json

        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        if spec["model"]["type"] != "BPE" or spec["pre_tokenizer"]["type"] != "ByteLevel" or spec.get("normalizer"):
            raise ValueError(f"{path} is not a byte-level BPE")
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError(f"{path}: added tokens that take in their neighbours")
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        # the printable stand-ins that a byte-level vocabulary has for bytes
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte = {chr(b): b for b in plain}
        byte |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
        ranks = {bytes(byte[c] for c in name): i for name, i in spec["model"]["vocab"].items() if name not in self.added}
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        ids = [spec["model"]["vocab"]["".join(m)] for m in merges]
        if ids != sorted(ids):
            raise ValueError(f"{path}: ids don't follow the merges")
        self.bpe = tiktoken.Encoding("own", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=self.added)
        self.sizes = np.zeros(max(ranks.values()) + 1, "i8")
        for name, i in ranks.items():
            self.sizes[i] = len(name)

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text; where it holds an added token, that one's id, as the file's own library gives it."""
        return np.array(self.bpe.encode(text, allowed_special="all") if self._added(text) else self.bpe.encode_ordinary(text), "u4")

    def _added(self, text: str) -> bool:
        return any(t in text for t in self.added)

    def batch(self, texts: list[str], end: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order, each text followed by ``end``, and where each text begins."""
        whole = [_odd(t) or self._added(t) for t in texts]
        cut = pc.split_pattern(pa.array(["" if odd else t for t, odd in zip(texts, whole)], pa.string()), " ")
        starts = np.asarray(cut.offsets)
        coded = cut.values.dictionary_encode()
        index = np.asarray(coded.indices).astype("i8")
        pieces = coded.dictionary
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(pieces)], pa.int32()), pieces), " ")[0].as_py()
        ids = self.encode(" " + joined) if len(pieces) else np.zeros(0, "u4")
        at = np.concatenate([[0], np.cumsum(self.sizes[ids])])
        ends = np.cumsum(np.asarray(pc.binary_length(pieces)).astype("i8") + 1)
        stops = np.searchsorted(at, ends)
        if (at[stops] != ends).any():
            raise ValueError("a token crosses a cut")
        # the first piece of a text has no space before it; a text that isn't cut is one piece
        firsts = [self.encode(t if odd else t.partition(" ")[0]) for t, odd in zip(texts, whole)]
        index[starts[:-1]] = len(pieces) + np.arange(len(texts))
        index = np.insert(index, starts[1:], len(pieces) + len(texts))
        sizes = np.concatenate([np.diff(stops, prepend=0), [len(x) for x in firsts], [1]]).astype("i8")
        lists = pa.LargeListArray.from_arrays(np.concatenate([[0], np.cumsum(sizes)]),
                                              np.concatenate([ids, *firsts, np.array([end], "u4")]))
        flat = np.asarray(lists.take(pa.array(index)).flatten())
        before = np.concatenate([[0], np.cumsum(sizes[index])])
        return flat, before[np.concatenate([[0], starts[1:] + np.arange(1, len(texts) + 1)])]


def _odd(text: str) -> bool:
    return (not text or "  " in text or " \n" in text or "\n " in text or text[0] == " " or text[-1] == " "
            or not text.replace("\n", "").isprintable())


_tokens: dict[str, Tokens] = {}


def _tokenizer(path: str) -> Tokens:
    """One per Python worker, which serves many tasks."""
    if path not in _tokens:
        _tokens[path] = Tokens(path)
    return _tokens[path]


def _slices(docs: pa.Array, texts: pa.Array):
    """Slices of a batch of at most ``BATCH_CHARS`` characters, or one text; only Arrow holds the others."""
    at = size = 0
    for i, n in enumerate(pc.fill_null(pc.utf8_length(texts), 0).to_pylist()):
        if size and size + n > BATCH_CHARS:
            yield docs[at:i], texts[at:i]
            at, size = i, 0
        size += n
    if at < len(texts):
        yield docs[at:], texts[at:]


def _pieces(path: str, capacity: int, keep_ids: bool):
    kinds = {"doc_id": pa.int64(), "piece": pa.int32(), "start": pa.int64(), "length": pa.int64(),
             "ids_crc32": pa.int64()} | ({"ids": pa.list_(pa.int32())} if keep_ids else {})

    def cut(tokens, docs, texts):
        flat, bounds = tokens.batch([t or "" for t in texts.to_pylist()], END_ID)
        raw = memoryview(flat.astype("<u4").tobytes())
        rows = []
        for doc, first, last in zip(docs.to_pylist(), bounds[:-1].tolist(), bounds[1:].tolist()):
            at, size, k = first, (last - first - 1) % capacity + 1, 0
            while at < last:
                row = (doc, k, at - first, size, zlib.crc32(raw[4 * at:4 * (at + size)]))
                rows.append((*row, flat[at:at + size].astype("i4")) if keep_ids else row)
                at, size, k = at + size, capacity, k + 1
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds.values())], names=list(kinds))

    def run(batches):
        tokens = _tokenizer(path)
        for b in batches:
            for docs, texts in _slices(b.column("doc_id"), b.column("text")):
                yield cut(tokens, docs, texts)
                give_back()
    return lean(run)


def tokenized_pieces(documents: DataFrame, tokenizer: str, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """One row per piece, stored once (tokenising is the costly part)."""
    schema = PIECES + (", ids array<int>" if keep_ids else "")
    found = doc_texts(documents).mapInArrow(_pieces(tokenizer, capacity, keep_ids), schema)
    return stored(found.withColumn("uid", F.monotonically_increasing_id()), "pieces")


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Best-fit, longest first: bin and place of each item, and the fill of each bin.

    Open bins are kept by their free room; bit r of ``rooms`` says that a bin
    with r tokens of room is open.
    """
    order = np.argsort(-sizes, kind="stable")
    bins, places = np.empty(len(sizes), "i8"), np.empty(len(sizes), "i8")
    fills: list[int] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0
    for i, size in zip(order.tolist(), sizes[order].tolist()):
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
        else:
            b, room = len(fills), capacity
            fills.append(0)
        bins[i], places[i] = b, fills[b]
        fills[b] += size
        left = room - size
        if left:
            by_room[left].append(b)
            rooms |= 1 << left
    return bins, places, fills


def _pack_shard(level: int, capacity: int, slack: int, carry: int, last: bool):
    def run(key: tuple[Any, ...], items: pd.DataFrame) -> pd.DataFrame:
        items = items.sort_values(["size", "item"], ascending=[False, True], ignore_index=True)
        bins, places, fills = best_fit(items["size"].to_numpy(), capacity)
        fill = np.asarray(fills, "i8")
        up = np.zeros(len(fill), bool)
        if not last:
            under = np.flatnonzero(fill < capacity - slack)
            up[under[np.argsort(fill[under], kind="stable")[:carry]]] = True
        first = (level << 56) + (int(key[0]) << 28)
        return pd.DataFrame({"item": items["item"], "bin": first + bins, "at": places, "fill": fill[bins], "up": up[bins]})
    return run


def pack(pieces: DataFrame, capacity: int = CAPACITY, shard_items: int = SHARD_ITEMS, fan_in: int = FAN_IN,
         carry: int = CARRY, slack: int = SLACK) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to the pieces (``uid`` names a row)."""
    short = pieces.where(F.col("length") < capacity).select(F.col("uid").alias("item"), F.col("length").alias("size"))
    shards = max(1, -(-short.count() // shard_items))
    items = short.withColumn("shard", F.pmod(F.xxhash64("item"), F.lit(shards)))
    levels = []
    while True:
        level = len(levels)
        packed = stored(items.groupBy("shard").applyInPandas(_pack_shard(level, capacity, slack, carry, shards == 1), _PACKED),
                        f"bins{level}")
        levels.append(packed)
        if shards == 1:
            break
        under = packed.where("up").groupBy(F.col("bin").alias("item")).agg(F.max("fill").alias("size"))
        shard = F.shiftright(F.col("item"), 28).bitwiseAND(F.lit((1 << 28) - 1))
        items = under.withColumn("shard", F.floor(shard / fan_in))
        shards = -(-shards // fan_in)
    top = levels[-1].select("item", F.col("bin").alias("sequence_id"), "at")
    for lower in reversed(levels[:-1]):
        above = top.select(F.col("item").alias("bin"), F.col("sequence_id").alias("_seq"), F.col("at").alias("_at"))
        top = lower.join(above, "bin", "left").select(
            "item", F.coalesce("_seq", "bin").alias("sequence_id"), (F.col("at") + F.coalesce("_at", F.lit(0))).alias("at"))
    whole = pieces.where(F.col("length") >= capacity).withColumns(
        {"sequence_id": -F.col("uid") - 1, "offset": F.lit(0).cast("long")})
    placed = pieces.where(F.col("length") < capacity).join(top.withColumnRenamed("item", "uid"), "uid").withColumnRenamed("at", "offset")
    return whole.unionByName(placed).drop("uid")


def pack_documents(documents: DataFrame, tokenizer: str, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    return pack(tokenized_pieces(documents, tokenizer, capacity, keep_ids), capacity)
