"""Language identification with interpolated Kneser-Ney character models.

A model per language value predicts each character of a word (lower-cased runs
of letters, with word ends) from the three before it. Highest-order counts are
raw counts over every training text; lower orders count distinct predecessors.
Counting runs in Spark: tasks count distinct words, then their 4-grams, and the
grams are summed by a shuffle. A gram is then folded into one of
``2**SLOT_BITS`` slots, so a model holds at most 4 x 2**SLOT_BITS entries per
language whatever the corpus; it is kept as sorted slot arrays with log
probabilities and back-off weights and broadcast.

A text gets the language of the lowest cross-entropy per character. It is
rejected if that cross-entropy lies further above the language's usual value
than nearly all training texts (all but ``1 - TOLERANCE`` of them) lie above that of
their own language; the tolerance narrows with the number of characters. The queries
score every document once. The rows that this pass stores hold the training texts'
cross-entropies in their own language too, and the usual values and the limit are
aggregates of all of them.

Edge cases: NULL texts and texts without letters are ``und`` with score 0 and
rejected; NULL ``lang`` rows are never learned from; without training rows all
texts are ``und``; NULL ``doc_id`` rows are scored; repeated rows each get their
row; equal cross-entropies go to the first language in sorted order; other
columns are ignored.
"""

from __future__ import annotations

import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortium.llm.common import lean, stored
from cohortium.operators.selection import few_group_percentiles

ORDER = 4
SLOT_BITS = 22
KEPT_WORDS = 150_000
SLICE = 2_000_000
CHUNK = 1_000_000
TOLERANCE = 0.9995
MARGIN = 1.5
LEAST_OWN = 20
START, END = "\x02", "\x03"
LETTERS = re.compile(r"[^\W\d_]+")
#: bytes of UTF-8: ASCII characters that are no letters lie in no run and become blanks
BLANKED = bytes(x if x >= 128 or chr(x).isalpha() else 32 for x in range(256))


def _runs(piece: str) -> list[str]:
    """Letter runs of a piece; other numerals that count as word characters alone make none."""
    return [w for w in LETTERS.findall(piece) if w.isalpha() or any(map(str.isalpha, w))]


def _slices(texts: pa.Array):
    """Slices of the texts: (first, end, distinct pieces, place of every piece met among them, pieces per text).

    Pieces are what is left of the lower-cased texts between ASCII characters that are no
    letters; empty ones are among them.
    """
    first = size = 0
    for end, n in enumerate(pc.fill_null(pc.binary_length(texts), 0).to_pylist(), 1):
        size += n
        if size < SLICE and end < len(texts):
            continue
        part = texts.slice(first, end - first).to_pylist()
        plain = pa.array([(t or "").lower().encode().translate(BLANKED) for t in part], pa.large_binary()).cast(pa.large_string())
        split = pc.ascii_split_whitespace(plain)
        met = split.flatten().dictionary_encode()
        yield first, end, met.dictionary.to_pylist(), met.indices.to_numpy(), pc.list_value_length(split).to_numpy()
        first, size = end, 0


def _grams(words: dict[str, int]) -> dict[str, int]:
    """Padded highest-order grams of the letter runs of pieces."""
    runs: dict[str, int] = defaultdict(int)
    for piece, n in words.items():
        if piece.isalpha():
            runs[piece] += n
        else:
            for w in _runs(piece):
                runs[w] += n
    out: dict[str, int] = defaultdict(int)
    for w, n in runs.items():
        s = START * (ORDER - 1) + w + END
        for i in range(len(w) + 1):
            out[s[i:i + ORDER]] += n
    return out


def _count(batches):
    """(lang, gram, n), summed within a task as far as memory allows."""
    words: dict[str, dict[str, int]] = defaultdict(lambda: defaultdict(int))

    def flush():
        for lang, c in words.items():
            g = _grams(c)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(g), pa.string()), pa.array(list(g), pa.string()),
                                              pa.array(list(g.values()), pa.int64())], names=["lang", "gram", "n"])
        words.clear()

    for b in batches:
        for lang in pc.unique(b.column("lang")).to_pylist():
            for _, _, pieces, met, _ in _slices(b.column("text").filter(pc.equal(b.column("lang"), lang))):
                counts = words[lang]
                for piece, n in zip(pieces, np.bincount(met, minlength=len(pieces)).tolist()):
                    counts[piece] += n
                if sum(map(len, words.values())) > KEPT_WORDS:
                    yield from flush()
    yield from flush()


def gram_counts(training: DataFrame) -> DataFrame:
    """``lang, gram, n`` over all texts of ``training`` (text and lang not NULL)."""
    rows = training.where("text IS NOT NULL AND lang IS NOT NULL").select("lang", "text")
    return rows.mapInArrow(lean(_count), "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _slot(gram):
    return F.xxhash64(gram).bitwiseAND(F.lit((1 << SLOT_BITS) - 1))


def folded_counts(grams: DataFrame) -> DataFrame:
    """Rows (lang, order, slot, context slot, shorter gram's slot, count), bounded by the slots."""
    levels, now = [], grams.select("lang", F.col("gram").alias("g"), F.col("n").alias("c"))
    for m in range(ORDER, 0, -1):
        levels.append(now.select("lang", F.lit(m).alias("m"), _slot(F.col("g")).alias("slot"),
                                 _slot(F.substring("g", 1, m - 1)).alias("ctx"), _slot(F.expr("substring(g, 2)")).alias("suf"), "c"))
        # continuation counts: distinct predecessors of each shorter gram
        now = now.groupBy("lang", F.expr("substring(g, 2)").alias("g")).agg(F.count("*").alias("c"))
        now = stored(now, f"grams{m - 1}") if m > 1 else now
    every = levels[0]
    for x in levels[1:]:
        every = every.unionByName(x)
    return every.groupBy("lang", "m", "slot").agg(F.min("ctx").alias("ctx"), F.min("suf").alias("suf"), F.sum("c").alias("c"))


class Model:
    """Per language and order: sorted slots, log probabilities; sorted contexts, back-off."""

    def __init__(self, langs: list[str]):
        self.langs = langs
        self.tables: list[list[tuple]] = []
        self.floor: list[float] = []
        self.usual: np.ndarray | None = None
        self.limit = np.inf

    @classmethod
    def of(cls, rows) -> Model:
        model = cls(sorted(set(rows["lang"])))
        alphabet = 1 + max((int(((rows["m"] == 1) & (rows["lang"] == x)).sum()) for x in model.langs), default=0)
        for lang in model.langs:
            own = rows[rows["lang"] == lang]
            tables, lower = [], None
            for m in range(1, ORDER + 1):
                t = own[own["m"] == m].sort_values("slot")
                slot, ctx, suf, c = (t[k].to_numpy() for k in ("slot", "ctx", "suf", "c"))
                n1, n2 = int((c == 1).sum()), int((c == 2).sum())
                discount = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
                ctxs, at = np.unique(ctx, return_inverse=True)
                total = np.bincount(at, c, len(ctxs))
                gamma = discount * np.bincount(at, minlength=len(ctxs)) / total
                if lower is None:
                    below = np.full(len(slot), 1 / alphabet)
                else:
                    i = np.minimum(np.searchsorted(lower[0], suf), len(lower[0]) - 1)
                    below = np.where(lower[0][i] == suf, lower[1][i], 1 / alphabet)
                p = np.maximum(c - discount, 0) / total[at] + gamma[at] * below
                lower = (slot, p)
                tables.append((slot.astype("i4"), np.log(p).astype("f4"), ctxs.astype("i4"), np.log(gamma).astype("f4")))
            model.tables.append(tables)
            model.floor.append(float(np.log(1 / alphabet)))
        return model

    def gram_scores(self, slots: list[np.ndarray], contexts: list[np.ndarray]) -> np.ndarray:
        """Log probability (grams x languages); ``slots[m-1]``: slots of each gram's last m characters."""
        out = np.empty((len(slots[0]), len(self.langs)))
        for k, tables in enumerate(self.tables):
            p = np.full(len(slots[0]), self.floor[k])
            for m, (slot, logp, ctxs, gamma) in enumerate(tables, 1):
                i = np.minimum(np.searchsorted(ctxs, contexts[m - 1]), len(ctxs) - 1)
                p = p + np.where(ctxs[i] == contexts[m - 1], gamma[i], 0.0)
                i = np.minimum(np.searchsorted(slot, slots[m - 1]), len(slot) - 1)
                p = np.where(slot[i] == slots[m - 1], logp[i], p)
            out[:, k] = p
        return out


def _xxhash_slots(grams: list[str]) -> np.ndarray:
    import xxhash

    digest = xxhash.xxh64_intdigest
    return np.array([digest(g, 42) & ((1 << SLOT_BITS) - 1) for g in grams], "i4")


class Scorer:
    """Scores texts by their pieces, whose sums are kept per worker.

    New pieces of a slice of texts are scored together; a full cache is emptied.
    """

    def __init__(self, model: Model):
        self.model = model
        self.at: dict[str, int] = {}
        self.sums = np.empty((KEPT_WORDS, len(model.langs) + 1))
        self.gram_at: dict[str, int] = {}
        self.gram_p = np.empty((KEPT_WORDS, len(model.langs)))

    def _gram_rows(self, grams: list[str]) -> np.ndarray:
        """Scores of the grams, one row each."""
        distinct = dict.fromkeys(grams)
        new = [g for g in distinct if g not in self.gram_at]
        if new:
            if len(self.gram_at) + len(new) > len(self.gram_p):
                self.gram_at = {}
                new = list(distinct)
                if len(new) > len(self.gram_p):
                    self.gram_p = np.empty((2 * len(new), len(self.model.langs)))
            # xxhash64 of Spark and of the library agree (seed 42)
            slots = [_xxhash_slots([g[ORDER - m:] for g in new]) for m in range(1, ORDER + 1)]
            contexts = [_xxhash_slots([g[ORDER - m:-1] for g in new]) for m in range(1, ORDER + 1)]
            first = len(self.gram_at)
            self.gram_at.update((g, first + i) for i, g in enumerate(new))
            self.gram_p[first:first + len(new)] = self.model.gram_scores(slots, contexts)
        return self.gram_p[np.fromiter(map(self.gram_at.__getitem__, grams), "i8", len(grams))]

    def learn(self, pieces: list[str]) -> None:
        new = [p for p in pieces if p not in self.at]
        if not new:
            return
        if len(self.at) + len(new) > len(self.sums):
            self.at = {}
            new = pieces
            if len(new) > len(self.sums):
                self.sums = np.empty((2 * len(new), len(self.model.langs) + 1))
        for i in range(0, len(new), 20_000):
            part = new[i:i + 20_000]
            grams: list[str] = []
            owner: list[int] = []
            for k, piece in enumerate(part):
                for w in ([piece] if piece.isalpha() else _runs(piece)):
                    s = START * (ORDER - 1) + w + END
                    grams += [s[j:j + ORDER] for j in range(len(w) + 1)]
                    owner += [k] * (len(w) + 1)
            sums = np.zeros((len(part), len(self.model.langs) + 1))
            if grams:
                p, own = self._gram_rows(grams), np.array(owner)
                for c in range(p.shape[1]):
                    sums[:, c] = np.bincount(own, p[:, c], len(part))
                sums[:, -1] = np.bincount(own, minlength=len(part))
            first = len(self.at)
            self.at.update((x, first + j) for j, x in enumerate(part))
            self.sums[first:first + len(part)] = sums

    def totals(self, texts: pa.Array) -> np.ndarray:
        """Per text: summed log probability per language, then the number of characters."""
        out = np.zeros((len(texts), len(self.model.langs) + 1))
        for first, end, pieces, met, lengths in _slices(texts):
            self.learn(pieces)
            row = np.fromiter(map(self.at.__getitem__, pieces), "i8", len(pieces))
            owner = np.repeat(np.arange(end - first), lengths)
            for at in range(0, len(met), CHUNK):
                sums, own = self.sums[row[met[at:at + CHUNK]]], owner[at:at + CHUNK]
                for c in range(sums.shape[1]):
                    out[first:end, c] += np.bincount(own, sums[:, c], end - first)
        return out


FOUND = ["lang_pred", "score", "best", "cross_entropy", "n_letters", "own"]
FOUND_TYPES = "lang_pred string, score double, best int, cross_entropy double, n_letters double, own struct<k:int,h:double>"


def _scores(shared, text_at: list[int]):
    """Adds the columns of ``FOUND``. The text lies at the place ``text_at`` (two steps: within
    a struct, which is kept); the last column is the row's own language, to be measured too, or NULL."""
    scorers: list[Scorer] = []

    def run(batches):
        model: Model = shared.value
        if not scorers:
            scorers.append(Scorer(model))
        scorer = scorers[0]
        place = {lang: k for k, lang in enumerate(model.langs)}
        for b in batches:
            text = b.column(text_at[0])
            for i in text_at[1:]:
                text = text.field(i)
            pred, score, best, cross, letters, own = [], [], [], [], [], []
            for total, lang in zip(scorer.totals(text.cast(pa.string())), b.column(b.num_columns - 1).to_pylist()):
                n = total[-1] if place else 0
                letters.append(float(n))
                if not n:
                    pred.append("und"), score.append(0.0), best.append(None), cross.append(None), own.append(None)
                    continue
                h = -total[:-1] / n
                k = int(h.argmin())
                pred.append(model.langs[k])
                # posterior of the language, with characters weighed as at most 64 independent ones
                score.append(float(1 / np.exp(-(h - h[k]) * min(n, 64)).sum()))
                best.append(k)
                cross.append(float(h[k]))
                own.append({"k": place[lang], "h": float(h[place[lang]])} if lang in place else None)
            found = [pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(best, pa.int32()), pa.array(cross, pa.float64()),
                     pa.array(letters, pa.float64()), pa.array(own, pa.struct([("k", pa.int32()), ("h", pa.float64())]))]
            keep = [i for i in range(b.num_columns - 1) if [i] != text_at]
            yield pa.RecordBatch.from_arrays([b.column(i) for i in keep] + found, names=[b.schema.names[i] for i in keep] + FOUND)
    return run


def _scored(documents: DataFrame, model: Model, keep: list[str], own: Column | None = None) -> DataFrame:
    """``keep`` columns and those of ``FOUND``; ``own`` is a language that the row is measured in too."""
    own = F.lit(None).cast("string") if own is None else own
    x = documents.select(*keep, F.col("text").cast("string").alias("text"), own.alias("_own"))
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in x.schema.fields[:-2])
    shared = documents.sparkSession.sparkContext.broadcast(model)
    return x.mapInArrow(lean(_scores(shared, [len(keep)])), schema + FOUND_TYPES)


def _scored_rows(documents: DataFrame, model: Model, own: Column | None = None) -> DataFrame:
    """Whole rows as the struct ``row`` (no name inside can clash), and the columns of ``FOUND``."""
    own = F.lit(None).cast("string") if own is None else own
    x = documents.select(F.struct(*(F.col(f"`{c}`") for c in documents.columns)).alias("row"), own.alias("_own"))
    schema = T.StructType([T.StructField("row", documents.schema), *T.StructType.fromDDL(FOUND_TYPES).fields])
    shared = documents.sparkSession.sparkContext.broadcast(model)
    return x.mapInArrow(lean(_scores(shared, [0, documents.columns.index("text")])), schema)


def _excess(model: Model, k: Column, h: Column, n: Column) -> Column:
    """Cross-entropy above the language's usual one, in units that shrink with length."""
    mean, wide, noise = (F.get(F.array(*(F.lit(float(v)) for v in model.usual[:, i])), k) for i in range(3))
    return (h - mean) / F.sqrt(wide * wide + noise * noise / F.greatest(n, F.lit(1.0)))


def _rejected(model: Model) -> Column:
    """From the columns of ``FOUND``: without letters, or too far from every language."""
    none = F.col("best").isNull()
    if model.usual is None:
        return none
    return none | (_excess(model, F.col("best"), F.col("cross_entropy"), F.col("n_letters")) > F.lit(float(model.limit)))


def calibrate(model: Model, scored: DataFrame) -> None:
    """Sets the usual cross-entropies and the rejection limit from all rows of ``scored`` (stored)
    that have an ``own`` language. The driver gets a few numbers per language."""
    x = scored.where("own IS NOT NULL").select("own.k", "own.h", F.col("n_letters").alias("n"))
    rows = {r["k"]: r["rows"] for r in x.groupBy("k").agg(F.count("*").alias("rows")).collect()}
    if not rows:
        return
    few = [k for k in range(len(model.langs)) if rows.get(k, 0) < LEAST_OWN]
    # group -1 is all languages together, for those of few texts
    x = x.withColumn("g", F.explode(F.array("k", F.lit(-1)) if few else F.array("k")))
    median = few_group_percentiles(x, ["g"], "n", {"median": 0.5})
    mean = x.groupBy("g").agg((F.sum(F.col("h") * F.sqrt("n")) / F.sum(F.sqrt("n"))).alias("mean"))
    x = x.join(F.broadcast(mean.join(median, "g")), "g").withColumn("square", F.pow(F.col("h") - F.col("mean"), F.lit(2)))
    wide = x.groupBy("g").agg(F.sqrt(F.avg(F.when(F.col("n") >= F.col("median"), F.col("square")))).alias("wide"))
    noise = F.sqrt(F.avg(F.greatest(F.col("square") - F.col("wide") * F.col("wide"), F.lit(0.0)) * F.col("n")))
    usual = x.join(F.broadcast(wide), "g").groupBy("g", "mean", "wide").agg(noise.alias("noise"))
    found = {r["g"]: (r["mean"], max(r["wide"], 1e-3), max(r["noise"], 1e-3)) for r in usual.collect()}
    model.usual = np.array([found[-1 if k in few else k] for k in range(len(model.langs))])
    z = scored.where("own IS NOT NULL").select(_excess(model, F.col("own.k"), F.col("own.h"), F.col("n_letters")).alias("z"))
    model.limit = MARGIN * max(1.0, few_group_percentiles(z, [], "z", {"tail": TOLERANCE}).first()["tail"])


def learn(training: DataFrame) -> Model:
    """The models of all rows of ``training`` (text and lang), not yet calibrated."""
    grams = stored(gram_counts(training), "grams")
    return Model.of(folded_counts(grams).toPandas())  # at most 4 x 2**SLOT_BITS rows per language


def train(training: DataFrame) -> Model:
    """``training`` has text and lang; every row is counted, and scored to set the rejection limit."""
    model = learn(training)
    calibrate(model, stored(_scored(training, model, [], F.col("lang")), "own-entropies"))
    return model


def identify(documents: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """``keep`` columns plus ``lang_pred``, ``score``, ``cross_entropy``, ``rejected``."""
    return _scored(documents, model, keep).select(*keep, "lang_pred", "score", "cross_entropy", _rejected(model).alias("rejected"))


def is_held_out(doc_id="doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _learned_lang() -> Column:
    """The ``lang`` of rows that are learned from: those with a text that are not held out
    (rows without an id can't be); NULL for others."""
    return F.when(~is_held_out() & F.col("text").isNotNull(), F.col("lang").cast("string"))


def _training(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("text").cast("string").alias("text"), _learned_lang().alias("lang"))


def train_on_documents(documents: DataFrame) -> Model:
    return train(_training(documents).where("lang IS NOT NULL"))


def predict_documents(documents: DataFrame) -> DataFrame:
    """Every document, scored once by the models of those that are not held out."""
    model = learn(_training(documents))
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", is_held_out().alias("held_out"), _learned_lang().alias("lang"))
    keep = ["doc_id", "held_out"]
    scored = stored(_scored(docs, model, keep, F.col("lang")), "languages")
    calibrate(model, scored)
    return scored.select(*keep, "lang_pred", "score", "cross_entropy", _rejected(model).alias("rejected"))


def keep_identified(documents: DataFrame, model: Model) -> DataFrame:
    """The rows of ``documents``, all columns, that the model doesn't reject.

    Rows pass through the tasks whole; nothing is joined back by id.
    """
    return _scored_rows(documents, model).where(~_rejected(model)).select("row.*")


def keep_recognised(documents: DataFrame) -> DataFrame:
    """:func:`keep_identified` by the documents' own models; each is scored once, and stored with its row."""
    model = learn(_training(documents))
    scored = stored(_scored_rows(documents, model, _learned_lang()), "recognised")
    calibrate(model, scored)
    return scored.where(~_rejected(model)).select("row.*")
