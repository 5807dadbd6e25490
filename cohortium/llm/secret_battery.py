"""Secret scan: fixed patterns plus a randomness test battery, in DataFrame operations only.

Base spans are the leftmost non-overlapping matches of three patterns. Other
long runs of key characters that hold letters and digits are tested: their
encoding is inferred (hex, base32, base64, letters and digits), and three tests ask
whether they look drawn at random from its alphabet: chi-squared uniformity of the
symbols, runs about the middle symbol, and lag-1 serial correlation. The three
p-values are combined (three times the smallest). Within each stratum of length,
Benjamini-Hochberg at ``FALSE_REJECTS`` decides which runs are *not* random, so of
all runs put aside at most that part are expected to be random; what is not put
aside is reported as a ``random`` span. The p-values are counted on a fixed grid per
stratum, so the decision needs one small aggregate, not a sort of all runs.

Edge cases: NULL and empty texts have no spans; positions are code points, ends
exclusive; runs that overlap a base span are not tested; repeated rows each get
their row; a NULL ``doc_id`` is kept; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortium.llm.common import doc_texts, stored

# fixed values: the base patterns, and what each needs
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]+"
HEX = "[0-9a-f]+"
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 6, 20, 24
KINDS = ("assign", "access", "hex", "random")

RUN_LEAST = 20
RUN = "[A-Za-z0-9+/_-]{%d,}={0,2}" % RUN_LEAST
STRATA = (24, 32, 48, 64, 128)
FALSE_REJECTS = 0.05
GRID = 20  # p-value bins per power of ten
FLOOR = 1e-20

DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: (name, what its runs look like, alphabet in order); the first that fits is taken
ENCODINGS = (
    ("hex", "^([0-9a-f]+|[0-9A-F]+)$", "0123456789abcdef"),
    ("base32", "^[A-Z2-7]+$", UPPER + "234567"),
    ("base36", "^([a-z0-9]+|[A-Z0-9]+)$", DIGITS + LOWER),
    ("base62", "^[A-Za-z0-9]+$", DIGITS + UPPER + LOWER),
    ("base64", "", UPPER + LOWER + DIGITS + "+/-_"),
)
_SPAN = "array<struct<start:int,kind:int,end:int,token:string>>"


def _matches(text: Column, pattern: str, kind: int, group: int = 0) -> Column:
    """Spans of all matches: the pieces between them (by splitting) give their places."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else hits
    sized = F.zip_with(F.slice(F.split(text, pattern, -1), F.lit(1), F.size(hits)), F.arrays_zip(hits.alias("hit"), value.alias("value")),
                       lambda gap, m: F.struct(F.length(gap).alias("gap"), F.length(m["hit"]).alias("size"), m["value"].alias("value")))
    nothing = F.array().cast("array<struct<start:int,kind:int,end:int,token:string>>")
    walked = F.aggregate(sized, F.struct(F.lit(0).alias("at"), nothing.alias("out")), lambda acc, m: F.struct(
        (acc["at"] + m["gap"] + m["size"]).alias("at"),
        F.concat(acc["out"], F.array(F.struct((acc["at"] + m["gap"]).alias("start"), F.lit(kind).alias("kind"),
                                              (acc["at"] + m["gap"] + m["size"]).alias("end"), m["value"].alias("token")))).alias("out")))
    return walked["out"]


def _found(text: Column, pattern: str, may: str, kind: int, least: int, group: int = 0) -> Column:
    """Matches whose value has at least ``least`` characters; ``may`` is a cheap necessary condition."""
    none = F.array().cast(_SPAN)
    kept = F.filter(_matches(text, pattern, kind, group), lambda m: F.length(m["token"]) >= least)
    return F.when(text.rlike(may), kept).otherwise(none)


def _phi_tail(z: Column) -> Column:
    """Upper tail of the normal distribution for z >= 0 (Abramowitz and Stegun 26.2.17)."""
    t = 1 / (1 + 0.2316419 * z)
    # fixed values of that formula
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    return F.exp(-z * z / 2) / (2 * 3.141592653589793) ** 0.5 * poly


def with_p_values(runs: DataFrame) -> DataFrame:
    """Adds ``encoding``, ``n``, the three p-values and the combined ``p`` to rows with a ``token``."""
    body = F.rtrim(F.col("token"), F.lit("="))
    x = runs.withColumn("body", body)
    name, alphabet = F.lit(ENCODINGS[-1][0]), F.lit(ENCODINGS[-1][2])
    for n, looks, letters in reversed(ENCODINGS[:-1]):
        fits = F.col("body").rlike(looks)
        name, alphabet = F.when(fits, F.lit(n)).otherwise(name), F.when(fits, F.lit(letters)).otherwise(alphabet)
    x = x.withColumns({"encoding": name, "alphabet": alphabet})
    single = F.col("encoding").isin("hex", "base36")
    x = x.withColumn("body", F.when(single, F.lower("body")).otherwise(F.col("body")))
    x = x.withColumns({"n": F.length("body").cast("double"), "a": F.length("alphabet").cast("double")})
    x = x.withColumn("codes", F.transform(F.split("body", ""), lambda c: (F.instr(F.col("alphabet"), c) - 1).cast("double")))
    mid = (F.col("a") - 1) / 2
    zero = F.lit(0.0)
    start = F.struct(F.lit(None).cast("double").alias("last"), zero.alias("sq"), zero.alias("lag"), zero.alias("high"), F.lit(1.0).alias("runs"))
    walk = F.aggregate("codes", start, lambda s, c: F.struct(
        c.alias("last"), (s["sq"] + (c - mid) * (c - mid)).alias("sq"),
        (s["lag"] + F.coalesce((s["last"] - mid) * (c - mid), zero)).alias("lag"),
        (s["high"] + F.when(c > mid, 1.0).otherwise(0.0)).alias("high"),
        (s["runs"] + F.when((s["last"] > mid) != (c > mid), 1.0).otherwise(0.0)).alias("runs")))
    squares = F.aggregate(F.split("alphabet", ""), zero, lambda s, c: s + F.pow(F.col("n") - F.length(F.replace(F.col("body"), c, F.lit(""))), F.lit(2)))
    x = x.withColumns({"walk": walk, "squares": squares})
    n, a = F.col("n"), F.col("a")
    chi = a / n * F.col("squares") - n
    z_chi = (chi - (a - 1)) / F.sqrt(2 * (a - 1) * (n - 1) / n)
    p_chi = F.when(z_chi > 0, _phi_tail(z_chi)).otherwise(1 - _phi_tail(-z_chi))
    high, low = F.col("walk.high"), n - F.col("walk.high")
    both = 2 * high * low
    spread = both * (both - n) / (n * n * (n - 1))
    p_runs = F.when(spread > 0, F.least(F.lit(1.0), 2 * _phi_tail(F.abs(F.col("walk.runs") - both / n - 1) / F.sqrt(spread)))).otherwise(0.0)
    p_lag = F.when(F.col("walk.sq") > 0, F.least(F.lit(1.0), 2 * _phi_tail(F.abs(F.col("walk.lag") / F.col("walk.sq")) * F.sqrt(n)))).otherwise(0.0)
    x = x.withColumns({"p_uniform": p_chi, "p_runs": p_runs, "p_serial": p_lag})
    p = F.greatest(F.lit(FLOOR), F.least(F.lit(1.0), 3 * F.least("p_uniform", "p_runs", "p_serial")))
    return x.withColumn("p", p).drop("body", "alphabet", "a", "codes", "walk", "squares")


def _stratum(n: Column) -> Column:
    return sum((F.when(n >= cut, 1).otherwise(0) for cut in STRATA), F.lit(0))


def reject_limits(tested: DataFrame, rate: float = FALSE_REJECTS) -> DataFrame:
    """(stratum, limit): runs with p <= limit are put aside as not random.

    At most len(STRATA) + 1 strata of GRID x 20 + 1 bins, whatever the input.
    """
    bins = tested.groupBy("stratum", F.floor(-F.log10("p") * GRID).alias("bin")).agg(F.count("*").alias("n"))
    up = Window.partitionBy("stratum").orderBy(F.desc("bin"))
    ranked = bins.select("stratum", "bin", F.sum("n").over(up).alias("rank"), F.sum("n").over(Window.partitionBy("stratum")).alias("m"))
    most = F.pow(F.lit(10.0), -F.col("bin") / GRID)  # largest p of the bin
    return (ranked.where(most <= rate * F.col("rank") / F.col("m")).groupBy("stratum").agg(F.max(most).alias("limit")))


def scan(documents: DataFrame, rate: float = FALSE_REJECTS) -> DataFrame:
    """``doc_id`` and ``found``: all spans (start, kind, end, token) by start, then kind."""
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = doc_texts(documents).select("doc_id", text.alias("text"))
    base = F.concat(
        _found(F.col("text"), ASSIGN, r"(?i)(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]", 0, ASSIGN_LEAST, 2),
        _found(F.col("text"), ACCESS, "AKIA[A-Z0-9]{16}", 1, ACCESS_LEAST),
        _found(F.col("text"), HEX, "[0-9a-f]{24}", 2, HEX_LEAST))
    # a run of letters and digits has the two side by side somewhere; prose hardly ever does
    beside = F.col("text").rlike("[0-9][A-Za-z+/_-]|[A-Za-z+/_-][0-9]")
    runs = F.when(beside, _found(F.col("text"), RUN, RUN[:-len("={0,2}")], 3, RUN_LEAST)).otherwise(F.array().cast(_SPAN))
    rows = docs.select("doc_id", base.alias("base"), runs.alias("runs"))
    mixed = F.filter("runs", lambda r: r["token"].rlike("[0-9]") & r["token"].rlike("[A-Za-z]") & ~F.exists(
        F.col("base"), lambda b: (b["start"] < r["end"]) & (r["start"] < b["end"])))
    rows = rows.select(F.monotonically_increasing_id().alias("uid"), "doc_id", "base", mixed.alias("runs"))
    rows = stored(rows, "secrets")
    tested = with_p_values(rows.select("uid", F.explode("runs").alias("r")).select("uid", "r.*"))
    tested = stored(tested.withColumn("stratum", _stratum(F.col("n"))), "secret-tests")
    limits = F.broadcast(reject_limits(tested, rate))  # a row per stratum at most
    random = (tested.join(limits, "stratum", "left").where("limit IS NULL OR p > limit").groupBy("uid")
              .agg(F.collect_list(F.struct("start", "kind", "end", "token")).alias("random")))
    return rows.join(random, "uid", "left").select(
        "doc_id", F.sort_array(F.concat("base", F.coalesce("random", F.array().cast(_SPAN)))).alias("found"))


def count_of(spans: Column, kind: int) -> Column:
    """Number of spans of a kind."""
    # a lambda of two parameters would be given the index as the second
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def span_text(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")
