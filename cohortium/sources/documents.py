"""Document collections whose keys and value types are not known beforehand.

A collection is read the way a document store is loaded into a table: the columns are
the *union* of the keys that any document has, an absent key is NULL, and a column's
type follows from the values found under its key. Documents are parsed once into
VARIANT values. One distributed pass lists every top-level key with the types of its
values (a map-side combined aggregate, a row per key and type); the second pass, which
is the read itself, extracts one typed column per key.

Types: whole numbers are LONG (DECIMAL(38,0) beyond 64 bits), other numbers DOUBLE,
booleans and text as they are. A key with values of several kinds, or with objects or
arrays, becomes text: text values as they are, others as JSON.

Edge cases: text that isn't a JSON object (or repeats a key) has no keys and gives a
row of NULLs, as does NULL; a key that only ever holds ``null`` is a text column of
NULLs; keys that differ only by case get distinct columns (:func:`column_names`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortium.sources.tables import CASE_CLASH, column_name

#: more distinct keys than this are data used as keys, not a table's columns
MAX_KEYS = 10_000
_KINDS = {"BIGINT": "integer", "DECIMAL": "number", "DOUBLE": "number", "FLOAT": "number", "STRING": "text",
          "BOOLEAN": "boolean", "VOID": "null", "OBJECT": "object", "ARRAY": "array"}


def _parsed(docs: DataFrame, text_col: str) -> DataFrame:
    return docs.select(F.try_parse_json(F.col(text_col)).alias("doc"))


def key_types(docs: DataFrame, text_col: str) -> DataFrame:
    """(key, kind, n_docs, merged): how many documents hold a value of each kind under each
    key, and the type that holds all values of that kind."""
    parsed = _parsed(docs, text_col).where("schema_of_variant(doc) LIKE 'OBJECT<%'")
    each = parsed.lateralJoin(docs.sparkSession.tvf.variant_explode(F.col("doc").outer())).select("key", "value")
    name = F.regexp_extract(F.schema_of_variant("value"), "^[A-Z]+", 0)
    kinds = F.create_map(*(F.lit(x) for pair in _KINDS.items() for x in pair))
    kind = F.coalesce(F.element_at(kinds, name), F.lit("other"))
    return each.groupBy("key", kind.alias("kind")).agg(F.count("*").alias("n_docs"), F.schema_of_variant_agg("value").alias("merged"))


def key_profile(docs: DataFrame, text_col: str) -> DataFrame:
    """(key, n_docs, n_null, kinds): per key, the documents that have it, those where it is
    ``null``, and the kinds of its other values."""
    types = key_types(docs, text_col)
    return types.groupBy("key").agg(
        F.sum("n_docs").alias("n_docs"), F.coalesce(F.sum(F.when(F.col("kind") == "null", F.col("n_docs"))), F.lit(0)).alias("n_null"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("kind") != "null", F.col("kind")))), ",").alias("kinds"))


def _type_of(kinds: dict[str, str]) -> str:
    """Column type of a key, from its kinds and their merged types."""
    held = set(kinds) - {"null"}
    if held == {"integer"}:
        return "long"
    if held == {"boolean"}:
        return "boolean"
    if held and held <= {"integer", "number"}:
        whole = kinds["number"].startswith("DECIMAL") and kinds["number"].endswith(",0)")
        return "decimal(38,0)" if whole else "double"
    return "string"


def column_names(keys: list[str]) -> dict[str, str]:
    """A distinct column for each key, although Spark's column names ignore case.

    The known aliases keep their fixed columns; of others that clash, the later in
    sorted order get underscores at the end.
    """
    out: dict[str, str] = {}
    for key in sorted(keys, key=lambda k: (k in CASE_CLASH, k)):
        name = column_name(key)
        while name.lower() in {c.lower() for c in out.values()}:
            name += "_"
        out[key] = name
    return {k: out[k] for k in keys}


def _value(key: str, kind: str) -> Column:
    if "\\" in key or ("'" in key and '"' in key):  # no path can quote these
        found = F.element_at(F.from_json(F.col("doc").cast("string"), T.MapType(T.StringType(), T.StringType())), F.lit(key))
        return found.try_cast(kind)
    quote = "'" if '"' in key else '"'
    return F.try_variant_get(F.col("doc"), f"$[{quote}{key}{quote}]", kind)


def read_union(docs: DataFrame, text_col: str, expected: dict[str, str] | None = None, drop=("_id",)) -> DataFrame:
    """All documents with the union of their keys as columns, ``drop`` left out.

    ``expected`` (key to type) fixes the type of known keys and adds those that no
    document has. Other columns follow, sorted by key.
    """
    expected = expected or {}
    found: dict[str, dict[str, str]] = {}
    for r in key_types(docs, text_col).limit(MAX_KEYS * len(_KINDS) + 1).collect():  # a row per key and kind
        found.setdefault(r["key"], {})[r["kind"]] = r["merged"]
    if len(found) > MAX_KEYS:
        raise ValueError(f"more than {MAX_KEYS} distinct keys: these are data, not columns")
    types = {**expected, **{k: _type_of(v) for k, v in sorted(found.items()) if k not in expected and k not in drop}}
    names = column_names(list(types))
    return _parsed(docs, text_col).select(*(_value(k, t).alias(names[k]) for k, t in types.items()))
