"""Small frames with the awkward rows that every operator must survive."""

from __future__ import annotations

SF = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, bucket int, value string"


def documents(spark, texts: list, lang: str | None = "en"):
    """Documents 0.. with the given texts and columns whose names clash with inner ones."""
    rows = [(i, t, lang, "s", len(t or ""), 7, "x") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


AWKWARD = [None, "", " ", "\n\n", "a", "é", "one two", "\x00 \x01", "ab " * 20_000, "x" * 70_000, "same text here again", "same text here again",
           "Überraschung 漢字 🙂 naïve", "tab\tand  double  spaces ", " lead", "0" * 40, "???!!!"]


def awkward(spark):
    """NULL id, repeated rows, NULL columns, extra columns."""
    df = documents(spark, AWKWARD)
    none = spark.createDataFrame([(None, "no id", None, None, None, None, None), (None, None, None, None, None, None, None)], DOCS)
    return df.unionByName(df.where("doc_id IN (10, 4)")).unionByName(none)


def empty(spark):
    return spark.createDataFrame([], DOCS)
