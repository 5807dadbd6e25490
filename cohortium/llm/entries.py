"""Registered queries of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortium.deploy import ship_package
from cohortium.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return fn(spark, sf_dir)

        QUERIES[key] = run
        if sql is not None:
            ORACLE[key] = sql
        return fn
    return deco


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@register("op6_best_fit_packing")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cohortium.llm.bestfit_packing import pack_documents

    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


@register("op5_warc_transactions", """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body, sha256(coalesce(html, '')) AS hash FROM pages
), q AS (
  SELECT page_id, strlen(body) AS payload_bytes, hash, min(page_id) OVER (PARTITION BY hash) AS origin FROM p
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, hash AS payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> origin THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> origin THEN origin END AS refers_to
FROM q
""")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cohortium.llm.warc_transactions import archive_and_assemble

    got = archive_and_assemble(table(spark, sf_dir, "pages"), with_payload=False)
    return got.selectExpr("metadata.page_id AS page_id", "response.payload_bytes AS payload_bytes",
                          "response.payload_digest AS payload_digest", "response.record_type AS record_type",
                          "refers_to_page AS refers_to")


@register("op9_prefix_fingerprints")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cohortium.llm.prefix_hash import fingerprint_documents

    return fingerprint_documents(table(spark, sf_dir, "documents"))


@register("op4_simhash_near_duplicates")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cohortium.llm.simhash_wildcards import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


_WORDS = ("regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          "'[0-9a-z\\x{80}-\\x{10FFFF}]+')")


@register("op2_winnowing_decontamination", f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT item_id, w, least(10, len(w)) AS k FROM (SELECT item_id, {_WORDS} AS w FROM benchmark) WHERE len(w) > 0),
iw AS (SELECT DISTINCT item_id, k, list_slice(w, p + 1, p + k) AS g FROM (SELECT *, unnest(range(len(w) - k + 1)) AS p FROM i)),
ks AS (SELECT DISTINCT k FROM iw),
dw AS (SELECT doc_id, p, k, list_slice(w, p + 1, p + k) AS g
       FROM (SELECT doc_id, w, k, unnest(range(len(w) - k + 1)) AS p FROM d, ks WHERE len(w) >= k)),
hit AS (SELECT DISTINCT doc_id, p, dw.k, item_id FROM dw JOIN iw ON dw.k = iw.k AND dw.g = iw.g),
cover AS (SELECT doc_id, count(DISTINCT word) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + k)) AS word FROM hit) GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN cover USING (doc_id) LEFT JOIN found USING (doc_id)
""")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cohortium.llm.winnowing import contamination

    got = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return got.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


@register("op8_kneser_ney_langid")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cohortium.llm.kn_langid import predict_documents

    return predict_documents(table(spark, sf_dir, "documents"))


@register("op7_randomness_secrets")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cohortium.llm.secret_battery import KINDS, count_of, scan, span_text

    found = scan(table(spark, sf_dir, "documents"))
    base = F.filter("found", lambda s: s["kind"] < 3)
    counts = [count_of(F.col("found"), k).alias(f"n_{KINDS[k]}") for k in range(4)]
    return found.select("doc_id", *counts, F.sha2(span_text(base), 256).alias("base_sha256"), span_text(F.col("found")).alias("spans"))


@register("op10_patience_line_dedup")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cohortium.llm.line_alignment import dedupe_lines

    got = dedupe_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return got.select("doc_id", F.size("_removed").cast("long").alias("n_removed"), F.col("_removed").alias("removed_lines"),
                      F.col("_partners").alias("partner_ids"), "text")


@register("op1_ordinal_toxicity")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cohortium.llm.ordinal_toxicity import severity

    return severity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op3_attention_quality")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cohortium.llm.mil_quality import quality

    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op11_block_rotation_fim", r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS whole, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u,
         sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS x
  FROM documents
), h AS (
  SELECT *, CAST('0x' || substr(x, 1, 8) AS BIGINT) % (len(u) + 1) AS c1, CAST('0x' || substr(x, 9, 8) AS BIGINT) % (len(u) + 1) AS c2,
         CASE WHEN whole = '' OR contains(whole, '<P>') OR contains(whole, '<S>') OR contains(whole, '<M>')
                OR CAST('0x' || substr(x, 17, 8) AS BIGINT) % 100 >= 100 THEN 'plain'
              WHEN CAST('0x' || substr(x, 25, 8) AS BIGINT) % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM d
), s AS (
  SELECT *, array_to_string(u[1:least(c1, c2)], '') AS pre, array_to_string(u[least(c1, c2) + 1:greatest(c1, c2)], '') AS mid,
         array_to_string(u[greatest(c1, c2) + 1:], '') AS suf
  FROM h
)
SELECT doc_id, CAST(len(u) AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(pre) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(mid) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN whole WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
              ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(whole) AS restored_sha256
FROM s
""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cohortium.llm.block_rotation import fill_in_middle, restored

    got = restored(fill_in_middle(table(spark, sf_dir, "documents")))
    return got.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
                      F.sha2(F.col("restored").cast("binary"), 256).alias("restored_sha256"))


@register("op12_bit_sliced_resampling")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cohortium.llm.bit_planes import importance

    return importance(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select("doc_id", "n_features", "weight", "score", "rank")


@register("op13_token_group_jaccard")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cohortium.llm.token_groups import jaccard_components

    return jaccard_components(table(spark, sf_dir, "documents"))
