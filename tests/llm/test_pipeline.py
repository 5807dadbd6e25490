"""The corpus pipeline, stage by stage and as a whole."""

import corpus_pipeline as C
from cohortium.llm import line_alignment as L
from cohortium.llm.common import stored

from .frames import SF, awkward, empty
from .test_packing import check
from .test_simhash import naive_groups
from .test_winnowing import naive


def test_each_stage_equals_brute_force(spark):
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    stages = dict(C.STAGES)
    assert [n for n, _ in C.STAGES] == ["language ID", "line dedup", "SimHash near-dedup", "benchmark decontamination", "best-fit packing"]
    out = {}
    for name, stage in C.STAGES:
        out[name] = stored(stage(spark, docs, SF), "test")
        if name != "best-fit packing":
            assert out[name].schema.simpleString() == docs.schema.simpleString()
        before, docs = docs, out[name]
        if name == "language ID":
            assert docs.count() >= 0.99 * before.count()
        elif name == "line dedup":
            assert docs.count() == before.count()
            # no line that makes a block by itself is left in two documents
            first = {}
            for r in sorted(docs.collect(), key=lambda r: r.doc_id):
                for x in {x.strip() for x in r.text.split("\n") if len(x.strip()) >= L.BLOCK_CHARS}:
                    assert first.setdefault(x, r.doc_id) == r.doc_id, (x, r.doc_id)
        elif name == "SimHash near-dedup":
            groups = naive_groups([(r.doc_id, r.text) for r in before.collect()])
            assert sorted(r.doc_id for r in docs.collect()) == sorted(d for d, _, c in groups if d == c)
        elif name == "benchmark decontamination":
            hit = {d for d, _, n, _ in naive([(r.doc_id, r.text) for r in before.collect()], items) if n}
            assert {r.doc_id for r in docs.collect()} == {r.doc_id for r in before.collect()} - hit
        else:
            tok = Tokenizer.from_file(C.tokenizer_path())
            check(docs.collect(), [(r.doc_id, r.text) for r in before.collect()], tok, 1024)
    assert stages and C.ORACLE_SQL is None


def test_awkward_and_empty_tables(spark):
    for df in (awkward(spark), empty(spark)):
        docs = df
        for _, stage in C.STAGES:
            docs = stored(stage(spark, docs, SF), "test")
        assert "sequence_id" in docs.columns


def test_run(spark):
    got = C.run(spark, SF)
    assert got.count() > 100 and got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


def test_clean_documents_pass(spark):
    """Distinct clean documents reach the end."""
    real = spark.read.parquet(f"{SF}/documents.parquet").collect()
    kept = {r.doc_id for r in C.run(spark, SF).select("doc_id").distinct().collect()}
    groups = {d: c for d, _, c in naive_groups([(r.doc_id, r.text) for r in real])}
    alone = [d for d in groups if list(groups.values()).count(groups[d]) == 1]
    assert len([d for d in alone if d in kept]) > 0.9 * len(alone)
