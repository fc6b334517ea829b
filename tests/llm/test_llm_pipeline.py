from __future__ import annotations

import __spark_entry__ as contract
import corpus_pipeline
from llm_helpers import SMALL, empty_documents, odd_documents, shingle_links, table
from reviewlens.llm.common import stored


def test_stages_one_by_one(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, texts = docs.columns, dict(zip(table("documents").doc_id, table("documents").text))
    labels = table("labels").set_index("doc_id")
    kept = set(texts)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = kept, stored(stage(spark, docs, SMALL), "stage")
        kept = {r.doc_id for r in docs.collect()}
        assert docs.columns == columns and kept <= before and docs.count() == len(kept)
        gone = before - kept
        if name == "language id":
            assert not gone  # every document has words of a main language
        elif name == "quality classifier":
            assert gone and all(labels.quality.get(d, 0) == 0 for d in gone)
            assert sum(labels.quality.get(d, 1) == 0 for d in kept) <= 1
        else:
            _, top = shingle_links({d: texts[d] for d in before})
            assert kept == set(top.values())
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).collect()
    assert {r.doc_id for r in pieces} == kept
    whole = contract.queries()["pipeline"](spark, SMALL).collect()
    key = lambda r: (r.doc_id, r.piece, r.start, r.length, r.ids_crc32)
    assert sorted(map(key, whole)) == sorted(map(key, pieces))


def test_odd_and_empty_documents(spark):
    for docs in (odd_documents(spark), empty_documents(spark)):
        n = docs.count()
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stored(stage(spark, docs, SMALL), "stage")
            assert out.columns == docs.columns and out.dtypes == docs.dtypes and out.count() <= n
        pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL)
        assert pieces.count() == n


def test_every_operator_is_registered():
    names = list(contract.queries())
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13 and "pipeline" in names
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language id", "quality classifier", "n-gram Jaccard join", "best-fit packing"]


def test_a_clean_text_in_several_languages_stays(spark):
    """The language stage judges how sure all languages of a text are, not the share of the main one."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    parts = [r.text for lang in ("en", "fr", "de", "es") for r in docs.filter(f"lang = '{lang}' AND n_chars > 900").orderBy(
        "doc_id").select("text").limit(1).collect()]
    assert len(parts) >= 3
    mixed = spark.createDataFrame([(10**6, "\n".join(p[:900] for p in parts), None, "s", 1)], docs.schema)
    signs = spark.createDataFrame([(10**6 + 1, "\u00bd \u00b2 \u2460 " * 50, None, "s", 1)], docs.schema)
    kept = corpus_pipeline.known_language(spark, docs.unionByName(mixed).unionByName(signs), SMALL)
    assert [r.doc_id for r in kept.filter("doc_id >= 1000000").collect()] == [10**6]
