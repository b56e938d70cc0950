"""The pipeline against its operators' brute-force forms on a small folder of tables."""

import pytest

import corpus_pipeline
from alertlake.llm import exact, langid, pack, quality, simhash
from alertlake.llm.common import table
from tests.conftest import SF_SMALL


def test_stages_are_in_order_and_keep_the_columns(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language_id", "quality_classifier", "exact_dedup", "simhash_near_dedup", "best_fit_packing"]
    docs = table(spark, SF_SMALL, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF_SMALL).columns == docs.columns


def test_run_equals_brute_force(spark):
    docs = table(spark, SF_SMALL, "documents")
    rows = {r.doc_id: r for r in docs.collect()}
    stay = {r.doc_id for r in langid.identify(docs).collect() if r.accepted}
    left = docs.where(docs.doc_id.isin(list(stay)))
    stay = {r.doc_id for r in quality.classify(left, quality.trusted_ids(table(spark, SF_SMALL, "labels"))).collect() if r.kept}
    stay = {r[0] for r in exact.brute_force([(i, rows[i].text) for i in sorted(stay)]) if r[3]}
    stay = {r[0] for r in simhash.brute_force([(i, rows[i].text) for i in sorted(stay)]) if r[0] == r[2]}
    got = corpus_pipeline.run(spark, SF_SMALL).collect()
    assert {r.doc_id for r in got} == stay
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(corpus_pipeline.TOKENIZER)
    size = {i: len(library.encode(rows[i].text or "", add_special_tokens=False).ids) + 1 for i in stay}
    assert {i: sum(r.length for r in got if r.doc_id == i) for i in stay} == size
    filled: dict = {}
    for r in got:
        filled[r.sequence_id] = filled.get(r.sequence_id, 0) + r.length
    assert sorted(2048 - x for x in filled.values()) == pack.brute_force([r.length for r in got])


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_bear_empty_tables_and_odd_rows(spark, name, stage):
    docs = table(spark, SF_SMALL, "documents")
    assert stage(spark, docs.limit(0), SF_SMALL).count() == 0
    odd = spark.createDataFrame([(None, None, None, None, None), (1, None, "en", "s", 0), (1, None, "en", "s", 0), (2, "", None, None, None)],
                                docs.schema)
    out = stage(spark, odd, SF_SMALL)
    assert out.count() <= 4
