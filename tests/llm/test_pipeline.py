"""The stages together, and that they are registered."""

import __spark_entry__ as contract
import corpus_pipeline


def test_every_operator_has_a_query():
    names = list(contract.queries())
    for n in range(1, 11):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert "pipeline" in names


def test_run_is_its_stages(spark, sf_dir, documents):
    docs = documents
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, sf_dir)
        if name != "byte_bpe":
            assert after.columns == documents.columns
        docs = after
    once = sorted((r.doc_id, r.n_tokens) for r in docs.select("doc_id", "n_tokens").collect())
    again = sorted((r.doc_id, r.n_tokens) for r in corpus_pipeline.run(spark, sf_dir).select("doc_id", "n_tokens").collect())
    assert once == again and len(once) > 100
