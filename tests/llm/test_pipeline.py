"""Each stage on what the stage before kept."""

import pytest

from loomtext.llm._common import saved

corpus_pipeline = pytest.importorskip("corpus_pipeline")


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    bench = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES:
        kept.append(saved(stage(spark, kept[-1], sf), name))
        ids = [r.doc_id for r in kept[-1].select("doc_id").collect()]
        assert len(set(ids)) == len(ids) and set(ids) <= {r.doc_id for r in kept[-2].select("doc_id").collect()}
        if len(kept) < 6:
            assert kept[-1].columns == docs.columns
    from tests_near import classes

    own = {r.doc_id: r.text for r in kept[2].collect()}
    want = classes(own)
    assert {r.doc_id for r in kept[3].collect()} == {k for k, c in want.items() if k == c}
    leaking = {r.doc_id for r in kept[3].collect() if any(" ".join(b.split()) in " ".join((r.text or "").split()) for b in bench)}
    assert not leaking & {r.doc_id for r in kept[4].collect()}
    final = kept[5].collect()
    assert final and all(0 < r.taken <= 3 * len(r.text.split()) for r in final)
