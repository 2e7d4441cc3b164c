"""Every stage on what its predecessor kept, against brute force; then the whole run."""

import corpus_pipeline as pipeline
from cardfeat.llm import mixing, quality_rules
from cardfeat.llm.tables import read
from cardfeat.session import stage
from tests.conftest import SMALL
from tests.llm import brute


def test_stages(spark):
    docs = read(spark, SMALL, "documents")
    labels = read(spark, SMALL, "labels")
    kept = {}
    for name, function in pipeline.STAGES:
        before = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
        after = stage(function(spark, docs, SMALL), name)
        ids = sorted(r["doc_id"] for r in after.select("doc_id").collect())
        if name == "quality_rules":
            want = [r["doc_id"] for r in quality_rules.quality_rules(docs, labels).filter("kept").collect()]
            assert all(brute.counts(before[i])[0] >= 50 for i in ids)
        elif name == "simhash_near_dedup":
            order = sorted(before)
            label = brute.components([brute.fingerprint(before[i]) for i in order])
            want = list({c: i for c, i in reversed(list(zip(label, order)))}.values())
        elif name == "benchmark_decontamination":
            found = brute.contamination(list(before.items()), brute.table(SMALL, "benchmark", "item_id, text"))
            want = [i for i in before if not found[i][4]]
        elif name == "source_mixing":
            want = [r["doc_id"] for r in mixing.mix_rates(docs, labels).filter("copies > 0").collect()]
        else:
            assert sorted(map(tuple, after.collect())) == brute.token_places(sorted(before.items()))
            want = list(before)
        assert ids == sorted(want) and 0 < len(ids) <= len(before), name
        if name != "token_output":
            assert after.columns == docs.columns
            assert {r["doc_id"]: r["text"] for r in after.select("doc_id", "text").collect()}.items() <= before.items()
        kept[name], docs = ids, after
    assert sorted(map(tuple, pipeline.run(spark, SMALL).collect())) == sorted(map(tuple, docs.collect()))


def test_no_documents(spark, no_docs):
    docs = no_docs
    for _, function in pipeline.STAGES:
        docs = function(spark, docs, SMALL)
    assert docs.count() == 0
