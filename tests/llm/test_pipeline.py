from __future__ import annotations

from collections import Counter

import pytest

import corpus_pipeline as P
from quillmill.llm import decontaminate, packing, secret_scan, simhash, toxicity
from tests.llm.conftest import ODD, SF


def test_stages_one_by_one(spark, documents, benchmark, labels):
    docs = documents
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.schema.names == documents.schema.names and out.dtypes == documents.dtypes
        kept, were = {r.doc_id: r for r in out.collect()}, {r.doc_id: r for r in docs.collect()}
        gone = were.keys() - kept.keys()
        if name == "toxicity":
            scores = toxicity.score(docs, toxicity.train(docs, labels)).collect()
            assert gone == {r.doc_id for r in scores if r.predicted} and gone
            assert all(kept[d] == were[d] for d in kept)
        elif name == "simhash":
            classes = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs, similarity=P.SIMILARITY).collect()}
            assert kept.keys() == set(classes.values()) and gone and all(kept[d] == were[d] for d in kept)
        elif name == "decontamination":
            report = {r.doc_id: r for r in decontaminate.report(docs, benchmark).collect()}
            assert gone == {d for d, r in report.items() if r.contaminated}
            assert all(kept[d] == were[d] for d in kept if not report[d].n_hit)
            assert not any(r.n_hit for r in decontaminate.report(out, benchmark).collect())
        else:
            spans = {r.doc_id: r.spans for r in secret_scan.scan(docs).collect()}
            assert not gone and all((kept[d].text != were[d].text) == bool(spans[d]) and kept[d].n_chars == len(kept[d].text) for d in kept)
        docs = spark.createDataFrame(out.collect(), documents.schema)
    packed = P.STAGES[-1][1](spark, docs, SF)
    assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in docs.collect()}
    whole = P.run(spark, SF)
    key = ("doc_id", "start", "length", "ids_crc32", "doc_tokens")
    assert Counter(tuple(r[k] for k in key) for r in whole.collect()) == Counter(tuple(r[k] for k in key) for r in packing.pack(docs).collect())


@pytest.mark.parametrize("k", range(5))
def test_stages_on_odd_rows(spark, odd, k):
    docs = odd.select("doc_id", "text", "lang", "source", "n_chars")
    name, stage = P.STAGES[k]
    found = stage(spark, docs, SF).collect()
    ids = Counter(r.doc_id for r in found)
    if name == "simhash":
        # The blank rows are one group, the equal texts another, and of the rows with one id a single one stays.
        assert ids == Counter({d: 1 for d, _ in ODD if d not in (2, 3, 6, 12)})
    else:
        assert ids.keys() == {d for d, _ in ODD}
    assert stage(spark, docs.limit(0), SF).count() == 0
