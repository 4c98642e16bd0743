"""The pipeline's stages one by one against plain code, and the registered queries."""

import os
from collections import Counter

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from sanitaria.llm.common import table, written
from sanitaria.llm.pii import all_spans, train
from tests.compare import duck, mismatch
from tests.llm.test_jaccard import shingles
from tests.llm.test_quality import plain_counts

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")


def test_stages(spark):
    docs = table(spark, SF_DIR, "documents")
    kinds = docs.schema
    seen = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF_DIR), "test-stage")
        seen.append(docs)
        if name != "pieces":
            assert docs.columns == kinds.names
    raw, good, single, masked, mixed, pieces = ([r.asDict() for r in d.collect()] for d in seen)
    labels = {r["doc_id"]: r["quality"] for r in table(spark, SF_DIR, "labels").collect()}
    kept = {r["doc_id"] for r in good}
    for r in raw:
        n = len(r["text"].split())
        if n < 50 or 100 * plain_counts(r["text"])[3] > 50 * n:
            assert r["doc_id"] not in kept
        elif labels.get(r["doc_id"]) == 1:
            assert r["doc_id"] in kept
    sets = {r["doc_id"]: shingles(r["text"], 5) for r in good}
    stays = {r["doc_id"] for r in single}
    for a in kept - stays:
        assert any(100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) for b in kept - {a} if b < a or b in stays)
    for a in stays:
        assert not any(a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) for b in stays)
    field = train()
    assert {r["doc_id"] for r in masked} == stays
    for r in masked:
        assert not any(k in ("email", "card", "ip") for k, *_ in all_spans([r["text"]], field)[0][0]) and r["n_chars"] == len(r["text"])
    words = {r["doc_id"]: len(r["text"].split()) for r in masked}
    times = Counter(r["doc_id"] for r in mixed)
    assert set(times) <= set(words) and max(times.values()) <= 2
    total = sum(words.values())
    assert abs(sum(words[k] * n for k, n in times.items()) - 1.5 * total) < 0.02 * total
    assert Counter(r["doc_id"] for r in pieces) == times and all(r["round_trip"] for r in pieces)


@pytest.mark.parametrize("name", [n for n in entry.queries() if n.startswith("op") and n[2].isdigit()])
def test_query(spark, name):
    assert mismatch(entry.queries()[name], entry.oracle_sql().get(name), spark, SF_DIR, duck(SF_DIR)) is None
