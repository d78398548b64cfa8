import os

import pytest

from millrace.llm import registry
from tests.compare import DATA, assert_same, connect

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_same_as_sql(spark, name):
    assert_same(spark, connect(), registry.QUERIES[name], registry.ORACLE[name])


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLE)))
def test_runs(spark, name):
    assert registry.QUERIES[name](spark, DATA).count() > 0


def test_related_queries_agree(spark):
    q = {n: registry.QUERIES[n](spark, DATA) for n in ("p3_found", "p3_sentences", "p5_found", "p5_repaired", "p8_found", "p8_restored", "p6_report", "p6_packed", "p7_mixed", "p7_shares")}
    starts = {r["ctx_id"]: r["n"] for r in q["p3_found"].groupBy("ctx_id").count().withColumnRenamed("count", "n").collect()}
    for r in q["p3_sentences"].collect():
        assert len(r["sents"]) == starts.get(r["ctx_id"], 0)
        at = 0
        for s in r["sents"]:
            at = r["text"].index(s["text"], at) + len(s["text"])
    assert {r["doc_id"] for r in q["p8_found"].collect()} == {r["doc_id"] for r in q["p8_restored"].collect()}
    faulty = {r["ctx_id"] for r in q["p5_found"].collect()}
    for r in q["p5_repaired"].collect():
        if r["ctx_id"] in faulty:
            assert r["repaired"] != r["text"]
    packed = {r["container"]: r["n"] for r in q["p6_packed"].groupBy("container").count().withColumnRenamed("count", "n").collect()}
    assert {r["container"]: r["pieces"] for r in q["p6_report"].collect()} == packed
    assert sum(r["documents"] for r in q["p7_shares"].collect()) == q["p7_mixed"].count()
