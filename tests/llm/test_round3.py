"""Documents without matches stay where they are; the result is that of a plain left join."""

import pytest
from pyspark.sql import functions as F

from ratelens.llm import decontaminate


@pytest.mark.parametrize("limit", [0, 100])
def test_only_documents_with_matches_are_shuffled(spark, limit, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", limit)
    docs = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (3, "c")], "doc long, text string")
    found = spark.createDataFrame([(1, [5]), (9, [6])], "doc long, found array<int>")
    got = decontaminate.with_found(docs, found)
    plain = docs.join(found, "doc", "left")
    assert sorted(map(str, got.select(*plain.columns).collect())) == sorted(map(str, plain.collect()))
    assert decontaminate.with_found(docs, found.limit(0)).where("found is null").count() == 4
    joins = got._jdf.queryExecution().optimizedPlan().toString()
    assert ("LeftAnti" in joins) == (limit > 0) and ("LeftOuter" in joins) == (limit == 0)


def test_contaminated_and_clean_documents(spark):
    passage = " ".join(f"w{i}" for i in range(20))
    docs = spark.createDataFrame([(1, f"x {passage} y"), (2, "nothing of it"), (3, None), (1, f"x {passage} y")], "doc_id long, text string")
    got = decontaminate.scanned(docs, spark.createDataFrame([(7, passage)], "item_id long, text string"))
    assert sorted((r.doc_id, r.n_words, r.n_hit, r.contaminated) for r in got.collect()) == [
        (1, 22, 20, True), (1, 22, 20, True), (2, 3, 0, False), (3, 0, 0, False)]
