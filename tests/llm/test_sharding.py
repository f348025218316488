"""Copies keep together under the quotas, also where every row has a copy."""

import pytest
from pyspark.sql import functions as F

from tidemark.llm import sharding
from tidemark.workspace import Workspace


@pytest.mark.parametrize(
    "texts, most",
    [
        ([f"pair {k // 2}" for k in range(1200)], 0.02),
        ([f"group {k % 300}" for k in range(1100)] + ["hot"] * 500, 0.06),
        (["shard sized"] * 90 + [f"pair {k // 2}" for k in range(910)], 0.02),
    ],
)
def test_copies_only(spark, texts, most):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    with Workspace(spark) as w:
        found = w.store(sharding.shard_rows(docs, w, shards=10), "placed")
        sizes = [r["count"] for r in found.groupBy("shard").count().collect()]
        assert len(sizes) == 10 and max(sizes) - min(sizes) <= 1
        assert found.groupBy("shard").agg(F.max("slot") + 1 == F.count("slot")).count() == 10
        assert found.select("doc_id").distinct().count() == found.count() == len(texts)
        groups = sharding.cut_copies(found).filter(f"copies <= {len(texts) // 10}")
        cut, shared = groups.agg(F.sum(F.col("copies") - F.col("main")), F.sum("copies")).head()
        print("cut rows", cut, "of", shared)
        assert cut <= most * shared
        assert groups.filter("copies = 90 AND shards > 1").count() == 0
