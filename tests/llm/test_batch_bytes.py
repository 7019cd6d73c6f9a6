"""Texts reach Python workers in batches bounded by bytes, not by Spark's 64 MB or 10,000 rows."""

import pyarrow as pa
import pytest


@pytest.mark.parametrize("name", ["encode", "judge", "near"])
def test_batches_of_the_pipelines_python_stages_are_small(spark, name):
    from truetally.llm import bpe, near_dup, quality
    from truetally.llm.common import BATCH_BYTES
    from truetally.llm.queries import vocabulary
    docs = spark.createDataFrame([(i, f"w{i} " * 60 + "x" * (i % 3), "en", "s") for i in range(60)],
                                 "doc_id long, text string, lang string, source string")

    def batch_sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], names=["size"])

    run = {"encode": lambda: bpe.encode_documents(docs, vocabulary()), "judge": lambda: quality.judge(docs),
           "near": lambda: near_dup.near_groups(docs)}[name]
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    assert run().count() == 60
    long = spark.range(0, 400, 1, 1).selectExpr("repeat('a', 100000) text")  # 40 MB in one partition
    sizes = [r.size for r in long.mapInArrow(batch_sizes, "size long").collect()]
    assert max(sizes) <= BATCH_BYTES + 200_000 and sum(sizes) >= 40_000_000
