"""Tables that an operator writes on its way go when nothing reads them any more."""

import os

from matchloom.llm import bpe, common


def test_bpe_keeps_one_table_of_chunks(spark):
    docs = spark.createDataFrame([(1, "ab cd " * 20000), (2, "short"), (3, None)], "doc_id long, text string")
    at = common.shared_dir(spark).removeprefix("file://")
    before = set(os.listdir(at)) if os.path.isdir(at) else set()
    encoded = bpe.encode(docs)
    assert [x.split("-")[0] for x in set(os.listdir(at)) - before] == ["boundaries"]
    assert {r.doc_id for r in bpe.digests(encoded).collect()} == {1, 2, 3}
