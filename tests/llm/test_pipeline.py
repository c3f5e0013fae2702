"""The pipeline's stages on the smallest tables, each against its own input."""

import collections
import re

import corpus_pipeline as P

SMALL = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    seen = {}
    for name, stage in P.STAGES:
        out = stage(spark, docs, SMALL)
        rows = out.collect()
        seen[name] = {r.doc_id: r for r in rows}
        assert len(rows) == len(seen[name]) <= docs.count()
        if name != "bpe":
            assert out.columns == columns
            docs = spark.createDataFrame(rows, docs.schema)
    norm = lambda t: re.sub("[ \t-\r]+", " ", t)
    first = collections.OrderedDict()
    for i, r in sorted(seen["quality"].items()):
        first.setdefault(norm(r.text), i)
    assert set(seen["exact_dedup"]) == set(first.values())
    assert set(seen["decontaminate"]) <= set(seen["ngram_join"]) <= set(seen["exact_dedup"])
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert {i: r.text for i, r in seen["bpe"].items()} == texts
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    assert all(i in seen["quality"] for i, q in labels.items() if q == 1 and i in texts)
