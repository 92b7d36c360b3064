"""The registered queries and the pipeline at the smallest size."""

import __spark_entry__
import corpus_pipeline
from coursematch.llm.queries import QUERIES

DATA = "/root/testdata/sf0.001"


def test_registered():
    assert {f"op{n}_" for n in range(1, 14)} == {name.split("_")[0] + "_" for name in QUERIES}
    assert {*QUERIES, "pipeline"} <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_stages(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns, left = docs.columns, docs.count()
    bench = [r.text for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, DATA).cache()
        if i < 4:
            assert docs.columns == columns, name
            n = docs.count()
            assert 0 < n <= left
            left = n
        if name == "minhash":
            sets = []
            for r in docs.collect():
                w = r.text.encode().lower().split()
                sets.append({tuple(w[j: j + 5]) for j in range(len(w) - 4)} or {tuple(w)})
            assert all(len(a & b) < 0.8 * len(a | b) for x, a in enumerate(sets) for b in sets[:x])
        if name == "decontamination":
            assert not any(t in r.text for r in docs.collect() for t in bench)
    assert docs.count() == left and docs.select("shard").distinct().count() <= 40


def test_stages_take_null_rows(spark):
    docs = spark.createDataFrame([(1, "one two three.", "en", "s", 3), (2, None, None, None, None), (None, "A good line.\nAnd one more.", None, "s", 1)], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, DATA).cache()
    assert docs.count() <= 3
