"""The stages of the pipeline, each held against its operator's brute force on its own input."""

import numpy as np
from pyspark.sql import functions as F
from test_operators import BYTES, brute_base, brute_groups, brute_removal, library

import corpus_pipeline

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        seen[name] = before, docs
        if name != "packed":
            assert docs.columns == columns
    before, after = seen["quality_rules"]
    kept = {r.doc_id for r in after.collect()}
    passing = {i for i, t in before if (b := brute_base(t))[0] >= 20 and 100 * b[4] <= 30 * b[0]}
    assert kept <= passing and len(kept) >= 0.8 * len(passing)
    before, after = seen["near_duplicates"]
    want = brute_groups(before)
    assert {r.doc_id for r in after.collect()} == {i for i, c in want.items() if i == c}
    before, after = seen["repeated_passages"]
    left = {i: n - gone for i, n, gone, _ in brute_removal(before)}
    assert {r.doc_id: len(r.text.split()) for r in after.collect()} == {i: n for i, n in left.items() if n}
    before, after = seen["source_mix"]
    assert {r.doc_id for r in after.collect()} <= {i for i, _ in before} and after.count() > 0.7 * len(before)
    before, after = seen["packed"]
    assert after.agg({"length": "sum"}).first()[0] == sum(map(len, library(BYTES, [t for _, t in before], 1)))


def test_odd_rows_pass_through(spark, odd, empty):
    for df in (odd, empty):
        docs = df
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            docs = spark.createDataFrame(out.collect(), out.schema)
    assert np.isfinite(docs.count())


CLASHING = ["kept", "score", "n_words", "n_removed", "places", "_tag", "_id", "_of", "copies", "_size", "_copy", "rep", "cell", "rest", "size", "a b", "x.y"]


def test_columns_named_like_results_go_through_unchanged(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    own = docs.columns
    docs = docs.select("*", *[F.concat(F.lit(f"{c} of "), F.col("doc_id").cast("string")).alias(c) for c in CLASHING])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == own + CLASHING, name
        rows = out.collect()
        assert rows and all(r[c] == f"{c} of {r['doc_id']}" for r in rows for c in CLASHING), name
