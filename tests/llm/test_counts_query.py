"""The query on edited counts against plain string edits, and many rows of one id."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from chunkgate.llm import catalog, counts


def brute(rows):
    code = Tokenizer.from_file(public_tokenizers.path(catalog.BYTE_VOCABULARY))
    size = lambda text: len(code.encode(text, add_special_tokens=False).ids)
    out = []
    for i, text in rows:
        new, n = text or "", len(text or "")
        if text is not None:
            a = n // 7
            for at, gone, put in ((a, 3, text[a : a + 3][::-1]), (n // 2, 0, f" {text[:24]} 42 "), (4 * n // 5, 17, "")):
                at = min(at, len(new))
                new = new[:at] + put + new[at + gone :]
        out.append((i, size(text or ""), size(new), len(new)))
    return sorted(out, key=str)


def test_query_equals_plain_edits(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = catalog.op8_edited_counts(spark, sf).select("doc_id", "n_tokens_before", "n_tokens", "n_chars").collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


@pytest.mark.parametrize("one_id", [7, None])
def test_rows_of_one_id_are_edited_by_their_own_edits(spark, one_id):
    """Each row is re-encoded for its own edits alone, however many rows share its id."""
    vocabulary = public_tokenizers.path(catalog.BYTE_VOCABULARY)
    done = {}
    for shared in (True, False):
        rows = [(one_id if shared else i, f"row number {i % 40} of a text with some words in it") for i in range(120)]
        df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("key", F.lit("mine")).withColumn("chars", F.lit("mine"))
        edits = df.select(counts.row_key().alias("key"), F.lit(1).alias("seq"), F.lit(4).alias("pos"), F.lit(6).alias("removed"), F.col("text").alias("inserted"))
        done[shared] = counts.apply_edits(df, counts.build_trees(df, vocabulary), edits, vocabulary).collect()
    assert [len(v) for v in done.values()] == [120, 120]
    a, b = (sorted((r["text"], r["n_tokens"], r["n_reencoded"]) for r in v) for v in done.values())
    assert a == b and a[0][0].startswith("row row number")
