import math

import pytest
from pyspark.sql import functions as F

from chunkgate.operators import validate
from chunkgate.operators.identity import content_digest
from chunkgate.operators.split import held_out_rows, train_rows, with_split


def chunk(spark, *rows, schema="ord int, k string, y double"):
    return spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], schema)


def kept(df, rule=None):
    rows = validate.validated(df, "k", "y", ["ord"], rule).orderBy("ord").collect()
    return [(r["k"], r["y"]) for r in rows]


def letters(value):
    """Sorted letters; a text with an opening bracket does not parse."""
    return F.when(~value.contains("("), F.array_join(F.array_sort(F.split(value, "")), ""))


def test_clean_rows_stay(spark):
    rows = [("ccco", 1.0), ("cc", 2.0), ("cco", 1.5), ("c1", 1.25)]
    assert kept(chunk(spark, *rows)) == rows


def test_missing_columns_are_named(spark):
    df = spark.createDataFrame([(1.0,)], "z double")
    with pytest.raises(ValueError, match=r"lacks \['k', 'y'\]"):
        validate.validated(df, "k", "y", ["z"])


def test_text_target_raises(spark):
    with pytest.raises(ValueError, match="must hold numbers"):
        kept(chunk(spark, ("a", "1"), schema="ord int, k string, y string"))


def test_boolean_target_counts_as_numeric(spark):
    assert kept(chunk(spark, ("a", True), schema="ord int, k string, y boolean")) == [("a", True)]


def test_null_and_nan_rows_drop_infinity_stays(spark):
    rows = [(None, 1.0), ("a", None), ("b", math.nan), ("c", math.inf), ("d", 2.0)]
    assert kept(chunk(spark, *rows)) == [("c", math.inf), ("d", 2.0)]


def test_first_duplicate_stays_whatever_the_partitioning(spark):
    rows = [("a", 1.0), ("a", 2.0), ("b", 3.0)] * 40
    df = chunk(spark, *rows)
    for n in (1, 3, 7):
        assert kept(df.repartition(n)) == [("a", 1.0), ("b", 3.0)]


def test_spellings_collapse_after_canonicalising(spark):
    rows = [("occ", 1.0), ("coc", 2.0), ("cco", 3.0), ("nc", 4.0)]
    assert kept(chunk(spark, *rows), letters) == [("cco", 1.0), ("cn", 4.0)]


def test_default_form_lowers_and_collapses_blanks(spark):
    assert kept(chunk(spark, (" A\n b\t", 1.0), ("a b", 2.0), ("  ", 3.0))) == [("a b", 1.0)]


def test_numeric_key_does_not_parse(spark):
    assert kept(chunk(spark, (3.5, 1.0), schema="ord int, k double, y double")) == []


def test_unparseable_rows_drop(spark):
    rows = [(None, 1.0), ("a", None), ("c((", 1.0), ("cc", 2.0), ("co", 3.0)]
    assert kept(chunk(spark, *rows), letters) == [("cc", 2.0), ("co", 3.0)]


def test_no_row_left_raises_with_the_raw_count(spark):
    valid = validate.validated(chunk(spark, (None, 1.0), ("c((", 2.0)), "k", "y", ["ord"], letters)
    with pytest.raises(ValueError, match="2 rows"):
        validate.require_rows(valid, 2)


def test_report_adds_up(spark):
    rows = [(None, 1.0), ("a", math.nan), ("c((", 1.0), ("cc", 2.0), ("cc", 3.0), ("co", 3.0)]
    report = validate.validation_report(chunk(spark, *rows), "k", "y", letters).first()
    assert report.asDict() == {
        "raw_rows": 6, "null_rows": 2, "unparseable_rows": 1, "duplicate_rows": 1, "valid_rows": 2, "dropped_rows": 4,
    }


def test_duplicate_rows_with_a_hot_key(spark):
    rows = [("hot", float(i)) for i in range(300)] + [(f"k{i % 350}", 0.0) for i in range(600)]
    df = chunk(spark, *rows)
    found = validate.duplicate_rows(df, "k", "ord")
    assert found.count() == 300 + 500
    assert {r["k"]: r["copies"] for r in found.filter("k = 'hot'").collect()} == {"hot": 300}
    assert found.select("ord").distinct().count() == 800


def test_keep_first_cuts_a_hot_key_before_the_shuffle(spark):
    plan = validate.keep_first(spark.range(100).selectExpr("id ord", "id % 2 k"), "k", ["ord"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    below = text[text.index("Exchange"):]
    assert "WindowGroupLimit" in below and "Partial" in below


def python_unit(seed, key):
    import hashlib

    return int(hashlib.md5(f"{seed}:{key}".encode()).hexdigest()[:8], 16) / 0xFFFFFFFF


def test_split_follows_the_hash(spark):
    keys = [f"key {i} é" for i in range(500)]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    got = {r["k"]: r["is_test"] for r in with_split(df, "k", 0.2, 7).collect()}
    assert got == {k: python_unit(7, k) < 0.2 for k in keys}
    split = with_split(df, "k")
    assert train_rows(split).count() + held_out_rows(split).count() == 500
    with pytest.raises(ValueError):
        with_split(df, "k", 1.0)


def test_content_digest_ignores_order_and_packaging(spark):
    import hashlib

    keys = [f"k{i}" for i in range(200)]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    whole = content_digest(df, "k").first()
    shuffled = content_digest(df.orderBy(F.rand(3)).repartition(5), "k").first()
    assert whole == shuffled
    words = [[int(hashlib.sha256(k.encode()).hexdigest()[15 * i : 15 * i + 15], 16) for k in keys] for i in range(4)]
    lanes = [sum(w >> shift & 0xFFFFF for w in word) for word in words for shift in (40, 20, 0)]
    text = ":".join(map(str, [len(keys), *lanes]))
    assert whole["content_digest"] == hashlib.sha256(text.encode()).hexdigest()
    assert content_digest(df.limit(199), "k").first() != whole
    assert content_digest(df.limit(0), "k").first()["n_keys"] == 0
