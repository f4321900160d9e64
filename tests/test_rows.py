import hashlib
import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from chunkgate.functions.fingerprint import LEFT, PRIME, RIGHT, SELF, STEP, fingerprint_bits
from chunkgate.operators import novelty, profile, sampling, score
from chunkgate.operators.quantiles import exact_quantiles
from chunkgate.operators.ranking import cut_points, with_range_bucket, with_row_number
from chunkgate.sources.arrivals import arrival_digest, arrival_digests, distinct_arrivals, file_digests
from chunkgate.sources.chunks import read_chunk, read_text_chunk


def brute_bits(tokens, radius, n_bits):
    ids = [int(hashlib.md5(t.encode()).hexdigest()[:8], 16) % PRIME for t in tokens]
    seen = set(ids)
    for r in range(1, radius + 1):
        padded = [0, *ids, 0]
        ids = [(padded[i] * LEFT + padded[i + 1] * SELF + padded[i + 2] * RIGHT + r * STEP) % PRIME
               for i in range(len(ids))]
        seen |= set(ids)
    return sorted({x % n_bits for x in seen})


@pytest.mark.parametrize("radius", [0, 1, 2, 3])
def test_fingerprint_equals_brute_force(spark, radius):
    texts = ["one", "one two", "a b c d e f a b c", "é ü ß"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select("t", fingerprint_bits(F.split("t", " "), radius, 512).alias("b")).collect()
    for r in rows:
        assert r["b"] == brute_bits(r["t"].split(" "), radius, 512)


def test_fingerprint_checks_arguments():
    with pytest.raises(ValueError):
        fingerprint_bits(F.col("t"), -1, 8)


def test_quantiles_equal_numpy_with_a_hot_value(spark):
    rng = np.random.default_rng(5)
    values = np.concatenate([rng.normal(0, 10, 3000), np.full(1500, 2.5)])
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,), (math.nan,)], "x double").repartition(6)
    shares = [0.0, 0.025, 0.25, 0.5, 0.75, 0.975, 1.0]
    assert exact_quantiles(df, "x", shares) == pytest.approx(list(np.percentile(values, [100 * s for s in shares])))
    assert exact_quantiles(df.limit(0), "x", [0.5]) == [None]
    assert exact_quantiles(spark.createDataFrame([(4.0,)], "x double"), "x", [0.1, 0.9]) == [4.0, 4.0]


def test_row_numbers_in_a_hot_group(spark):
    rows = [("hot" if i % 3 else f"g{i % 7}", i) for i in range(2000)]
    df = spark.createDataFrame(rows, "g string, x int").repartition(5)
    got = with_row_number(with_range_bucket(df, "x", cut_points(df, "x", 15)), ["x"], ["g"]).collect()
    seen = {}
    for g, x in sorted(rows, key=lambda r: r[1]):
        seen[(g, x)] = sum(1 for key in seen if key[0] == g) + 1
    assert {(r["g"], r["x"]): r["row_number"] for r in got} == seen


def test_sample_is_exact_and_repeatable(spark):
    df = spark.range(5000).withColumnRenamed("id", "ord")
    first = {r["ord"] for r in sampling.seeded_sample(df, "ord", 777, 7).collect()}
    again = {r["ord"] for r in sampling.seeded_sample(df.repartition(9), "ord", 777, 7).collect()}
    order = sorted(range(5000), key=lambda i: hashlib.md5(f"7:{i}".encode()).hexdigest())
    assert first == again == set(order[:777])
    assert sampling.seeded_sample(df, "ord", 9000, 7).count() == 5000
    one, two = sampling.disjoint_halves(df, "ord", 300, 7)
    assert {r["ord"] for r in one.collect()} == set(order[:300])
    assert {r["ord"] for r in two.collect()} == set(order[300:600])


def test_slices_follow_the_order(spark):
    df = spark.range(1000).select((F.col("id") * 37 % 1009).alias("ord"))
    got = {r["ord"]: r["chunk"] for r in sampling.sequential_chunks(df.repartition(4), "ord", 75).collect()}
    assert got == {v: i // 75 for i, v in enumerate(sorted(got))}


def test_novelty_counts_all_rows_and_matches_keyed_ones(spark):
    long = "x" * 100
    incoming = spark.createDataFrame([(k,) for k in ["a", "a", "n", "n", "n", None, long]], "k string")
    reference = spark.createDataFrame([(k,) for k in ["a", "b", "b", None, long]], "k string")
    facts = novelty.novelty_facts(incoming, reference, "k").first()
    assert tuple(facts) == (7, 3, 0.4286, 5)
    assert novelty.novel_rows(incoming, reference, "k").count() == 3
    assert novelty.known_rows(incoming, reference, "k").count() == 3
    assert novelty.novel_rows(incoming, reference, "k", canonical=True).count() == 3
    empty = novelty.novelty_facts(incoming.limit(0), reference, "k").first()
    assert tuple(empty) == (0, 0, 0.0, 5)


@pytest.mark.parametrize("ascending", [True, False])
def test_nan_and_null_rank_last(spark, ascending):
    rows = [("a", 1.0), ("b", math.nan), ("c", None), ("d", 3.0), ("e", 3.0)]
    df = spark.createDataFrame(rows, "k string, p double")
    ranked = [r["k"] for r in score.shortlist(df, "p", "k", 5, ascending).collect()]
    assert ranked == (["a", "d", "e", "b", "c"] if ascending else ["d", "e", "a", "b", "c"])
    assert score.shortlist(df, "p", "k", 2, ascending).count() == 2
    with pytest.raises(ValueError):
        score.shortlist(df, "p", "k", 0)


def test_segment_shortlist_is_cut_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 3 s", "cast(id as string) k", "cast(id as double) p")
    best = score.shortlist_by_segment(df, ["s"], "p", "k", 2)
    assert best.count() == 6
    text = best._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in text[text.index("Exchange"):]


def test_a_hot_key_is_split_when_rows_are_matched(spark):
    """A third of the incoming rows share one key; the join spreads them over many tasks."""
    incoming = spark.range(60000).selectExpr("id", "if(id % 3 = 0, 'hot', cast(id % 5000 as string)) k", "repeat('x', 50) pad")
    reference = spark.range(4000).selectExpr("cast(id as string) k")
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {name: spark.conf.get(name) for name in small}
    try:
        for name, value in small.items():
            spark.conf.set(name, value)
        novel = novelty.novel_rows(incoming.repartition(8), reference, "k")
        want = sum(1 for i in range(60000) if i % 3 == 0 or i % 5000 >= 4000)
        assert len(novel.select("id", "pad").collect()) == want
        rows = novel.select("id", "pad")
        rows.collect()
        assert "skew=true" in rows._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_histogram_equals_numpy(spark):
    values = np.random.default_rng(2).gamma(2.0, 3.0, 2000)
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    got = [r["n_rows"] for r in profile.histogram(df, "x", 20).orderBy("bin").collect()]
    assert got == list(np.histogram(values, bins=20)[0])
    constant = spark.createDataFrame([(1.0,)] * 3, "x double")
    assert profile.histogram(constant, "x", 4).agg(F.sum("n_rows")).first()[0] == 3


def test_files_are_known_by_their_bytes(spark, folder):
    contents = {"a.csv": b"k,y\na,1\n", "b.csv": b"k,y\na,1\n", "c.csv": b"k,y\nb,2\n", "skip.txt": b"x"}
    for name, data in contents.items():
        with open(os.path.join(folder, name), "wb") as out:
            out.write(data)
    want = {n: hashlib.sha256(d).hexdigest() for n, d in contents.items() if n.endswith(".csv")}
    for limit in (1 << 20, 0):  # inside the JVM, and block by block
        files = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(folder)
        found = file_digests(files, limit)
        assert {os.path.basename(r["path"]): r["digest"] for r in found.collect()} == want
    first = distinct_arrivals(arrival_digests(spark, folder)).collect()
    assert sorted(os.path.basename(r["path"]) for r in first) == ["a.csv", "c.csv"]
    assert arrival_digest(spark, os.path.join(folder, "c.csv")) == want["c.csv"]


def test_chunk_reading_normalises_missing_values(spark, folder):
    path = os.path.join(folder, "chunk.csv")
    with open(path, "w") as out:
        out.write('k,y,z,flag,note\na,1.5,x,True,"q, ""r"""\nNA,inf,2,False,\n,NaN,null,True,n\nb,-2e3,3,,n\n')
    chunk = read_chunk(spark, path, ["y", "z", "flag"]).orderBy("ord")
    kinds = dict(chunk.dtypes)
    assert (kinds["k"], kinds["y"], kinds["z"], kinds["flag"]) == ("string", "double", "string", "double")
    assert [tuple(r)[:5] for r in chunk.collect()] == [
        ("a", 1.5, "x", 1.0, 'q, "r"'), (None, math.inf, "2", 0.0, None), (None, None, None, 1.0, "n"),
        ("b", -2000.0, "3", None, "n"),
    ]


def test_order_column_follows_the_file_however_it_is_split(spark, folder):
    path = os.path.join(folder, "long.csv")
    with open(path, "w") as out:
        out.write("k\n" + "".join(f"key-{i}\n" for i in range(20000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        chunk = read_text_chunk(spark, path)
        assert chunk.rdd.getNumPartitions() > 3
        assert [r["k"] for r in chunk.orderBy("ord").select("k").collect()] == [f"key-{i}" for i in range(20000)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_fingerprint_hashes_the_tokens_of_many_rows_at_once(spark):
    rows = [(["a", None, "b", "a"],), ([],), (None,), ([None],), (["a", "b"] * 40,)]
    df = spark.createDataFrame(rows, "t array<string>")
    found = df.select("t", fingerprint_bits(F.col("t"), 1, 64).alias("b"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "lambda" not in plan  # not token by token in interpreted expressions
    by = {repr(r["t"]): r["b"] for r in found.collect()}
    assert by["None"] is None and by["[]"] == [] and by["[None]"] == [None]
    assert by[repr(rows[0][0])][-1] is None and len(by[repr(rows[0][0])]) >= 4
    assert by[repr(rows[4][0])] == brute_bits(rows[4][0], 1, 64)
