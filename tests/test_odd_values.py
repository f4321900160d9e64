"""Values that the given tables don't hold: nulls, NaN, long keys, null groups, texts that only a cast takes for numbers."""

import math

from pyspark.sql import functions as F

from chunkgate.operators import ledger, novelty, profile, ranking, sampling
from chunkgate.operators.gate import gate
from chunkgate.sources.chunks import with_numbers


def test_spreads_of_repeated_keys(spark):
    long = "k" * 100
    rows = [(None, 1.0), (None, 501.0), (long, 1.0), (long, 3.0), ("a", float("nan")), ("a", 2.0), ("b", 9.0)]
    df = spark.createDataFrame(rows, "k string, v double")
    assert {r.k: (r.copies, r.v) for r in profile.dup_spread(df, "k", ["v"]).collect()} == {long: (2, 2.0), "a": (2, 0.0)}
    assert profile.max_dup_spread(df, "k", ["v"]).first()["max_spread"] == 2.0


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(float("nan"), 1), (None, 2), (-4.0, 3)], "v double, i int")
    assert {r.column_name: r.null_rows for r in profile.null_profile(df).collect()} == {"v": 2, "i": 0}
    assert {r.column_name: r.mean_abs for r in profile.mean_abs_ranked(df, ["v", "i"]).collect()} == {"v": 4.0, "i": 2.0}


def test_null_segment_is_decided_like_any_other(spark):
    rows = [(f"{s}{k}", s, 0.5, 2.0 + k % 3) for s in (None, "x") for k in range(60)]
    errors = spark.createDataFrame(rows, "key string, segment string, candidate_error double, champion_error double")
    got = {r.segment: r for r in gate(errors, "key", min_samples=10, margin=0.5, n_boot=50, seed=1, by=["segment"]).collect()}
    assert got[None].promote is True and got["x"].promote is True
    assert not math.isnan(got[None].ci_low)


def test_only_written_numbers_are_numbers(spark):
    df = spark.createDataFrame([("1.5", "1f", "2D", " 7 "), ("-2e3", "2", "3", ".5")], "a string, b string, c string, d string")
    got = with_numbers(df, ["a", "b", "c", "d"])
    assert dict(got.dtypes) == {"a": "double", "b": "string", "c": "string", "d": "double"}
    assert got.agg(F.sum("d")).first()[0] == 7.5


def test_rows_without_an_order_or_id_stay(spark):
    df = spark.createDataFrame([(None,), *((float(k),) for k in range(50)), (float("nan"),)], "v double")
    got = sampling.sequential_chunks(df, "v", 10).collect()
    assert len(got) == 52 and [r.chunk for r in got if r.v is None] == [0] and [r.chunk for r in got if r.v and math.isnan(r.v)] == [5]
    assert sampling.sequential_chunks(df.limit(1), "v", 10).count() == 1
    assert sampling.seeded_sample(df, "v", 60).count() == 52


def test_cuts_come_from_a_sample_of_bounded_size(spark):
    df = spark.range(400_000).select(F.col("id").cast("double").alias("v"))
    cuts = ranking.cut_points(df, "v", 100)
    assert 90 <= len(cuts) <= 100
    sizes = [r["count"] for r in ranking.with_range_bucket(df, "v", cuts).groupBy("_bucket").count().collect()]
    assert sum(sizes) == 400_000 and max(sizes) < 5 * 4_000


def test_versions_of_a_null_model_stay(spark):
    rows = [(m, v, f"2024-01-0{v}", None) for m in (None, "m") for v in (1, 2, 3)]
    state = spark.createDataFrame(rows, "model_name string, version string, promoted_at string, rolled_back_at string")
    got = {(r.model_name, r.version): r.previous_version for r in ledger.previous_champion(state).collect()}
    assert got == {(m, str(v)): v - 1 or None for m in (None, "m") for v in (1, 2, 3)}


def test_rows_without_a_key_count_as_rows(spark):
    incoming, reference = (spark.createDataFrame([(k,) for k in keys], "k string") for keys in (["a", "b", None, None], ["a", None]))
    assert novelty.novelty_facts(incoming, reference, "k").first().asDict() == {
        "incoming_rows": 4, "novel_rows": 1, "novel_fraction": 0.25, "reference_rows": 2,
    }
