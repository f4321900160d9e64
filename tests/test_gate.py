import numpy as np
import pytest
from pyspark.sql import functions as F

from chunkgate.operators.bootstrap import bootstrap_ci, bootstrap_deltas, poisson_limits, replicate_terms, PRIME
from chunkgate.operators.evaluate import paired_errors, require_paired
from chunkgate.operators.gate import gate, gate_checks


def errors(spark, offset, size=1800, champion=True):
    """Errors between 3 and 13 in steps of a tenth, without a random generator; the champion's are larger by the offset."""
    own = [3 + (37 * i % 101) / 10 for i in range(size)]
    rows = [(f"k{i}", e, e + offset if champion else None) for i, e in enumerate(own)]
    return spark.createDataFrame(rows, "k string, candidate_error double, champion_error double")


def test_clear_winner_promotes(spark):
    row = gate(errors(spark, 2.0), "k").first()
    assert row["promote"] and [c["name"] for c in row["checks"]] == ["sample_floor", "cold_start", "bootstrap_ci"]
    assert row["ci_low"] == pytest.approx(2.0) and row["reason"] == "ci_low 2.000 clears margin 0.5"


def test_equal_models_do_not_promote(spark):
    row = gate(errors(spark, 0.0), "k").first()
    assert not row["promote"] and (row["delta_observed"], row["ci_low"], row["ci_high"]) == (0, 0, 0)


def test_gain_below_the_margin_does_not_promote(spark):
    row = gate(errors(spark, 0.1), "k").first()
    assert not row["promote"] and row["reason"] == "ci_low 0.100 does not clear margin 0.5"


def test_equal_to_the_margin_does_not_promote(spark):
    assert not gate(errors(spark, 0.0), "k", margin=0).first()["promote"]


def test_few_samples_abstain(spark):
    row = gate(errors(spark, 2.0, 10), "k").first()
    assert not row["promote"] and len(row["checks"]) == 1 and row["ci_low"] is None
    assert row["reason"] == "insufficient evidence: 10 below floor of 1000"


def test_cold_start_promotes(spark):
    row = gate(errors(spark, 0.0, champion=False), "k").first()
    assert row["promote"] and len(row["checks"]) == 2 and row["delta_observed"] is None


def test_cold_start_still_needs_samples(spark):
    assert not gate(errors(spark, 0.0, 10, champion=False), "k").first()["promote"]


def test_many_gates_equal_single_gates(spark):
    parts = [("a", errors(spark, 2.0)), ("b", errors(spark, 0.1)), ("c", errors(spark, 2.0, 10)),
             ("d", errors(spark, 1.0, champion=False))]
    together = None
    for name, part in parts:
        part = part.withColumn("g", F.lit(name)).withColumn("k", F.concat(F.lit(name), "k"))
        together = part if together is None else together.unionByName(part)
    rows = {r["g"]: r for r in gate(together, "k", ["g"]).collect()}
    assert {g: r["promote"] for g, r in rows.items()} == {"a": True, "b": False, "c": False, "d": True}
    for name in "abcd":
        alone = gate(together.filter(F.col("g") == name), "k").first()
        assert alone["reason"] == rows[name]["reason"]
    assert gate_checks(gate(together, "k", ["g"]), ["g"]).count() == 3 + 3 + 1 + 2


def test_bad_settings_raise(spark):
    for bad in ({"min_samples": -1}, {"margin": -0.1}, {"n_boot": 0}):
        with pytest.raises(ValueError):
            gate(errors(spark, 0.0, 10), "k", **bad)


def noisy(spark, size=4000):
    rng = np.random.default_rng(3)
    return [(f"k{i}", float(d)) for i, d in enumerate(rng.normal(0.3, 2.0, size))]


def test_bootstrap_ignores_partitioning(spark):
    df = spark.createDataFrame(noisy(spark), "k string, d double")
    one = bootstrap_ci(df.repartition(1), "k", "d", 200).first()
    many = bootstrap_ci(df.repartition(13), "k", "d", 200).first()
    assert one["ci_low"] == pytest.approx(many["ci_low"], abs=1e-9)
    assert one["ci_high"] == pytest.approx(many["ci_high"], abs=1e-9)


def test_bootstrap_agrees_with_resampling(spark):
    rows = noisy(spark)
    got = bootstrap_ci(spark.createDataFrame(rows, "k string, d double"), "k", "d", 1000).first()
    d = np.array([r[1] for r in rows])
    draws = np.random.default_rng(1).integers(0, len(d), (1000, len(d)))
    low, high = np.percentile(d[draws].mean(axis=1), [2.5, 97.5])
    assert got["ci_high"] - got["ci_low"] == pytest.approx(high - low, rel=0.1)
    assert got["ci_low"] == pytest.approx(low, abs=0.02) and got["ci_high"] == pytest.approx(high, abs=0.02)


def test_replicates_equal_brute_force(spark):
    import hashlib

    rows = noisy(spark, 50)
    got = {r["replicate"]: r["delta"] for r in bootstrap_deltas(
        spark.createDataFrame(rows, "k string, d double"), "k", "d", 20, 5).collect()}
    limits = poisson_limits()
    for b, (fa, fb, fc) in enumerate(replicate_terms(20, 5)):
        total = weights = 0.0
        for k, d in rows:
            digest = hashlib.md5(k.encode()).hexdigest()
            mixed = (fa * (int(digest[:8], 16) % PRIME) + fb * (int(digest[8:16], 16) % PRIME) + fc) % PRIME
            w = sum(mixed >= limit for limit in limits)
            total, weights = total + w * d, weights + w
        assert got[b] == pytest.approx(total / weights)


def test_pairing_is_checked(spark):
    left = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "k string, abs_error double")
    right = spark.createDataFrame([("a", 1.5), ("c", 2.0)], "k string, abs_error double")
    require_paired(left, left, "k")
    with pytest.raises(ValueError, match="2 held-out keys"):
        require_paired(left, right, "k")
    assert paired_errors(left, right, "k").count() == 1


def test_replicates_of_groups_and_of_rows_without_a_key(spark):
    import hashlib

    rows = [(g, f"k{i}" if i % 7 else None, float(i) if i % 5 else None) for i in range(60) for g in ("a", None)] + [("empty", "k", None)]
    df = spark.createDataFrame(rows, "g string, k string, d double")
    found = bootstrap_deltas(df, "k", "d", 10, 5, ["g"])
    assert "Generate" not in found._jdf.queryExecution().executedPlan().toString()  # no row for each draw
    got = {(r["g"], r["replicate"]): r["delta"] for r in found.collect()}
    limits = poisson_limits()
    for b, (fa, fb, fc) in enumerate(replicate_terms(10, 5)):
        for g in ("a", None):
            total = weights = 0.0
            for k, d in [r[1:] for r in rows if r[0] == g]:
                w = 8  # a row without a key
                if k is not None:
                    digest = hashlib.md5(k.encode()).hexdigest()
                    mixed = (fa * (int(digest[:8], 16) % PRIME) + fb * (int(digest[8:16], 16) % PRIME) + fc) % PRIME
                    w = sum(mixed >= limit for limit in limits)
                total, weights = total + w * (d or 0.0), weights + w
            assert got[g, b] == pytest.approx(total / weights)
        assert got["empty", b] is None
