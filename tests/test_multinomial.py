"""Exact bootstrap draws against brute force."""

import hashlib
from math import comb

import numpy as np
import pytest

from chunkgate.operators import multinomial as m
from chunkgate.operators.bootstrap import PRIME, bootstrap_ci, replicate_terms
from chunkgate.operators.gate import gate


def rows_of(n, tag="k"):
    return [(f"{tag}{i}", float(d)) for i, d in enumerate(np.random.default_rng(n).normal(0.3, 2.0, n))]


def brute_binomial(size, share, u):
    total = 0.0
    for k in range(size + 1):
        total += comb(size, k) * share**k * (1 - share) ** (size - k)
        if total > u:
            break
    return k


def brute_replicate(rows, terms):
    """Draws of one replicate, bit by bit from the root."""
    a, b, c = terms
    hashes = {k: int(hashlib.md5(k.encode()).hexdigest()[:15], 16) for k, _ in rows}

    def go(keys, level, prefix, draws):
        if len(keys) == 1:
            return {keys[0]: draws}
        left = [k for k in keys if not hashes[k] >> (59 - level) & 1]
        right = [k for k in keys if hashes[k] >> (59 - level) & 1]
        if left and right:
            digest = hashlib.md5(f"{level}:{prefix}".encode()).hexdigest()
            u = ((a * (int(digest[:8], 16) % PRIME) + b * (int(digest[8:16], 16) % PRIME) + c) % PRIME + 0.5) / PRIME
            k = brute_binomial(draws, len(left) / len(keys), u)
            return go(left, level + 1, prefix * 2, k) | go(right, level + 1, prefix * 2 + 1, draws - k)
        return go(keys, level + 1, prefix * 2 + bool(right), draws)

    return go(list(hashes), 0, 0, len(rows))


@pytest.mark.parametrize("bucket_rows", [2048, 7])
def test_draws_equal_brute_force(spark, monkeypatch, bucket_rows):
    monkeypatch.setattr(m, "BUCKET_ROWS", bucket_rows)
    monkeypatch.setattr(m, "CHUNK", 4)
    rows = rows_of(90)
    df = spark.createDataFrame(rows, "k string, d double").repartition(5)
    got = {r["replicate"]: (r["n_draws"], r["delta"]) for r in m.bootstrap_sums(df, "k", "d", 10, 3).collect()}
    for b, terms in enumerate(replicate_terms(10, 3)):
        counts = brute_replicate(rows, terms)
        assert sum(counts.values()) == 90 and got[b] == (90, pytest.approx(sum(counts[k] * d for k, d in rows) / 90))


def test_binomials():
    rng = np.random.default_rng(0)
    size, share, u = rng.integers(0, 300, 500), rng.random(500), rng.random(500)
    assert m.binomials(size, share, u).tolist() == [brute_binomial(int(a), float(b), float(c)) for a, b, c in zip(size, share, u)]
    for n in (10**5, 10**9):
        z = (m.binomials(np.full(4000, n), np.full(4000, 0.37), (np.arange(4000) + 0.5) / 4000) - n * 0.37) / np.sqrt(n * 0.37 * 0.63)
        assert abs(z.mean()) < 0.01 and z.std() == pytest.approx(1, abs=0.01) and (np.diff(z) >= 0).all()
    assert m.binomials(np.array([5, 5]), np.array([0.5, 0.5]), np.array([1.0, 0.0])).tolist() == [5, 0]


def test_every_replicate_draws_as_many_rows_as_there_are(spark):
    rows = [("a", *r) for r in rows_of(5000)] + [("b", *r) for r in rows_of(30, "x")] + [(None, *r) for r in rows_of(2100, "y")] + [("c", "one", 2.0)]
    df = spark.createDataFrame(rows + [("a", None, 1.0), ("a", "no delta", None)], "g string, k string, d double").repartition(6)
    found = m.bootstrap_sums(df, "k", "d", 70, by=["g"]).collect()
    want = {"a": 5000, "b": 30, None: 2100, "c": 1}
    assert len(found) == 4 * 70 and all(r["n_draws"] == want[r["g"]] for r in found)
    assert {r["delta"] for r in found if r["g"] == "c"} == {2.0}
    alone = m.bootstrap_sums(df.where("g = 'b'").drop("g"), "k", "d", 70).collect()
    assert sorted(r["delta"] for r in alone) == pytest.approx(sorted(r["delta"] for r in found if r["g"] == "b"))


def test_buckets_do_not_matter(spark, monkeypatch):
    df = spark.createDataFrame(rows_of(3000), "k string, d double")
    deltas = []
    for rows in (4096, 100):
        monkeypatch.setattr(m, "BUCKET_ROWS", rows)
        deltas.append(sorted((r["replicate"], r["delta"]) for r in m.bootstrap_sums(df.repartition(rows % 7 + 1), "k", "d", 40).collect()))
    assert np.allclose(*deltas)


def test_interval_agrees_with_resampling(spark):
    rows = rows_of(4000)
    got = bootstrap_ci(spark.createDataFrame(rows, "k string, d double"), "k", "d", 1000, method="multinomial").first()
    d = np.array([r[1] for r in rows])
    low, high = np.percentile(d[np.random.default_rng(1).integers(0, len(d), (1000, len(d)))].mean(axis=1), [2.5, 97.5])
    assert got["ci_high"] - got["ci_low"] == pytest.approx(high - low, rel=0.1)
    assert got["ci_low"] == pytest.approx(low, abs=0.02) and got["ci_high"] == pytest.approx(high, abs=0.02)


def test_keys_of_one_hash_share_draws(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 10.0)], "k string, d double")
    found = m.bootstrap_sums(df, "k", "d", 50).collect()
    assert {r["n_draws"] for r in found} == {3} and {round(r["delta"] * 3, 6) for r in found} <= {6.0, 14.0, 22.0, 30.0}
    assert m.bootstrap_sums(df.limit(0), "k", "d", 5).count() == 0


def test_gate_draws_only_for_groups_that_need_an_interval(spark):
    rows = [(g, f"{g}{i}", 1.0 + i % 7, None if g == "cold" else 3.0 + i % 7) for g, n in (("few", 5), ("cold", 40), ("warm", 40)) for i in range(n)]
    df = spark.createDataFrame(rows, "g string, k string, candidate_error double, champion_error double")
    for method in ("poisson", "multinomial"):
        found = {r["g"]: r for r in gate(df, "k", ["g"], min_samples=20, n_boot=50, bootstrap=method).collect()}
        assert {g: r["promote"] for g, r in found.items()} == {"few": False, "cold": True, "warm": True}
        assert found["warm"]["ci_low"] == pytest.approx(2.0) and found["few"]["ci_low"] is None
    with pytest.raises(ValueError, match="multinomial, poisson"):
        gate(df, "k", ["g"], bootstrap="jackknife")
