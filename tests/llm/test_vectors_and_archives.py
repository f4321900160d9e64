"""Whitening, value codes and WARC archives against brute force."""

import base64
import gzip
import hashlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from chunkgate.llm import catalog, value_codes, warc, whitening

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<double>, label int, whitened string, code string, error string, n string, component string, x string"
CLASH = ("mine",) * 6


def odd_vectors(spark, width=6, n=60):
    rng = np.random.default_rng(5)
    good = [(int(i), [float(v) for v in rng.normal(size=width) * np.arange(1, width + 1)], int(i % 3) if i % 4 else None, *CLASH) for i in range(n)]
    bad = [
        (100, None, 1, *CLASH), (101, [], 1, *CLASH), (102, [None] * width, 1, *CLASH), (103, [float("nan")] * width, 1, *CLASH),
        (104, [float("inf")] * width, 1, *CLASH), (105, [1.0] * (width - 1), 1, *CLASH), (106, [1e300] * width, 1, *CLASH),
    ]
    return good, [*good, good[0], (None, good[1][1], 1, *CLASH), *bad]


def brute_whitening(vectors):
    x = [[int(np.floor(1024 * c)) + 100_000 for c in v] for v in vectors]
    n, dims = len(x), len(x[0])
    sums = [sum(r[d] for r in x) for d in range(dims)]
    mean = [Fraction(s, n) for s in sums]
    v = np.array([[float(sum((r[i] - mean[i]) * (r[j] - mean[j]) for r in x) / n) for j in range(dims)] for i in range(dims)])
    values, vectors = np.linalg.eigh(v)
    deviation = [sum((n * r[d] - sums[d]) ** 2 for d in range(dims)) for r in x]
    centred = np.array([[float(r[d] - mean[d]) for d in range(dims)] for r in x])
    return values[::-1], vectors.T[::-1], centred, deviation


def test_whitening_equals_brute_force(spark):
    _, rows = odd_vectors(spark)
    df = spark.createDataFrame(rows, SCHEMA)
    got = whitening.whiten(df, 4).collect()
    kept = rows[:62]
    values, axes, centred, deviation = brute_whitening([r[1] for r in kept])
    assert len(got) == 62 * 4 and {r["n"] for r in got} == {62}
    for k in range(4):
        mine = sorted(((r["deviation"], r["whitened"]) for r in got if r["component"] == k + 1), key=lambda t: (t[0], abs(t[1])))
        want = sorted(zip(map(int, deviation), (centred @ axes[k]) / np.sqrt(values[k])), key=lambda t: (t[0], abs(t[1])))
        assert [int(a) for a, _ in mine] == [a for a, _ in want]
        a, b = (np.array([t[1] for t in side]) for side in (mine, want))
        assert np.abs(a * np.sign(a @ b) - b).max() < 1e-9
    explained = {r["component"]: r["explained"] for r in got}
    assert [explained[k + 1] for k in range(4)] == pytest.approx(list(values[:4] / values.sum()), rel=1e-12)
    assert all(r["identity_error"] < 1e-10 for r in got) and sum(r["vec_id"] is None for r in got) == 4


def test_whitening_of_few_or_equal_vectors(spark):
    schema = "vec_id long, embedding array<double>"
    assert whitening.whiten(spark.createDataFrame([], schema)).count() == 0
    one = whitening.whiten(spark.createDataFrame([(1, [0.5, 0.25])], schema)).collect()
    assert [(r["component"], r["deviation"], r["whitened"], r["identity_error"]) for r in one] == [(1, 0, None, None), (2, 0, None, None)]
    line = whitening.whiten(spark.createDataFrame([(1, [0.0, 0.0]), (2, [1.0, 1.0]), (3, [1.0, 1.0])], schema)).collect()
    assert {r["component"]: r["whitened"] is None for r in line} == {1: False, 2: True}
    assert all(r["identity_error"] < 1e-12 for r in line)


def test_whitening_of_wide_entries_is_exact(spark):
    rows = [(i, [float((-1) ** i * 2**42), float(i), 3.5 * i * i]) for i in range(5)]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 1).collect()
    _, _, _, deviation = brute_whitening([r[1] for r in rows])
    assert {r["vec_id"]: int(r["deviation"]) for r in got} == dict(enumerate(deviation))


@pytest.mark.parametrize("make", [
    lambda q: np.diag([5.0, 5.0, 5.0, 2.0, 1.0, 0.0]), lambda q: q @ np.diag([9.0, 4.0, 4.0, 4.0, 1.0, 1e-9]) @ q.T, lambda q: np.zeros((6, 6)),
    lambda q: q @ np.diag([1 + 1e-13, 1.0, 1 - 1e-13, 0.5, 0.5, 0.5]) @ q.T, lambda q: np.array([[0.0, 1.0], [1.0, 0.0]]), lambda q: np.array([[3.0]]),
    lambda q: q @ np.diag([-1.0, -2.0, 3.0, 1e12, 7.0, 7.0]) @ q.T,
])
def test_spectrum(make):
    q, _ = np.linalg.qr(np.random.default_rng(2).standard_normal((6, 6)))
    a = make(q)
    a = (a + a.T) / 2
    values, vectors = whitening.Spectrum(a).leading(4)
    want = np.linalg.eigvalsh(a)[::-1][:4]
    norm = np.abs(a).sum(axis=1).max()
    assert values == pytest.approx(want, abs=1e-13 * max(norm, 1e-300))
    assert np.abs(a @ vectors.T - vectors.T * values).max() <= 1e-13 * norm
    assert vectors @ vectors.T == pytest.approx(np.eye(len(values)), abs=1e-9)


def test_factors_count_and_solve():
    rng = np.random.default_rng(8)
    for n in (1, 2, 5, 30):
        a = rng.standard_normal((n, n))
        a = a + a.T
        factors = whitening.factorise(a)
        assert factors.positive() == (np.linalg.eigvalsh(a) > 0).sum()
        b = rng.standard_normal(n)
        assert a @ factors.solve(b) == pytest.approx(b, abs=1e-8)


def brute_codes(rows, parts, entries, rounds, scale=256):
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    x = [[int(np.floor(scale * c)) for c in v] for _, v, _ in rows]
    width = len(x[0]) // parts
    book = [[r[p * width : (p + 1) * width] for r in x[:entries]] for p in range(parts)]

    def nearest(r, p):
        own = r[p * width : (p + 1) * width]
        return min((sum((a - b) ** 2 for a, b in zip(own, e)), k) for k, e in enumerate(book[p]))

    for _ in range(rounds):
        for p in range(parts):
            homes = [nearest(r, p)[1] for r in x]
            for k in range(len(book[p])):
                mine = [r[p * width : (p + 1) * width] for r, h in zip(x, homes) if h == k]
                if mine:
                    book[p][k] = [sum(c) // len(mine) for c in zip(*mine)]
    found = [[nearest(r, p) for p in range(parts)] for r in x]
    out = [(r[0], "".join(f"{k:02x}" for _, k in f), sum(d for d, _ in f), r[2]) for r, f in zip(rows, found)]
    by_label = {}
    for _, _, e, label in out:
        by_label[label] = by_label.get(label, 0) + e
    digest = hashlib.sha256(",".join(str(c) for part in book for e in part for c in e).encode()).hexdigest()
    return sorted(((i, c, e, by_label[label]) for i, c, e, label in out), key=str), digest


def test_value_codes_equal_brute_force(spark):
    _, rows = odd_vectors(spark)
    coded, book = value_codes.compress(spark.createDataFrame(rows, SCHEMA).repartition(5), parts=3, entries=7)
    got = value_codes.with_label_error(coded).select("vec_id", "code", "error", "label_error").collect()
    want, digest = brute_codes([r[:3] for r in rows[:62]], 3, 7, 2)
    assert sorted((tuple(r) for r in got), key=str) == want and value_codes.codebooks_digest(book) == digest
    near = {r["vec_id"]: r["embedding"] for r in value_codes.decode(coded, book).collect()}
    x = {r[0]: np.floor(256 * np.array(r[1])) for r in rows[:60]}
    errors = {r["vec_id"]: r["error"] for r in coded.collect()}
    assert all(((256 * np.array(near[i]) - x[i]) ** 2).sum() == errors[i] for i in x)


def test_value_codes_of_odd_tables(spark):
    schema = "vec_id long, embedding array<double>, label string"
    coded, book = value_codes.compress(spark.createDataFrame([], schema))
    assert coded.count() == 0 and book == []
    coded, book = value_codes.compress(spark.createDataFrame([(1, [0.5, -0.001, 2.0], "a"), (2, [0.5, -0.001, 2.0], None)], schema), parts=2)
    assert [(r["vec_id"], r["code"], r["error"]) for r in coded.orderBy("vec_id").collect()] == [(1, "0000", 0), (2, "0000", 0)]
    assert [b.tolist() for b in book] == [[[128, -1], [128, -1]], [[512], [512]]]


def test_value_codes_query(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    got = catalog.op12_value_codes(spark, SF).collect()
    want, digest = brute_codes([(r["vec_id"], list(r["embedding"]), r["label"]) for r in rows], 16, 64, 2)
    assert sorted((tuple(r)[:4] for r in got), key=str) == want and {r["codebooks_sha256"] for r in got} == {digest}


def test_whitening_query(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").collect()
    got = catalog.op11_whitening(spark, SF).orderBy("vec_id", "component").collect()
    values, axes, centred, deviation = brute_whitening([list(r["embedding"]) for r in rows])
    w = np.array([r["whitened"] for r in got]).reshape(-1, 8)
    want = centred @ axes[:8].T / np.sqrt(values[:8])
    assert np.abs(w * np.sign((w * want).sum(axis=0)) - want).max() < 1e-8
    assert [r["deviation"] for r in got[::8]] == list(map(int, deviation)) and got[0]["identity_error"] < 1e-9


PAGES = [
    (1, "http://www.Example.org/a?x=1#part", "<p>one</p>", "mine", "mine"), (2, "https://example.org:443/", "<p>two</p>", "mine", "mine"),
    (3, "http://b.example.org/z", "<p>one</p>", "mine", "mine"), (0, "http://b.example.org/z", "<p>one</p>", "mine", "mine"),
    (4, None, None, "mine", "mine"), (5, "", "", "mine", "mine"), (5, "", "", "mine", "mine"), (6, "no url at all\r\nWARC-Type: bad", "a\r\n\r\nWARC/1.1\r\n", "mine", "mine"),
    (None, "http://ü.example.org/ä b", "<p>two</p>", "mine", "mine"), (None, "http://only.example.org", "alone", "mine", "mine"), (None, "x", "alone", "mine", "mine"),
    (7, "http://long.example.org/" + "y" * 5000, "z" * 300_000, "mine", "mine"), (8, "http://1.2.3.4:8080/p", "<p>ip</p>", "mine", "mine"),
    (9, "http://u:p@[::1]/q", "<p>six</p>", "mine", "mine"),
]


def brute_records(pages, least=0):
    first = {}
    for i, _, html, *_ in pages:
        if i is not None and len((html or "").encode()) >= least:
            first[html or ""] = min(i, first.get(html or "", i))
    out = []
    for i, _, html, *_ in pages:
        data = (html or "").encode()
        to = first.get(html or "", i) if len(data) >= least else i
        kind = "response" if to == i else "revisit"
        out.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), kind, None if kind == "response" else to))
    return sorted(out, key=str)


def page_table(spark):
    return spark.createDataFrame(PAGES, "page_id long, url string, html string, key string, archive string").repartition(3)


@pytest.mark.parametrize("least", [0, 12])
def test_archives_round_trip(spark, folder, least):
    pages = page_table(spark)
    archives = warc.write_archives(pages, f"{folder}/warc", least)
    warc.write_index(archives, f"{folder}/index", block_captures=2)
    for top in (1 << 16, 1):
        index = warc.open_index(spark, f"{folder}/index", top)
        places = warc.look_up(index, pages.select(warc.capture_key("url").alias("key")), wanted_keys=1)
        got = warc.read_records(archives, places).collect()
        assert sorted((tuple(r[c] for c in ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")) for r in got), key=str) == brute_records(PAGES, least)
        texts = {r["page_id"]: (r["payload"] or b"").decode() for r in got if r["record_type"] == "response"}
        assert all(texts[i] == (html or "") for i, _, html, *_ in PAGES if i in texts and i is not None)


def test_single_keys_are_found(spark, folder):
    archives = warc.write_archives(page_table(spark), f"{folder}/warc")
    warc.write_index(archives, f"{folder}/index", block_captures=1)
    index = warc.open_index(spark, f"{folder}/index", 3)
    keys = spark.createDataFrame([("org,example,b)/z",), ("org,example,b)/z",), ("org,example,b)/y",), (None,)], "key string")
    places = warc.look_up(index, keys)
    assert sorted(r["page_id"] for r in warc.read_records(archives, places).collect()) == [0, 3]
    long = spark.createDataFrame([("org,example,long)/" + "y" * n,) for n in (4999, 5000, 5001)], "key string")
    assert [r["page_id"] for r in warc.read_records(archives, warc.look_up(index, long)).collect()] == [7]


def test_archive_is_a_file_of_records(spark, folder):
    archives = warc.write_archives(page_table(spark).coalesce(1), f"{folder}/warc")
    (number,) = archives.select("archive").distinct().first()
    data = gzip.decompress(b"".join(warc.archive_bytes(archives, number)))
    kinds, at = [], 0
    while at < len(data):
        headers, block = warc.parse(data[at:])
        kinds.append(headers["warc-type"])
        at = data.index(b"\r\n\r\n", at) + 4 + len(block) + 4
    n = len(PAGES)
    assert kinds[0] == "warcinfo" and len(kinds) == 1 + archives.select(F.explode("captures")).count() <= n + 1


def test_capture_keys(spark):
    want = {
        "http://www.Example.org/a?x=1#part": "org,example,www)/a?x=1", "https://example.org:443": "org,example)/", "//h.de:81/x": "de,h:81)/x",
        "http://1.2.3.4:8080/p": "1.2.3.4:8080)/p", "http://u:p@[::1]/q": "[::1])/q", "mailto:a@b.c": "mailto:a@b.c", "http://a.b?q": "b,a)/?q", "": "",
    }
    rows = spark.createDataFrame([(u,) for u in want], "url string").select("url", warc.capture_key("url").alias("k")).collect()
    assert {r["url"]: r["k"] for r in rows} == want


def test_no_pages(spark, folder):
    archives = warc.write_archives(page_table(spark).limit(0), f"{folder}/warc")
    warc.write_index(archives, f"{folder}/index")
    index = warc.open_index(spark, f"{folder}/index")
    keys = spark.createDataFrame([("org,example)/",)], "key string")
    assert warc.read_records(archives, warc.look_up(index, keys)).count() == 0


def test_warc_query(spark):
    pages = [tuple(r) for r in spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url", "html").collect()]
    assert sorted((tuple(r) for r in catalog.op13_warc(spark, SF).collect()), key=str) == brute_records(pages)
