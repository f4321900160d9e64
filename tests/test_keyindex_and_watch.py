"""Stored key sets, observed drops, signatures, and what a watcher does with order, copies and failures."""

import os
import re
import shutil

import pytest
from pyspark.sql import functions as F
from test_plans import book, rows, settings, write_csv  # noqa: F401

from chunkgate.operators import novelty, profile, validate
from chunkgate.plans.registry import retrain_advice
from chunkgate.plans.score import score_chunk
from chunkgate.plans.train import load_champion, train_chunk
from chunkgate.sources.chunks import read_text_chunk
from chunkgate.sources.keyindex import KeyIndex
from chunkgate.streaming.watch import watch_training


def keyed(spark, keys):
    return spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k string, i int").repartition(3)


def test_index_equals_the_reference_keys(spark, folder):
    chunks = [["a", "b", "b", None], ["c" * 100, "a"], [], ["", "d"]]
    index = KeyIndex(spark, folder, 8)
    assert [index.append(str(i), keyed(spark, c), "k") for i, c in enumerate(chunks)] == [2, 1, 0, 2]
    reference = keyed(spark, [k for c in chunks for k in c])
    for arriving in (["a", "x", "x", None, "c" * 100], [], [None], ["d", "d", ""]):
        chunk = keyed(spark, arriving)
        assert index.novelty_facts(chunk, "k").collect() == novelty.novelty_facts(chunk, reference, "k").collect()
        assert sorted(map(str, index.novel_rows(chunk, "k").collect())) == sorted(map(str, novelty.novel_rows(chunk, reference, "k").collect()))
    assert index.append("1", keyed(spark, ["new"]), "k") == 0 and index.keys().count() == 5


def test_an_append_that_failed_half_way_can_be_repeated(spark, folder):
    index = KeyIndex(spark, folder, 4)
    index.append("one", keyed(spark, ["a", "b"]), "k")
    shutil.rmtree(f"{folder}/chunks")  # keys were written, the log was not
    assert index.append("one", keyed(spark, ["a", "b", "c"]), "k") == 1
    assert index.keys().count() == 3 and index.log().first()["n_rows"] == 3


def test_only_touched_partitions_are_read(spark, folder):
    index = KeyIndex(spark, folder, 64)
    index.append("all", keyed(spark, [f"key {i}" for i in range(500)]), "k")
    _, known = index.met(keyed(spark, ["key 7", "key 8", "no key"]), "k")
    plan = known._jdf.queryExecution().executedPlan().toString()
    touched = re.search(r"PartitionFilters: \[[^\]]*bucket#\d+ (?:IN \(([\d,]+)\)|= (\d+))", plan)
    assert 1 <= len((touched[1] or touched[2]).split(",")) <= 3 and known.count() == 2


def test_advice_from_an_index(spark, book, folder):  # noqa: F811
    reference = read_text_chunk(spark, write_csv(f"{folder}/ref.csv", rows(0, 100)))
    index = KeyIndex(spark, f"{folder}/index")
    index.append("ref", reference, "name")
    path = write_csv(f"{folder}/new.csv", rows(90, 40))
    a, b = (retrain_advice(spark, path, r, settings(), book).first() for r in (reference, index))
    assert a == b and a["novel_rows"] == 30


def test_runs_carry_what_validation_dropped(spark, book, folder):  # noqa: F811
    data = [*rows(0, 400), *rows(0, 25), ("", 1.0), (" ", 2.0), ("late", None)]
    train_chunk(spark, write_csv(f"{folder}/one.csv", data), settings(), book)
    run = book.read("runs").first()
    assert (run["raw_rows"], run["null_rows"], run["unparseable_rows"], run["duplicate_rows"]) == (428, 2, 1, 25)


def test_counts_equal_the_report(spark):
    df = spark.createDataFrame([("a", 1.0, 1), ("A ", 2.0, 2), (None, 1.0, 3), ("b", float("nan"), 4), ("  ", 1.0, 5), ("c", None, 6)], "k string, t double, o int")
    valid, dropped = validate.validated_and_counted(df, "k", "t", ["o"])
    assert valid.count() == 1
    assert dropped.counts == validate.validation_report(df, "k", "t").first().asDict()


def test_champions_with_other_features_or_files_raise(spark, book, folder):  # noqa: F811
    chunk = write_csv(f"{folder}/one.csv", rows(0, 300))
    train_chunk(spark, chunk, settings(), book)
    assert load_champion(book, "m", settings()) is not None
    with pytest.raises(ValueError, match="64 bits"):
        score_chunk(spark, chunk, settings(fp_bits=64), book)
    with open(f"{book.champion('m')['model_path']}/metadata/more", "w") as out:
        out.write("x")
    with pytest.raises(ValueError, match="not those that were registered"):
        load_champion(book, "m")


def watched(spark, landing, folder, book, reference, checkpoint, **changes):  # noqa: F811
    seen = []
    watch_training(
        spark, landing, reference, settings(**changes), book, f"{folder}/{checkpoint}", None, lambda path, outcome: seen.append((os.path.basename(path), outcome))
    ).awaitTermination()
    return seen


def test_files_are_taken_by_path_and_failures_again_in_the_next_session(spark, book, folder):  # noqa: F811
    landing = f"{folder}/landing"
    os.mkdir(landing)
    for i, name in enumerate("cba"):
        write_csv(f"{landing}/{name}.csv", rows(300 * i, 300))
        os.utime(f"{landing}/{name}.csv", (1700000000 + i, 1700000000 + i))
    shutil.copy(f"{landing}/a.csv", f"{landing}/aa.csv")
    reference = read_text_chunk(spark, write_csv(f"{folder}/ref.csv", rows(0, 10)))
    assert watched(spark, landing, folder, book, reference, "state", numeric=("note",), target="absent") == [(f"{n}.csv", "parked") for n in "abc"]
    # The same checkpoint: the stream has nothing new, the failed files are tried again.
    again = watched(spark, landing, folder, book, reference, "state")
    assert [name for name, _ in again] == ["a.csv", "b.csv", "c.csv"] and again[0][1] == "promoted" and "parked" not in dict(again).values()
    assert watched(spark, landing, folder, book, reference, "state") == []


def test_sketches_of_chunks(spark):
    a, b = ({f"k{i}" for i in part} for part in (range(0, 3000), range(2000, 6000)))
    df = spark.createDataFrame([("a", k) for k in a] + [("b", k) for k in b] + [("b", None)], "c string, k string")
    sketches = profile.key_sketches(df, "k", ["c"])
    found = {r["c"]: r["n_keys"] for r in profile.sketched_keys(sketches, ["c"]).collect()}
    assert found["a"] == pytest.approx(3000, rel=0.02) and found["b"] == pytest.approx(4000, rel=0.02)
    both = profile.sketched_overlap(sketches.where("c = 'a'"), sketches.where("c = 'b'")).first()
    assert both["all_keys"] == pytest.approx(6000, rel=0.02) and both["shared_keys"] == pytest.approx(1000, abs=120)
    none = profile.sketched_overlap(sketches.where("c = 'a'"), sketches.where(F.lit(False))).first()
    assert (none["right_keys"], none["shared_keys"]) == (0, 0)
