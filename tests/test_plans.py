import hashlib
import os
import shutil
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from chunkgate.operators import ledger as questions
from chunkgate.plans.registry import explain_run, retrain_advice, rollback
from chunkgate.plans.score import score_chunk
from chunkgate.plans.settings import Settings
from chunkgate.plans.train import load_champion, train_chunk
from chunkgate.sources.chunks import read_text_chunk
from chunkgate.session import scratch_dir
from chunkgate.sources.arrivals import arrival_digest, file_digests
from chunkgate.sources.ledger import Ledger
from chunkgate.streaming.arrivals import BINARY_SCHEMA, append_stream, stream_distinct_arrivals
from chunkgate.streaming.watch import watch_scoring, watch_training

WORDS = ["ring", "chain", "acid", "salt", "gold", "iron", "zinc", "lead"]


def rows(start, n):
    """Keys of 3-9 words; the target counts 'acid' and the words."""
    out = []
    for i in range(start, start + n):
        digits = [int(c, 16) % 8 for c in hashlib.md5(str(i).encode()).hexdigest()][: 3 + i % 7]
        words = [WORDS[d] for d in digits] + [f"id{i}"]
        out.append((" ".join(words), 10.0 * words.count("acid") + len(words)))
    return out


def write_csv(path, data):
    with open(path, "w") as out:
        out.write("name,energy,note\n" + "".join(f"{k},{'' if y is None else y},n\n" for k, y in data))
    return str(path)


def settings(**changes):
    base = dict(key="name", target="energy", model_name="m", fp_bits=128, fp_radius=1, min_samples=50, margin=0.1, n_boot=200)
    return Settings(**{**base, **changes})


@pytest.fixture
def book(spark, folder):
    return Ledger(spark, f"{folder}/ledger")


def test_train_score_explain_and_roll_back(spark, book, folder):
    chunk = write_csv(f"{folder}/one.csv", rows(0, 600))
    assert load_champion(book, "m") is None
    with pytest.raises(ValueError, match="there is no champion"):
        score_chunk(spark, chunk, settings(), book)

    first = train_chunk(spark, chunk, settings(), book)
    assert first.decision["promote"] and first.version == 1 and "first champion" in first.decision["reason"]
    second = train_chunk(spark, chunk, settings(kind="ridge"), book)
    assert second.decision["promote"] and second.version == 2
    assert second.decision["ci_low"] > 0.1 and second.decision["candidate_mae"] < first.decision["candidate_mae"]
    third = train_chunk(spark, chunk, settings(kind="ridge"), book)
    assert not third.decision["promote"] and third.version is None

    runs = book.read("runs").orderBy("start_time").collect()
    assert [r["status"] for r in runs] == ["FINISHED"] * 3
    assert len({r["dataset_content_hash"] for r in runs}) == 1 and len({r["config_hash"] for r in runs}) == 2
    assert runs[0]["raw_data_hash"] == hashlib.sha256(open(chunk, "rb").read()).hexdigest()
    assert book.read("versions").count() == 2 and book.champion("m")["version"] == 2

    out = f"{folder}/shortlist.csv"
    best = score_chunk(spark, chunk, settings(shortlist_size=20, rank_ascending=False), book, out)
    assert best.columns == ["name", "energy", "note", "predicted_energy"] and best.count() == 20
    back = [float(r["predicted_energy"]) for r in spark.read.csv(out, header=True).collect()]
    assert back == sorted(back, reverse=True) and len(back) == 20

    story = explain_run(book)
    assert story.startswith("candidate mae: ") and "promote=False" in story and "[FAIL] bootstrap_ci" in story
    assert "[PASS] sample_floor" in explain_run(book, second.run_id)
    assert book.read("annotations").count() == 2

    assert rollback(book, "m", "drift") == 1
    state = {r["version"]: r for r in book.state().collect()}
    assert book.champion("m")["version"] == 1
    assert state[2]["rollback_reason"] == "drift" and state[2]["rolled_back_at"] is not None
    assert state[1]["rolled_back_at"] is None
    with pytest.raises(ValueError, match="no earlier version"):
        rollback(book, "m", "again")


def test_same_keys_in_other_packaging_have_the_same_content(spark, book, folder):
    data = rows(0, 300)
    one = write_csv(f"{folder}/a.csv", data)
    two = write_csv(f"{folder}/b.csv", [(k.upper(), y) for k, y in reversed(data)] + data[:5])
    train_chunk(spark, one, settings(), book)
    train_chunk(spark, two, settings(), book)
    found = book.read("runs").select("raw_data_hash", "dataset_content_hash").collect()
    assert len({r[0] for r in found}) == 2 and len({r[1] for r in found}) == 1


def test_a_folder_of_parquet_files_is_a_chunk(spark, book, folder):
    data = rows(0, 600)
    df = spark.createDataFrame(data, "name string, energy double")
    df.repartition(3).write.parquet(f"{folder}/wide")
    df.repartition(3).write.parquet(f"{folder}/again")
    df.limit(599).repartition(3).write.parquet(f"{folder}/less")
    change = settings(file_format="parquet")
    assert train_chunk(spark, f"{folder}/wide", change, book).version == 1
    train_chunk(spark, write_csv(f"{folder}/one.csv", data), settings(), book)
    one, two = book.read("runs").orderBy("start_time").collect()
    assert one["dataset_content_hash"] == two["dataset_content_hash"]
    assert one["candidate_mae"] == pytest.approx(two["candidate_mae"])
    assert arrival_digest(spark, f"{folder}/less") != one["raw_data_hash"] != two["raw_data_hash"]
    assert score_chunk(spark, f"{folder}/wide", change, book).count() == 100
    assert retrain_advice(spark, f"{folder}/wide", df, change, book).first()["novel_rows"] == 0
    with pytest.raises(ValueError, match="csv or parquet"):
        score_chunk(spark, f"{folder}/wide", settings(file_format="orc"), book)


def test_crash_leaves_one_failed_run(spark, book, folder):
    bad = write_csv(f"{folder}/bad.csv", [("", 1.0), ("x", None)])
    with pytest.raises(ValueError, match="none of the chunk"):
        train_chunk(spark, bad, settings(), book)
    run, = book.read("runs").collect()
    assert (run["status"], run["failure"]["error_type"], run["failure"]["raw_path"]) == ("FAILED", "ValueError", bad)
    assert run["raw_data_hash"] == hashlib.sha256(open(bad, "rb").read()).hexdigest()
    assert run["dataset_content_hash"] is None and book.read("versions").count() == 0
    assert explain_run(book).startswith("run failed with ValueError")
    assert [r["raw_data_hash"] for r in questions.retryable_arrivals(book.read("runs")).collect()] == [run["raw_data_hash"]]


def test_missing_file_is_recorded_as_unreadable(spark, book, folder):
    with pytest.raises(Exception):
        train_chunk(spark, f"{folder}/none.csv", settings(), book)
    assert book.read("runs").first()["raw_data_hash"] == "unreadable"


def test_lost_champion_is_not_a_cold_start(spark, book, folder):
    chunk = write_csv(f"{folder}/one.csv", rows(0, 300))
    train_chunk(spark, chunk, settings(), book)
    path = book.champion("m")["model_path"]
    os.rename(path, path + "-gone")
    with pytest.raises(Exception):
        load_champion(book, "m")


@pytest.mark.parametrize("whole_file_bytes", [1 << 20, 0])
def test_streamed_digests_of_small_and_large_files(spark, folder, whole_file_bytes):
    landing = f"{folder}/landing"
    os.mkdir(landing)
    for i in range(3):
        write_csv(f"{landing}/{i}.csv", rows(i % 2, 3))  # the first and the last are alike
    files = spark.readStream.format("binaryFile").schema(BINARY_SCHEMA).option("maxFilesPerTrigger", 1).load(landing)
    found = stream_distinct_arrivals(file_digests(files, whole_file_bytes))
    append_stream(found, f"{folder}/out", f"{folder}/state").awaitTermination()
    want = {hashlib.sha256(open(f"{landing}/{i}.csv", "rb").read()).hexdigest() for i in range(3)}
    got = [r["digest"] for r in spark.read.parquet(f"{folder}/out").collect()]
    assert len(got) == 2 and set(got) == want


def test_a_cluster_must_name_a_shared_folder():
    class Conf:
        def get(self, name, default):
            return default

    class Fake:
        conf = Conf()

        class sparkContext:
            master = "spark://host:7077"

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_dir(Fake(), "x")
    Fake.sparkContext.master = "local[4]"
    assert os.path.basename(scratch_dir(Fake(), "x")).startswith("x-")


def stamp(hour):
    return datetime(2024, 8, 24, hour)


def test_rollback_skips_a_version_rolled_back_since(book):
    for version in (1, 2, 3):
        book.register("m", version, f"r{version}", "none")
    book.tag("m", 1, "promoted_at", stamp(1))
    book.tag("m", 2, "promoted_at", stamp(2))
    book.tag("m", 2, "rolled_back_at", stamp(3))
    book.tag("m", 3, "promoted_at", stamp(4))
    book.point_alias("m", 3, stamp(4))
    assert rollback(book, "m", "test") == 1
    demoted = book.state().filter("version = 3").first()
    assert demoted["rollback_reason"] == "test" and demoted["rolled_back_at"] is not None


def test_eligibility_edges_and_numeric_order(spark):
    state = spark.createDataFrame(
        [("m", v, p, r) for v, p, r in [
            (2, stamp(1), stamp(1)),  # rolled back at its promotion: not eligible
            (9, stamp(5), stamp(4)),  # promoted again after a rollback: eligible
            (10, stamp(6), None),
            (11, None, None),
            (12, stamp(7), None)]],
        "model_name string, version bigint, promoted_at timestamp, rolled_back_at timestamp")
    current = state.filter("version = 12")
    assert {r["version"] for r in questions.eligible_versions(state, current).collect()} == {9, 10}
    assert questions.rollback_target(state, current).first()["target_version"] == 10
    previous = {r["version"]: r["previous_version"] for r in questions.previous_champion(state).collect()}
    assert previous == {2: None, 9: None, 10: 9, 11: 10, 12: 10}


def test_previous_champion_across_blocks(spark, monkeypatch):
    monkeypatch.setattr(questions, "VERSION_BLOCK", 4)
    df = spark.range(1, 60).selectExpr(
        "'m' model_name", "id version", "if(id % 5 = 0, timestamp'2024-01-01', null) promoted_at",
        "cast(null as timestamp) rolled_back_at")
    got = {r["version"]: r["previous_version"] for r in questions.previous_champion(df).collect()}
    assert got == {v: ((v - 1) // 5 * 5 or None) for v in range(1, 60)}


def test_settings_are_checked():
    for bad in ({"test_fraction": 1}, {"fp_bits": 0}, {"fp_radius": -1}, {"shortlist_size": 0}, {"kind": "tree"},
                {"model_name": " "}, {"margin": -1}, {"n_boot": 0}, {"min_samples": -1}):
        with pytest.raises(ValueError):
            settings(**bad)


def test_advice_counts_novel_rows(spark, book, folder):
    reference = read_text_chunk(spark, write_csv(f"{folder}/ref.csv", rows(0, 100)))
    path = write_csv(f"{folder}/new.csv", rows(90, 40))
    cold = retrain_advice(spark, path, reference, settings(), book).first()
    assert cold["retrain"] and cold["reason"] == "no champion yet"
    train_chunk(spark, write_csv(f"{folder}/one.csv", rows(0, 300)), settings(), book)
    warm = retrain_advice(spark, path, reference, settings(), book).first()
    assert (warm["incoming_rows"], warm["novel_rows"], warm["novel_fraction"]) == (40, 30, 0.75)
    assert warm["retrain"] and warm["champion_version"] == 1 and warm["champion_model_kind"] == "dummy"
    assert not retrain_advice(spark, path, reference, settings(retrain_threshold=0.9), book).first()["retrain"]


def test_watching_trains_skips_parks_and_scores(spark, book, folder):
    landing = f"{folder}/landing"
    os.mkdir(landing)
    write_csv(f"{landing}/1.csv", rows(0, 300))
    shutil.copy(f"{landing}/1.csv", f"{landing}/2.csv")  # same bytes: skipped
    write_csv(f"{landing}/3.csv", [("", 1.0)])  # no valid row: parked
    write_csv(f"{landing}/4.csv", rows(0, 290))  # nothing new: advised against
    reference = read_text_chunk(spark, write_csv(f"{folder}/ref.csv", rows(0, 400)))
    for i, name in enumerate(sorted(os.listdir(landing))):
        os.utime(f"{landing}/{name}", (1700000000 + i, 1700000000 + i))
    seen = {}

    def watch(checkpoint):
        watch_training(spark, landing, reference, settings(), book, f"{folder}/{checkpoint}", None,
                       lambda path, outcome: seen.__setitem__(os.path.basename(path), outcome)).awaitTermination()

    watch("state")
    # The first file trains on a cold start; then nothing in the fourth is novel.
    assert seen == {"1.csv": "promoted", "3.csv": "advised against", "4.csv": "advised against"}
    write_csv(f"{landing}/5.csv", rows(1000, 300))
    with open(f"{landing}/6.csv", "w") as out:
        out.write("name,note\nbrand new,n\n")  # the target column is missing
    watch("state")
    assert seen["6.csv"] == "parked" and seen["5.csv"] in ("promoted", "rejected") and len(seen) == 5
    assert sorted(r["status"] for r in book.read("runs").collect()) == ["FAILED", "FINISHED", "FINISHED"]
    # A new session with a new checkpoint skips what a finished run was trained on.
    seen.clear()
    watch("other")
    assert "1.csv" not in seen and "2.csv" not in seen and "5.csv" not in seen and seen["6.csv"] == "parked"

    out = f"{folder}/scored"
    watch_scoring(spark, landing, settings(shortlist_size=7), book, out, f"{folder}/score", None).awaitTermination()
    lists = os.listdir(out)
    assert len(lists) == 3  # files 1, 4 and 5; the copy is the same arrival
    batch = score_chunk(spark, f"{landing}/4.csv", settings(shortlist_size=7), book).select("name").collect()
    digest = hashlib.sha256(open(f"{landing}/4.csv", "rb").read()).hexdigest()
    streamed = spark.read.csv(f"{out}/{digest}", header=True).select("name").collect()
    assert [r["name"] for r in streamed] == [r["name"] for r in batch]


def test_scoring_does_not_validate_a_good_chunk_twice(spark, book, folder, monkeypatch):
    chunk = write_csv(f"{folder}/one.csv", rows(0, 600))
    train_chunk(spark, chunk, settings(kind="ridge"), book)
    asked = []
    monkeypatch.setattr("chunkgate.plans.score.require_rows", lambda valid, n: asked.append(n))
    assert score_chunk(spark, chunk, settings(), book).count() > 0 and not asked
    bare = write_csv(f"{folder}/bare.csv", [(None, 1.0), ("x", None)])
    score_chunk(spark, bare, settings(), book)
    assert asked == [2]


def test_keys_without_blanks_collapse_as_others_do(spark):
    from chunkgate.functions.keys import collapsed_text

    texts = ["Ab", " Ab  c\t", "", "  ", None, "é X", "a\nB"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(collapsed_text(F.col("t")).alias("k")).collect()
    assert [r.k for r in got] == ["ab", "ab c", None, None, None, "é x", "a b"]
