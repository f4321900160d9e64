"""Queries on files when tables are folders of several files."""

import hashlib
import shutil
from pathlib import Path

from chunkgate.catalog import registry

SF = Path("/root/testdata/sf0.001")


def test_arrivals_in_tables_that_are_folders(spark, folder):
    for name in ("orders", "events"):
        spark.read.parquet(str(SF / f"{name}.parquet")).repartition(3).write.parquet(f"{folder}/{name}.parquet")
    shutil.copy(SF / "region.parquet", folder)
    shutil.copy(next(Path(f"{folder}/orders.parquet").glob("*.parquet")), f"{folder}/copy.parquet")
    files = [p for p in Path(folder).rglob("*.parquet") if p.is_file()]
    want = {(str(p.relative_to(folder)), p.stat().st_size, hashlib.sha256(p.read_bytes()).hexdigest()) for p in files}
    assert len(want) == 8
    queries = registry.queries()
    for name in ("arrival_digest", "stream_arrivals"):
        assert {tuple(r) for r in queries[name](spark, folder).collect()} == want
    for name in ("distinct_arrivals", "stream_distinct_arrivals"):
        got = {tuple(r) for r in queries[name](spark, folder).collect()}
        assert len(got) == 7 and got <= want and {r[2] for r in got} == {r[2] for r in want}


def test_pending_arrivals_of_events_in_a_folder(spark, folder):
    for name in ("orders", "lineitem", "events", "documents", "customer", "part", "supplier", "nation", "region"):
        table = spark.read.parquet(str(SF / f"{name}.parquet"))
        table.repartition(3).write.parquet(f"{folder}/{name}.parquet")
    query = registry.queries()["stream_pending"]
    want = sorted(map(tuple, query(spark, str(SF)).collect()))
    assert want and sorted(map(tuple, query(spark, folder).collect())) == want
