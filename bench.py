"""Time the headline queries: one JSON line, seconds for each query.

Each query runs twice into Spark's no-output sink and the better run counts, so that
the numbers compare plans and not class loading. Both runs do all of the work.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from chunkgate.catalog import registry  # noqa: E402
from chunkgate.session import local_session  # noqa: E402

HEADLINE = [
    "read_chunk", "validated_frame", "validated_lines", "validation_report", "duplicate_rows", "content_digest",
    "seeded_sample", "sequential_chunks", "novelty_facts", "novel_rows", "fingerprint_bits", "ridge_multi",
    "bootstrap_ci", "bootstrap_ci_lines", "gate_decision", "gate_by_segment", "scored_frame", "shortlist",
    "shortlist_by_segment", "describe_target", "dup_spread", "pending_arrivals", "previous_champion",
    "champion_lineage", "stream_score",
]
RUNS = 2


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cores = os.environ.get("BENCH_CPUS") or str(os.cpu_count())
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cores, int(cores) if cores.isdigit() else 8)
    queries = registry.queries()
    seconds = {}
    for name in names:
        times = []
        for _ in range(RUNS):
            start = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(min(times), 3)
    spark.stop()
    print(json.dumps({
        "metric": "total seconds of the headline queries, better of two runs",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir).removeprefix("sf"),
        "cores": cores,
    }))


if __name__ == "__main__":
    main()
