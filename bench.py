"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is run to completion into a sink that discards rows. It runs once untimed on the smallest
tables, where they exist, to start workers and compile code. The time of a query includes building it,
with any counting jobs that needs.
"""

import json
import os
import time

from tracklake.plans.queries import QUERIES
from tracklake.session import build_session

HEADLINE = [
    "track_batches", "track_bounds", "last_seen", "sessions", "track_triples", "track_triple_counts",
    "vessel_state_triples", "following_triples", "coopering_triples", "destination_triples", "assessments_by_band",
    "geohash_points", "pack_messages", "message_roundtrip", "graph_messages", "ntriples_roundtrip",
    "monitored_messages", "message_totals", "rolling_rate", "class_rolling_rate", "latest_per_vessel",
    "projected_detections", "kalman_tracks", "filtered_track_triples",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = build_session(
        f"local[{cpus}]", app="tracklake-bench", partitions=int(cpus) if cpus.isdigit() else 8,
        # Emitters turn a small shuffle into much output, so do not merge their input below one task per core.
        **{"spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k", "spark.driver.memory": "12g"},
    )
    spark.sparkContext.setLogLevel("OFF")
    small = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    times = {}
    for name in names:
        if os.path.isdir(small):
            QUERIES[name](spark, small).write.format("noop").mode("overwrite").save()
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total time of headline queries", "value": round(sum(times.values()), 3), "unit": "sec",
                "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()
