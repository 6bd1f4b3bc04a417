"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; one JSON line on stdout."""

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINES = (
    "parse_ok", "match_and_or_not", "multi_route", "route_counts", "decode_json_strings", "iso_to_epoch",
    "order_fanout", "layout_union", "counter_delta_u32", "counter_wrap_u64", "counter_multi_pipeline",
    "counter_dense", "counter_late_fold", "interface_layouts", "dataflow_end_to_end",
)


def main() -> None:
    from pulsegrain.plans.catalog import QUERIES
    from pulsegrain.session import local_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    wanted = sys.argv[1:] or HEADLINES
    spark = local_session(cores, "bench")
    # One small run first, so that starting the JVM and the Python workers is not counted.
    small = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    warm = small if os.path.isdir(small) else sf_dir
    for name in ("dataflow_end_to_end", "counter_late_fold"):
        QUERIES[name](spark, warm).write.format("noop").mode("overwrite").save()
    times = {}
    for name in wanted:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "cpus": cores,
    }))


if __name__ == "__main__":
    main()
