"""Bench: wall time of the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Every query is fully executed through the ``noop`` sink (no collect to the
driver). Prints ONE JSON line on stdout.
"""
from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["model_input", "segment_performance", "ranking_metrics", "profit_curve", "score_psi", "woe_iv_table", "auc_bootstrap"]
WARM_UP = "unique_key_check"  # run once, not measured: JVM start and code generation


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES")
    names = names.split(",") if names else HEADLINE

    from lendspark.plans import catalog
    from lendspark.session import local_session

    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "16")))
    spark.sparkContext.setLogLevel("ERROR")
    qs = catalog.queries()
    times: dict[str, float] = {}
    qs[WARM_UP](spark, sf_dir).write.format("noop").mode("overwrite").save()
    for name in names:
        t0 = time.perf_counter()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
        print(f"{name}: {times[name]}s", file=sys.stderr)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "headline_wall_time", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": cpus, "memory": os.environ.get("LENDSPARK_DRIVER_MEM", "8g"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
