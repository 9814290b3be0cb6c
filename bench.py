"""Wall time of the registered queries; prints one JSON line.

Every query is written to a sink that discards its rows, so all columns are
computed and nothing is collected.
"""

from __future__ import annotations

import json
import os
import sys
import time

from matchlens.session import build_session
from workloads.queries import QUERIES


def main(names: list[str]) -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    conf = {
        "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": "16g",
        "spark.ui.enabled": "false",
        "spark.log.level": "ERROR",
        "spark.ui.showConsoleProgress": "false",
    }
    spark = build_session("bench", f"local[{cpus}]", conf)
    QUERIES["pick_win"](spark, folder).write.format("noop").mode("overwrite").save()

    seconds = {}
    for name in names or QUERIES:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    total = round(sum(seconds.values()), 3)
    scale = os.path.basename(folder.rstrip("/"))
    print(json.dumps({"metric": "total_wall_time", "value": total, "unit": "sec", "queries": seconds, "sf": scale}))


if __name__ == "__main__":
    main(sys.argv[1:])
