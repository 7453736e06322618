"""Time the headline queries and print one JSON line.

`BENCH_SF_DIR` names the tables, `BENCH_CPUS` the local cores. Arguments name
other queries than the headline ones; `all` runs every registered query. One
untimed run of the first query starts the JVM's compilers.
"""

from __future__ import annotations

import json
import os
import shutil
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from hubloom.plans.queries import QUERIES  # noqa: E402
from hubloom.session import build_session, has_folder, use_folder  # noqa: E402

HEADLINE = [
    "executable_deployments", "matched_candidates", "assembled_selectables",
    "elements_with_options", "devices_of_hubs", "validated_element_rows",
    "validated_records", "access_answers", "refused_deployments", "model_tasks",
    "prepared_requests", "created_deployments", "removed_deployments",
    "attempted_commands", "reconciled_deployments", "newest_sync_rows",
    "network_states", "requests_per_path", "prepare_latency", "command_keys",
    "latest_sync_stream", "topic_activity_stream",
]


def scale(sf_dir: str) -> float | str:
    name = os.path.basename(sf_dir.rstrip("/"))
    try:
        return float(name.removeprefix("sf"))
    except ValueError:
        return name


def main(names: list[str]) -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]", spark__driver__memory="16g", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__sql__shuffle__partitions=cpus)
    spark.sparkContext.setLogLevel("ERROR")
    folder = None if has_folder(spark) else tempfile.mkdtemp(prefix="hubloom-bench-")
    if folder:
        use_folder(folder)

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    run(names[0])
    seconds = {name: run(name) for name in names}
    spark.stop()
    if folder:
        shutil.rmtree(folder, ignore_errors=True)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "sf": scale(sf_dir)}))


if __name__ == "__main__":
    chosen = sys.argv[1:]
    main(list(QUERIES) if chosen == ["all"] else chosen or HEADLINE)
