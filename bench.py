"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the folder of tables, BENCH_CPUS the number of cores. Each query is
written to the no-op sink, so every row and column that it returns is computed and none is
collected. Queries of rows with a geometry return it in `run_geometry`, `run_simplify` and
`vsr_vertices` only; the others do not compute it. The first query that needs a polygon
index builds and stores it; later ones read it.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from fairwake.plans.catalog import AS_OF, Chain, registered_queries
from fairwake.plans.update import update
from fairwake.sources.tables import new_folder

HEADLINES = [
    "ais_ingest",
    "join_registry",
    "segments",
    "segments_legacy",
    "speed_runs",
    "run_geometry",
    "run_simplify",
    "vsr_segments",
    "vsr_vertices",
    "ship_daily",
    "ship_monthly",
    "ship_annual",
    "operator_daily",
    "operator_monthly",
    "operator_annual",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    builds = registered_queries()

    def run(name: str) -> float:
        start = time.perf_counter()
        builds[name](spark, folder).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    run("ais_ingest")  # starts the JVM's code paths; not counted
    seconds = {name: run(name) for name in HEADLINES}

    chain = Chain(spark, folder)
    start = time.perf_counter()
    update(
        spark,
        new_folder(spark, "bench-update"),
        source=chain.source,
        registry=chain.registry,
        coast=chain.coast,
        zone_table=chain.zones,
        categories=chain.categories,
        today=AS_OF[0],
    )
    seconds["update_all_tables"] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall clock",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
