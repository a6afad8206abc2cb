"""Runs the headline queries and prints one JSON line with their seconds.

BENCH_SF_DIR is the data folder, BENCH_CPUS the number of local threads.  Every query's result is
written to Spark's no-op sink, so that all of it is computed and nothing is kept; each runs
once to warm up and then twice, of which the better counts.  "hits_per_sec" is the point-to-property
throughput; the tree's visited nodes are listed beside it, as a published table counts them.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from aerofield.operators import tree
from aerofield.plans import catalogue, fixtures
from aerofield.sources import scratch

HEADLINES = ("point_to_property", "point_to_area", "range_join_all_hits", "disturbance", "zone_fold_wind", "integrity", "polygon_area", "box_area", "wall_records", "mission_segments", "sleep_carry", "latest_pose", "enu_to_lonlat", "plane_rectangular", "wind_arrows", "pos_lists")
DEPTHS = (1, 2, 3, 4, 5, 6, 7, 8, 9)


def seconds(spark: SparkSession, name: str, sf_dir: str) -> float:
    def once() -> float:
        start = time.perf_counter()
        catalogue.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    once()
    return min(once(), once())


def visited(spark: SparkSession) -> dict[str, int]:
    """Boxes looked at for one point, by the tree's depth."""
    areas, _, _ = catalogue.environment(spark)
    p = spark.createDataFrame([(1, 4000.0, -400.0, 20.0)], "id long, x double, y double, z double")
    return {str(d): tree.tree_search(p, tree.tree_nodes(areas, d).checkpoint(), ["id"], d).first().visited for d in DEPTHS}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "12g").config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(scratch.folder(spark, "bench"))
    took = {name: round(seconds(spark, name, sf_dir), 3) for name in HEADLINES}
    events = fixtures.table(spark, sf_dir, "events").count()
    out = {
        "metric": "headline queries, total", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "points": events, "points_per_sec": round(events / took["point_to_property"]), "visited_nodes": visited(spark),
    }
    print(json.dumps(out))


if __name__ == "__main__":
    main()
