"""Headline queries, timed: prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8). Each
query runs to completion through the no-op sink, so all columns are computed.
One small query runs first so that starting the JVM is not timed.
"""

import json
import os
import time

from reachmap.plans.catalog import QUERIES
from reachmap.session import local_session

HEADLINE = [
    "provider_table",
    "filings_with_pop",
    "max_speed_block_provider_tech",
    "block_numprov_wide",
    "block_numprov_long",
    "area_table",
    "tract_numprov",
    "county_numprov",
    "h2only_undev",
    "dissolve_tract_edges",
    "dissolve_tract",
    "provider_footprint_edges",
    "tile_cover",
    "tile_thin",
    "provider_tiles",
    "max_speed_window",
    "tile_cover_shapes",
    "tile_quantise",
    "tile_fold_smallest",
    "carto_tracts",
    "dissolve_ring_points",
    "speed_layer_tiles",
    "tile_quantise_clipped",
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    QUERIES["tract_pop"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
