"""Times the headline queries and prints one JSON line.

``all_marts`` stages the raw rows once and builds and writes all seven marts, as a nightly build does. Each other query starts from the given tables: a new ``Tables`` per query, so nothing staged by an earlier
query is reused. The staged tables a query needs are part of its time.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks import CHECKS  # noqa: E402
from checks.base import Tables, shape  # noqa: E402
from geopulse.plans import marts  # noqa: E402
from geopulse.session import get_spark  # noqa: E402
from geopulse.workspace import release  # noqa: E402

HEADLINE = (
    "stg_detections", "stg_composites", "fire_anomalies", "deforestation_index", "ice_extent_trends",
    "glacier_backscatter", "cell_fire", "cell_sst", "cell_change", "causal_features", "seasonal_baseline",
    "nearest_rank_quantiles", "percentile_rank", "assign_region", "check_events", "map_summary",
    "run_totals", "upsert_protected", "validate", "redact", "zonal_stats", "composite_mean", "score", "all_marts",
)


def all_marts(spark, sf_dir: str) -> None:
    t = Tables(spark, sf_dir)
    for df in marts.build_marts(t.detections, t.gridded, t.composites, t.region_dim).values():
        df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_spark(
        "bench",
        master=f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
        },
    )
    spark.sparkContext.setLogLevel("OFF")
    wanted = sys.argv[1:] or HEADLINE
    warm = CHECKS["run_totals"]
    shape(warm.run(Tables(spark, sf_dir)), warm.outputs).write.format("noop").mode("overwrite").save()
    seconds: dict[str, float] = {}
    for name in wanted:
        started = time.perf_counter()
        if name == "all_marts":
            all_marts(spark, sf_dir)
            seconds[name] = round(time.perf_counter() - started, 3)
            continue
        df = shape(CHECKS[name].run(Tables(spark, sf_dir)), CHECKS[name].outputs)
        df.write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, cold staging", "value": round(sum(seconds.values()), 3), "unit": "sec",
                "queries": seconds, "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        ),
        flush=True,
    )
    release(spark)
    spark.stop()


if __name__ == "__main__":
    main()
