"""Times the named queries, each run once cold and then warm; prints one JSON line.

    BENCH_SF_DIR   folder of the test tables (default /root/testdata/sf0.1)
    BENCH_CPUS     local cores (default 8)
    BENCH_QUERIES  comma-separated keys, or "all" (default: the named queries and the load steps; left out
                   are the other rollups over them and the one-year variants, the same plans under a filter)
    BENCH_REPEAT   warm runs, of which the best counts (default 3)
    BENCH_DETAIL   file for cold times and, with BENCH_PRODUCT=1, the joined-product times
    BENCH_PRODUCT  also time the fan-out queries as plain joins
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks import product as joined  # noqa: E402
from scolaria.plans.registry import BY_YEAR, FIXED, all_queries  # noqa: E402
from scolaria.session import build_session  # noqa: E402
from scolaria.sources.school_model import school_model  # noqa: E402


HEADLINE = [
    *FIXED, *BY_YEAR, "rollup_progression_summary", "rollup_risk_summary", "append_load", "unpivot_revenue", "unpivot_tranche", "resolve_keys", "anti_revenue", "fact_service_revenue", "fact_service_tranche",
]


def timed(frame_of) -> float:
    start = time.perf_counter()
    frame_of().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = build_session(
        "scolaria-bench",
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "12g", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
           "spark.checkpoint.dir": f"file://{tempfile.mkdtemp(prefix='scolaria-')}"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    chosen = os.environ.get("BENCH_QUERIES")
    keys = list(queries) if chosen == "all" else chosen.split(",") if chosen else HEADLINE
    tables = school_model(spark, sf_dir)
    cold, warm = {}, {}
    for key in keys:
        run = lambda key=key: queries[key](tables)
        cold[key] = round(timed(run), 3)
        warm[key] = round(min(timed(run) for _ in range(repeat)), 3)
    product = {}
    if os.environ.get("BENCH_PRODUCT"):
        for name in joined.TABLES:
            tables[name].createOrReplaceTempView(name)
        for key, sql in joined.STATEMENTS.items():
            product[key] = round(min(timed(lambda sql=sql: spark.sql(sql)) for _ in range(repeat)), 3)
    if os.environ.get("BENCH_DETAIL"):
        with open(os.environ["BENCH_DETAIL"], "w") as f:
            json.dump({"cold": cold, "warm": warm, "product": product}, f, indent=1)
    total = round(sum(warm.values()), 3)
    print(json.dumps({"metric": "warm_query_seconds", "value": total, "unit": "sec", "queries": warm, "sf": os.path.basename(sf_dir)}))
    spark.stop()


if __name__ == "__main__":
    main()
