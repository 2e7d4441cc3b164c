"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores, ``BENCH_RUNS`` how
often each query runs, after one untimed run of a small query. ``queries`` holds
the best run, ``first`` the first; both include building the plan and the small
jobs it needs.
"""

from __future__ import annotations

import json
import os
import time

from cardfeat.plans.queries import QUERIES
from cardfeat.session import build_session, stage_scope

HEADLINE = [
    "rollup_basic_new",
    "rollup_basic_hist",
    "rollup_notebook_hist",
    "rollup_full_new",
    "rollup_full_hist",
    "rollup_merchant_new",
    "rollup_share_hist",
    "nunique_multi",
    "successive_aggregates",
    "per_month_two_level",
    "quantile_grid",
    "rfm_hist",
    "rfm_new",
    "rollup_left_join",
    "feature_table",
    "one_hot",
    "label_encode",
    "kfold_assign",
    "ols_blend",
    "ridge_stack",
    "gbt_oof",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session(
        f"local[{cpus}]",
        "cardfeat-bench",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="16g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["template_fill"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds: dict[str, list[float]] = {}
    for name in HEADLINE:
        for _ in range(runs):
            start = time.perf_counter()
            with stage_scope(spark):
                QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds.setdefault(name, []).append(round(time.perf_counter() - start, 3))
    best = {name: min(times) for name, times in seconds.items()}
    result = {
        "metric": "headline_total",
        "value": round(sum(best.values()), 3),
        "unit": "sec",
        "queries": best,
        "first": {name: times[0] for name, times in seconds.items()},
        "sf": os.path.basename(sf_dir.rstrip("/")),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
