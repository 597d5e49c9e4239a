"""Times the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the input folder, ``BENCH_CPUS`` the number of local cores. A table query
runs its whole plan from the raw sources; indicators, reports and consumer queries read the stored
star schema, whose building is timed as ``build_star``, and the loading of the stored indicators as
``load_*``. ``BENCH_SCRATCH`` names the folder for intermediate tables. Each query runs ``BENCH_RUNS`` times and
the best time counts.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from terrier import registry
from terrier.plans.warehouse import build_all
from terrier.registry.core import Context, context
from terrier.session import get_session

HEADLINE = (
    "mdl_1_stg_dvf_transactions", "mdl_3_stg_ban_addresses_normalized", "mdl_4_dim_address",
    "mdl_5_dim_address_enriched", "mdl_6_dim_code_postal", "mdl_7_dim_commune",
    "mdl_8_dim_parcelle", "mdl_9_dim_type_local", "mdl_10_fct_mutation",
    "kpi_1_france", "kpi_2_departement", "kpi_3_commune", "kpi_4_code_postal",
    "rpt_1_match_levels", "rpt_3_by_departement", "rpt_6_worst_communes",
    "qry_1_median_by_commune", "qry_3_monthly_trend", "qry_5_precisely_located",
    "chk_8_all_declared", "d_11_price_outliers", "d_14_sales_near_sites",
)


# Stored tables whose loading alone is timed.
LOADED = ("gold_kpi_france", "gold_kpi_departement", "gold_kpi_commune", "gold_kpi_code_postal")


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(run, runs: int) -> float:
    best = float("inf")
    for _ in range(runs):
        start = time.perf_counter()
        run()
        best = min(best, time.perf_counter() - start)
    return round(best, 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = get_session(
        "bench", f"local[{cpus}]", spark__ui__enabled="false",
        spark__sql__shuffle__partitions=cpus, spark__driver__memory="16g",
        spark__ui__showConsoleProgress="false",
        spark__checkpoint__dir=os.environ.get("BENCH_SCRATCH", tempfile.mkdtemp(prefix="bench-")),
    )
    spark.sparkContext.setLogLevel("OFF")
    shared = context(spark, folder)
    consume(shared.bronze_dvf)
    consume(shared.bronze_ban)

    def build() -> None:
        fresh = Context(spark, folder)
        fresh.bronze_dvf, fresh.bronze_ban = shared.bronze_dvf, shared.bronze_ban
        build_all(fresh.gold)

    seconds = {"build_star": timed(build, runs)}
    build_all(shared.gold)
    for name in LOADED:
        seconds[f"load_{name}"] = timed(lambda: consume(shared.gold.table(name)), runs)
    for key in HEADLINE:
        seconds[key] = timed(lambda: consume(registry.QUERIES[key](spark, folder)), runs)
    print(
        json.dumps(
            {
                "metric": "headline queries, total time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
