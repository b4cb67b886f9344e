"""Times the headline queries on ``$BENCH_SF_DIR`` and prints one JSON line.

``queries`` build everything from the source tables; those ending in ``_on_marts`` read marts that
were written once (``build_marts``), the way reports run.
"""

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ratelens.operators import analyst, diagnostics  # noqa: E402
from ratelens.plans.marts import from_test_tables, materialize  # noqa: E402
from ratelens.plans.queries import FILTERS, QUERIES  # noqa: E402
from ratelens.session import local_session, shared_folder  # noqa: E402

HEADLINE = (
    "t12_dedupe", "m13_semantic", "m16_harmonized", "m19_agg_compare", "m19_agg_compare_exact",
    "a02_hospital_comparison", "g03_funnel", "v13_quality_metrics",
)
REPORTS = {
    "a02_on_marts": lambda m: analyst.hospital_comparison(m, payer_family="Aetna", **FILTERS),
    "a09_on_marts": lambda m: analyst.get_rates(m, **FILTERS),
    "a17_on_marts": analyst.coverage_matrix,
    "a32_on_marts": analyst.median_negotiated,
    "g03_on_marts": lambda m: diagnostics.comparability_funnel(
        m.fct_standard_charges_semantic, m.fct_rates_comparable, m.fct_rates_comparable_harmonized
    ),
}


def timed(run) -> float:
    start = time.perf_counter()
    run()
    return round(time.perf_counter() - start, 3)


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session("ratelens-bench")
    consume(QUERIES["m03_dim_payer"](spark, sf_dir))  # start the JVM's worker threads
    seconds = {name: timed(lambda: consume(QUERIES[name](spark, sf_dir))) for name in HEADLINE}
    work = tempfile.mkdtemp(prefix="ratelens-bench-")
    folder = f"{shared_folder(spark, work)}/bench_marts"
    marts = from_test_tables(spark, sf_dir)
    seconds["build_marts"] = timed(lambda: materialize(marts, folder))
    for name, report in REPORTS.items():
        seconds[name] = timed(lambda: consume(report(marts)))
    print(
        json.dumps(
            {
                "metric": "headline queries, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
