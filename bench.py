"""Time the headline queries: one JSON line on standard output.

The rendered pages and the payload table are inputs at rest: they are written
before the clock starts (their own cost is reported as ``render`` and
``payloads``). Each query runs once to warm up, then the median of three runs
counts. Results go to a sink that reads every column.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks import tables as B
from checks.registry import QUERIES
from dossierflow.plans.payloads import build_payloads
from dossierflow.session import local_session
from fixtures.render import corpus

HEADLINE = (
    "txt1_clean_html", "src2_extract_links", "fld2_label_fields", "fld7_sections", "wrk1_job_blocks",
    "wrk8_work_items", "edu1_education_items", "agg2_months_by_title", "agg4_skill_months",
    "agg6_assemble_processed", "sim2_nearest", "sto1_upsert", "sel3_dedupe_first",
)


def _drain(df) -> float:
    start = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    spark = local_session(cpus, memory=os.environ.get("BENCH_MEMORY", "12g"))
    spark.sparkContext.setLogLevel("ERROR")
    setup = {}
    start = time.perf_counter()
    corpus(spark, sf_dir)
    setup["render"] = time.perf_counter() - start
    for name, make in (("cleaned", B.cleaned), ("payloads", B.payloads), ("items", B.items)):
        start = time.perf_counter()
        make(spark, sf_dir)
        setup[name] = time.perf_counter() - start
    times = {}
    for name in HEADLINE:
        def run() -> float:
            begun = time.perf_counter()
            _drain(QUERIES[name](spark, sf_dir))
            return time.perf_counter() - begun

        run()
        times[name] = statistics.median(run() for _ in range(repeats))
    pages = B.profiles(spark, sf_dir)
    _drain(build_payloads(pages, as_of=B.AS_OF_TIME))
    times["pages_to_payloads"] = statistics.median(
        _drain(build_payloads(pages, as_of=B.AS_OF_TIME)) for _ in range(repeats)
    )
    print(json.dumps({
        "metric": "total_seconds_headline_queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in times.items()},
        "setup": {k: round(v, 3) for k, v in setup.items()},
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": cpus,
    }))


if __name__ == "__main__":
    main()
