"""Time the headline queries: ``BENCH_SF_DIR`` on ``local[BENCH_CPUS]``, one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from entitylake.plans.catalog import QUERIES
from entitylake.session import local_session

HEADLINE = (
    "joi1_child_page_bodies",
    "bod1_mail_bodies",
    "bod2_page_bodies",
    "bod4_full_bodies",
    "aud1_missing_bodies",
    "prj1_slim_record",
    "prj18_mail_records",
    "prj19_page_records",
    "src1_search_envelopes",
    "src5_shaped_log",
    "snk1_structured_json",
    "flt3_phrase",
    "flt4_fuzzy",
    "flt5_proximity",
    "flt8_property",
    "flt12_date_range",
    "flt19_extra_filters",
    "lim2_offset_page",
    "lim4_bm25_text",
    "lim4_bm25_postings",
    "lim4_ranked_search",
    "post1_postings",
    "agg3_facets",
    "agg3_top_facets",
    "agg5_hits_per_query",
    "joi5_pivot",
    "wrk1_follow_company",
    "wrk2_person_of_interest",
    "wrk5_citations",
    "wrk6_cross_border",
    "agg5_percolated",
    "flt3_phrase_postings",
    "post1_fuzzy_neighbours",
    "wrk1_hops",
    "wrk5_page_citations",
)


def run(spark, name: str, sf_dir: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or list(HEADLINE)
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = local_session(cpus, app="bench")
    run(spark, names[0], sf_dir)
    seconds = {}
    for name in names:
        times = [run(spark, name, sf_dir) for _ in range(runs)]
        seconds[name] = round(min(times), 3)
        print(f"{name} {' '.join(f'{t:.2f}' for t in times)}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total of headline queries, best of runs",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "median": round(statistics.median(seconds.values()), 3),
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
