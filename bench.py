"""Time the headline queries: one JSON line on stdout.

BENCH_SF_DIR names the table folder, BENCH_CPUS the local cores. Every result is
written in full to Spark's no-op sink.
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cellbulk.catalog import QUERIES  # noqa: E402
from cellbulk.session import local_session  # noqa: E402

HEADLINE = (
    "barcode_qc", "tss_pairs", "tss_profile", "tss_enrichment", "rna_cell_qc",
    "pseudobulk_expression", "pseudoreps", "coverage", "treatment_pileup",
    "control_lambda", "poisson_score", "call_regions", "fisher_combine",
    "reproducible_peaks", "fragments_in_peaks", "frip_per_cell", "combined_cell_qc",
    "pseudobulk_summary", "box_stats", "sort_fragments", "split_fragments",
    "called_peaks", "summits", "overlay_tracks", "outliers", "stream_barcode_qc",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session("bench", cpus=cpus, memory="16g", partitions=int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["size_class"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        began = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - began, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
