"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR picks the data folder, BENCH_CPUS the local cores.  Every query is run to its last row through the noop
sink; the total includes the staging of the derived input views.
"""
from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

HEADLINE = [
    "flagship_insertion_sites", "ag1_softclip_clusters", "ag10_depth", "ag11_depth_summary", "ag13_construct_median", "ag18_junction_evidence",
    "ag19_zygosity_counts", "ag20_pileup", "ag22_pileup_calls", "ag4_host_fraction", "dt1_verdict_pipeline", "dt12_copy_number", "dt14_variant_effect",
    "dt15_phase_reads", "fl1_qc_summary", "rj1_extract_pairs", "rj4_apply_mask", "rj7_homology_filter", "rj12_chimeric_junctions", "rj14_edits_at_targets",
    "rj22_recruit_pairs", "wn1_best_hit", "wn2_merge_annotations", "wn20_custody_ok", "cu2_merge_catalogue",
]
VIEWS = ["v_alignments", "v_reads", "v_sites", "v_hits", "v_paf", "v_insert_hits", "v_inserts", "v_depth", "v_calls", "v_targets", "v_variants",
         "v_features", "v_gene_ref", "v_ref", "v_mask", "v_elements", "v_custody", "v_evidence"]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("sitewright-bench")
        .config("spark.sql.shuffle.partitions", cpus).config("spark.ui.enabled", "false").config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from sitewright.plans import catalog
    from sitewright.plans.views import Tables

    queries = catalog.queries()
    tables = Tables(spark, sf)
    begin = time.time()
    for v in VIEWS:
        getattr(tables, v)
    staging = time.time() - begin
    only = sys.argv[1:] or HEADLINE
    times = {}
    for name in only:
        start = time.time()
        queries[name](spark, sf).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
    spark.stop()
    print(json.dumps({"metric": "headline_total", "value": round(staging + sum(times.values()), 3), "unit": "sec", "queries": times, "sf": Path(sf).name,
                      "staging_sec": round(staging, 3), "cpus": int(cpus)}))


if __name__ == "__main__":
    main()
