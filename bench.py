"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import time

from tessella.plans.queries import QUERIES
from tessella.session import build_session

HEADLINE = [
    "normalize_doc_keys", "authority_ids", "legacy_lookup_keep_last", "fk_orphans", "alloc_capped", "stratified_draw", "tier_quota_sample", "form_alias_read", "ledger_new_vs_replay",
    "latest_submission_overlay", "publication_diff", "render_letters", "contact_scan", "html_links_extract", "tree_paths", "facets", "km_survival", "treatment_effect",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(cores, int(cores))
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["facets"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # start-up is not a query's time
    seconds = {}
    for name in HEADLINE:
        began = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - began, 3)
    name = os.path.basename(os.path.normpath(sf_dir))
    sf = float(name[2:]) if name.startswith("sf") and name[2:].replace(".", "", 1).isdigit() else name
    print(json.dumps({"metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": sf}))


if __name__ == "__main__":
    main()
