"""Time the headline queries, the median of three runs each; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import time

from entres.plans import registry
from entres.session import local_session

HEADLINE = ("l14_macro_f05", "l14_macro_f05_universe", "l13_rule_sweep", "t3_budget_bins", "a13_auc_bins", "l10a_s1_side", "l10b_candidate_side", "w1_rank_lead", "w12_mutual_best", "a13_auc", "t3_budget", "j3_capped_join", "b27_pair_generation", "m6_tfidf_cosine", "m2_jaro_winkler", "c9_context")


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    took = {}
    registry.QUERIES["a1_group_count"](spark, sf).count()
    for name in HEADLINE:
        runs = []
        for _ in range(3):
            began = time.time()
            registry.QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
            runs.append(time.time() - began)
        took[name] = round(statistics.median(runs), 3)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": os.path.basename(sf.rstrip("/"))}))


if __name__ == "__main__":
    main()
