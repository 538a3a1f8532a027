"""Times the headline queries; prints one JSON line.

BENCH_SF_DIR names the tables (default sf0.1), BENCH_CPUS the local cores.
Each query's full result is computed; nothing is cached between queries.
"""

import json
import os
import sys
import time

from caselode.plans.registry import QUERIES
from caselode.session import clear_staged, local_session

HEADLINE = (
    "text_clean", "text_valid", "dedup_keep_longest", "page_record", "qa_flags",
    "rep_parties", "rep_cases", "split_stratified", "tfidf_vocab", "tfidf_weights",
    "retrieve_sparse", "retrieve_dense", "self_similarity_topk", "predict_batch",
    "clf_metrics", "retrieval_at_k",
)


def main(names):
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), name="bench")
    seconds = {}
    for name in names or HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
        clear_staged(spark)
    print(
        json.dumps(
            {
                "metric": "total time of headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        ),
        flush=True,
    )


if __name__ == "__main__":
    main(sys.argv[1:])
