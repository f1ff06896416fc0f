"""Headline queries at one scale; prints one JSON line.

One warm-up, then the median of three runs per query.  Results go to Spark's
``noop`` sink, so every output row and column is computed.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from dualscript.plans.queries import QUERIES
from dualscript.session import build_session

HEADLINE = [
    "stage2_valid", "sentence_pairs", "pair_split", "trn_file_pairs",
    "script_dedup", "script_counts", "train_scripts", "dev_holdout",
    "pair_filter", "length_eda_before", "doc_length_eda",
    "special_filter_docs", "encode_ids", "encode_docs", "length_buckets",
    "corpus_bleu", "rouge_n", "rouge_l_rows", "evaluate_all",
    "reading_lexicon", "lexicon_convert", "stream_ingest",
]


def timed(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false", spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        timed(spark, name, sf_dir)
        seconds[name] = round(statistics.median(timed(spark, name, sf_dir) for _ in range(runs)), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total_query_time", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
    }))


if __name__ == "__main__":
    main()
