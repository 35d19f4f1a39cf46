"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR: the tables (default /root/testdata/sf0.1). BENCH_CPUS: local cores (default all). BENCH_MEMORY: heap
of the driver (default half of the machine's memory).
"""

from __future__ import annotations

import json
import os
import re
import time

from inkveil.plans.queries import registered
from inkveil.session import local_session

HEADLINE = (
    "redacted_text", "published_pages", "redaction_plan", "line_tokens", "line_text", "value_boxes",
    "signature_lines", "register_tail_boxes", "kept_words", "page_routing", "raster_burn", "audit",
)


def run(df) -> None:
    """Computes every row and column without moving them to the driver."""
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    half = os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES") // 2**31
    spark = local_session(cpus, shuffle_partitions=int(cpus), memory=os.environ.get("BENCH_MEMORY", f"{half}g"))
    queries = registered()
    run(queries["redacted_text"](spark, sf_dir))  # starts workers and compiles; not counted

    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        run(queries[name](spark, sf_dir))
        seconds[name] = round(time.perf_counter() - start, 3)

    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    words = queries["doc_words"](spark, sf_dir).filter("page_no = 1").count()
    spent = seconds["redacted_text"]
    sf = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": float(sf.group(1)) if sf else None, "cpus": int(cpus),
        "redacted_documents_per_minute": round(documents / spent * 60),
        "redacted_words_per_second": round(words / spent),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
