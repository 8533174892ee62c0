"""Headline queries on one machine; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from scriptorium.queries import REGISTRY
from scriptorium.session import local_session

HEADLINES = [
    "job07_text_quality_assessment",
    "job07_document_assessment",
    "agg08_status_histogram",
    "gate09_review_history",
    "gate12_edit_chain",
    "win11_actor_numbering",
    "job09_contract_audit",
    "job04_model_answer_pages",
    "job08_verdict_ingestion",
    "job10_page_markup",
    "job11_round_trip_pages",
    "job13_html_page_text",
    "job15_cer_scoring",
    "job16_evaluation_report",
    "job18_catalog",
    "job01_corpus_inventory",
    "job03_join13_fetch_plan",
    "inc01_join12_freshness",
    "fp03_transcription_digest",
    "fn_normalise_zbz",
    "agg16_page_concatenation",
    "str01_str03_review_stream",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/conversations.parquet").count()  # start-up is not measured
    seconds: dict[str, float] = {}
    for name in sys.argv[1:] or HEADLINES:
        start = time.perf_counter()
        REGISTRY[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    line = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
