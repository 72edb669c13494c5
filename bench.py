"""Times of the headline queries, as one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores. The index is built cold, in a folder of
its own, and timed as ``build_index``; searches then run over the written index, each once untimed
(code generation, file listing) and ``BENCH_RUNS`` times timed, of which the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
import uuid

from pyspark.sql import functions as F

from shelfmark.operators.definitions import definition_name
from shelfmark.plans import corpora, registry
from shelfmark.session import local_session, shared_dir
from shelfmark.sources import store

HEADLINE = (
    "term_search",
    "phrase_search",
    "facet_filters",
    "search_with_facets",
    "facets_for_query",
    "predicate_boolean",
    "sort_numeric",
    "multi_index_search",
    "index_terms",
    "prefix_terms",
    "fuzzy_terms",
    "similar_terms_text",
    "suggest_terms",
    "suggest_documents",
    "build_postings",
    "analyze_standard",
    "document_preview",
    "route_destinations",
    "incremental_diff",
    "apply_changes",
    "debounce_events",
    "debounce_stream",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    wanted = sys.argv[1:] or HEADLINE
    spark = local_session(
        cpus, "bench", **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "12g"}
    )

    def build_index() -> None:
        store.write_index(
            spark,
            f"{shared_dir(spark)}/shelfmark/bench/{uuid.uuid4().hex}",
            corpora.document_docs(spark, sf_dir),
            corpora.document_values(spark, sf_dir),
            definition_name(F.col("index_name"), corpora.DEFINITIONS),
        )

    def run(name: str) -> float:
        start = time.perf_counter()
        registry.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    times: dict[str, float] = {}
    start = time.perf_counter()
    build_index()
    times["build_index"] = time.perf_counter() - start
    for corpus in (corpora.DOCUMENT_CORPUS, corpora.PART_CORPUS):
        corpus.index(spark, sf_dir)
    for name in wanted:
        run(name)
        times[name] = statistics.median(run(name) for _ in range(runs))
        print(f"{name} {times[name]:.2f}", file=sys.stderr)
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries, cold index build included",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": {name: round(t, 3) for name, t in times.items()},
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus) if cpus.isdigit() else cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
