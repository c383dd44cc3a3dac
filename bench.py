"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores. Each query runs once to warm up and
``BENCH_RUNS`` times for the record; the median counts. A run covers planning and a full execution into a
sink that discards rows. ``all_results`` is the batch job that writes all seven result tables, ``all_streams``
the streaming job with all seven results, late rows, reject counts and latency samples over the same log, drained;
the events per second of both are input rates. Corpus operators run where they are installed.
"""

from __future__ import annotations

import importlib.util
import json
import os
import statistics
import tempfile
import time

from skyledger.plans.batch_job import run_batch
from skyledger.plans.registry import LOG_START_MS, PARAMS, QUERIES, STREAM_PARAMS, sized
from skyledger.session import build_session, scratch_dir
from skyledger.sources.flights_view import flights_from_events, read_events, stream_events
from skyledger.streaming.jobs import start_all

HEADLINE = (
    "clean_flights", "q1_1h", "q2_1h", "q2_6h", "q2_global", "q3_1d", "q3_7d", "q3_global",
    "ddsketch_quantiles", "late_report", "lateness_stats", "latency_stats",
)
STREAMS = ("stream_q1_1h", "stream_q2_6h", "stream_q3_1d")
CORPUS = (
    "op3_virtual_slots", "op7_rule_ledger", "op8_decontaminate", "op10_shape_crf", "op11_fenwick_infill",
    "op12_phrase_automata", "op13_int8_vectors",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
        "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="skyledger-bench-"),
    })
    spark.sparkContext.setLogLevel("ERROR")
    events = read_events(spark, sf_dir).count()

    known = dict(QUERIES)
    if importlib.util.find_spec("skyledger.llm") is not None:
        from skyledger.llm import queries as corpus

        known |= {name: corpus.QUERIES[name] for name in CORPUS}

    def query(name: str) -> None:
        known[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    def all_results() -> None:
        flights = flights_from_events(read_events(spark, sf_dir))
        run_batch(spark, flights, scratch_dir(spark, "work"), scratch_dir(spark, "out"), PARAMS, LOG_START_MS)

    def all_streams() -> None:
        start_all(flights_from_events(stream_events(spark, sf_dir)), scratch_dir(spark, "streams"),
                  sized(spark, sf_dir, STREAM_PARAMS)).finish()

    def timed(action) -> float:
        took = []
        for _ in range(runs + 1):
            started = time.perf_counter()
            action()
            took.append(time.perf_counter() - started)
        return round(statistics.median(took[1:]), 3)

    seconds = {name: timed(lambda n=name: query(n)) for name in known if name in {*HEADLINE, *STREAMS, *CORPUS}}
    seconds["all_results"] = timed(all_results)
    seconds["all_streams"] = timed(all_streams)
    print(json.dumps({
        "metric": "headline_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
        "events": events,
        "events_per_second": round(events / seconds["all_results"]),
        "stream_events_per_second": round(events / seconds["all_streams"]),
    }))


if __name__ == "__main__":
    main()
