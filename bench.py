"""Headline queries on one folder of tables; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8).
Every query runs to completion into the noop sink, once untimed (code generation
and JIT compilation) and once timed.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidegauge.plans import fixtures  # noqa: E402
from tidegauge.plans.catalog import QUERIES, load_all  # noqa: E402
from tidegauge.plans.indicators import indicators  # noqa: E402
from tidegauge.session import local_session, scratch_path, ship_package  # noqa: E402

HEADLINES = [
    "K01_upsert_by_key", "W01_latest_row_per_key", "J01_date_spine_wide_join",
    "A01_hourly_sentiment", "W02_lag_change", "U03_priority_union_dedupe",
    "TA01_sma", "TA02_ema", "TA37_adx", "TA46_sar", "TA62_mama", "TA83_hl_volatility_30d",
    "W12_equity_curve", "D09_truncation", "D04_section_segmentation", "D10_embedding",
    "P14_topic_filter_aws", "R06_missing_range_selection",
]


def stored(spark, bars):
    """Bars as the table they are kept in; not part of the measured time."""
    path = scratch_path(spark, "bars")
    bars.write.parquet(path)
    return spark.read.parquet(path)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, "bench")
    spark.sparkContext.setLogLevel("OFF")
    load_all()
    ship_package(spark)
    runs = {name: QUERIES[name] for name in HEADLINES}
    events = stored(spark, fixtures.event_bars(spark, sf_dir))
    suppliers = stored(spark, fixtures.supplier_bars(spark, sf_dir))
    runs["indicators_events_110"] = lambda *_: indicators(events)
    runs["indicators_suppliers_110"] = lambda *_: indicators(suppliers)
    seconds = {}
    for name, build in runs.items():
        for _ in ("warm-up", "timed"):
            start = time.perf_counter()
            build(spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")),
    }))


if __name__ == "__main__":
    main()
