"""Headline timings: prints one JSON line.

The stand-in complaints are written as CSV once, and all layers run once to warm the session up; neither is
timed. Then the typed load and every layer are timed from that CSV, and every question is timed like the
published figures on the stored tables: one warm-up run, then the median of three.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from datetime import date
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from caselake.catalog.layers import STAND_IN_DAYS  # noqa: E402
from caselake.catalog.source_queries import NOW, named_raw_file  # noqa: E402
from caselake.operators.aggregates import count_by_month  # noqa: E402
from caselake.plans import analysis as A  # noqa: E402
from caselake.plans import gold as G  # noqa: E402
from caselake.plans import star as ST  # noqa: E402
from caselake.plans.medallion import Warehouse, run_layers, tables  # noqa: E402
from caselake.session import local_session, materialise, scratch_path  # noqa: E402
from caselake.sources.files import conform, read_raw_csv  # noqa: E402
from caselake.sources.relations import load_seeds, write_for_lookups  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, shuffle_partitions=int(cores) if cores.isdigit() else 8)
    seeds = load_seeds(spark)
    times: dict[str, float] = {}

    def step(name, build):
        start = time.time()
        result = build()
        times[name] = time.time() - start
        return result

    def question(name, build):
        runs = []
        for _ in range(4):
            start = time.time()
            build().write.format("noop").mode("overwrite").save()
            runs.append(time.time() - start)
        times[name] = statistics.median(runs[1:])

    # the raw file is made once and not measured; a whole run warms the session up
    csv = named_raw_file(spark, sf_dir)
    layers = {"now": NOW, "first_day": STAND_IN_DAYS[0], "calendar": STAND_IN_DAYS}
    run_layers(spark, Warehouse(scratch_path(spark, "warm_up")), csv, **layers)

    def load():
        typed = conform(read_raw_csv(spark, csv)).df
        return write_for_lookups(typed, scratch_path(spark, "complaints"), "date_received", ["company"], "complaint_id")

    complaints = step("load_typed_table", load)
    warehouse = Warehouse(scratch_path(spark, "warehouse"))
    run = run_layers(spark, warehouse, csv, **layers)
    times.update({layer: run.timings[layer] for layer in ("bronze", "silver", "gold", "marts")})
    gold = tables(spark, warehouse)
    silver = gold["silver"]

    def build_star():
        star = ST.build_star(complaints, seeds["state_ref"], days=STAND_IN_DAYS)
        return {**star, "fact_complaints": materialise(star["fact_complaints"], "fact_complaints")}

    star = step("star", build_star)
    monthly = materialise(count_by_month(complaints, "product", "date_received"), "monthly_per_product")

    question("q1", lambda: A.q1_per_product_and_month(complaints))
    question("q2", lambda: A.q2_month_over_month(complaints))
    question("q2_summary_table", lambda: A.month_over_month(monthly))
    question("q3", lambda: A.q3_top_issues_of_top_companies(complaints))
    question("q4", lambda: A.q4_running_total(complaints, date(1997, 1, 1), date(1998, 1, 1)))
    question("q5", lambda: A.q5_late_responders(complaints))
    question("q6", lambda: A.q6_share_of_month(complaints))
    question("q7", lambda: A.q7_moving_average(complaints, "Mortgage"))
    question("q8", lambda: A.q8_forwarding_days(complaints))
    question("p1", lambda: A.p1_by_id(complaints, 4242))
    question("p2", lambda: A.p2_issues_of_company(complaints, "EQUIFAX, INC.", date(1997, 1, 1), date(1998, 1, 1)))
    question("p3a", lambda: A.p3a_one_day_formatted(complaints, date(1998, 3, 3)))
    question("p3b", lambda: A.p3b_one_day(complaints, date(1998, 3, 3)))
    question("late_responders_silver", lambda: G.late_responders_from_silver(silver))
    question("late_responders_gold", lambda: G.late_responders_from_gold(gold["company_scorecard"]))
    question("channel_days_silver", lambda: G.channel_days_from_silver(silver))
    question("channel_days_gold", lambda: G.channel_days_from_gold(gold["channel_forwarding_stats"]))
    question("star_group_by_year", lambda: ST.group_by_year(star, 1996, 2000))
    question("star_renamed_products", lambda: ST.renamed_products(star))
    question("star_timely_by_region", lambda: ST.timely_by_region(star))
    question("star_fan_out", lambda: ST.product_fan_out(star))

    headline = sum(times[f"q{i}"] for i in range(1, 9))
    print(
        json.dumps(
            {
                "metric": "business questions q1-q8, median of 3 after a warm-up, total",
                "value": round(headline, 3),
                "unit": "sec",
                "queries": {name: round(seconds, 3) for name, seconds in times.items()},
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "rows": (rows := complaints.count()),
                "rows_per_second": {n: round(rows / times[n]) for n in ("load_typed_table", "bronze", "silver")},
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
