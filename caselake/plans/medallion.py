"""Bronze -> Silver -> Gold with a gate between the layers; restartable at any layer."""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence
from datetime import date, datetime
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caselake.operators import checks as K
from caselake.operators.joins import assert_no_fanout
from caselake.plans.gold import GOLD_TABLES
from caselake.plans.report import build_report
from caselake.plans.silver import REJECT_REASONS, build_company_lookup, build_silver, rejects, stage
from caselake.plans.star import CALENDAR, build_marts
from caselake.session import materialise, scratch_tables, side_by_side
from caselake.sources.bronze import land_csv, read_version, stage_version, write_snapshot
from caselake.sources.relations import SEEDS, load_seeds, replace_table, write_for_lookups

LAYERS = ["bronze", "silver", "gold"]
# Submission channels that are known.
CHANNELS = ["Web", "Referral", "Phone", "Postal mail", "Fax", "Email", "Web Referral", "Unknown"]
FIRST_DAY = date(2011, 12, 1)


MARTS = ["dim_date", "dim_company", "dim_product", "dim_state", "fct_complaints"]


class Warehouse(NamedTuple):
    """Where the layers live: any folder all executors can reach.

    Every run writes all its tables, Bronze included, into folders of its own. A layer that passed its
    checks is noted in ``passed``, where a later run may go on from it. Only a run whose layers all
    passed is published: one append to ``published`` names the run of every table, so readers see one
    consistent state, the old or the new.
    """

    root: str

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def staged(self, table: str, run: str) -> str:
        return f"{self.root}/{table}/run={run}"

    def note(self, spark: SparkSession, where: str, runs: dict[str, str]) -> None:
        """One committed write that names the run of each table."""
        pairs = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(r).alias("run")) for n, r in runs.items()])
        rows = spark.range(1).select(F.explode(pairs).alias("t")).select("t.*", F.current_timestamp().alias("at"))
        rows.coalesce(1).write.mode("append").parquet(self.path(where))

    def runs(self, spark: SparkSession, where: str = "published") -> dict[str, str]:
        """The latest noted run of each table; empty before the first."""
        try:
            noted = spark.read.parquet(self.path(where))
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return {}
        latest = noted.groupBy("name").agg(F.max_by("run", F.struct("at", "run")).alias("run"))
        return {r["name"]: r["run"] for r in latest.collect()}  # one row per table

    def read(self, spark: SparkSession, names: Sequence[str], runs: dict[str, str] | None = None) -> dict[str, DataFrame]:
        """The published version of each table, or that of ``runs``."""
        runs = self.runs(spark) if runs is None else runs
        return {name: spark.read.parquet(self.staged(name, runs[name])) for name in names}


class Run(NamedTuple):
    checks: list[K.Result]
    timings: dict[str, float]
    report: str


def tables(spark: SparkSession, warehouse: Warehouse) -> dict[str, DataFrame]:
    """All layers as they are stored now."""
    runs = warehouse.runs(spark)
    version = read_version(spark, warehouse.root, runs["bronze"])
    return {
        "bronze": version.bronze,
        "log": version.log,
        **warehouse.read(spark, ["silver", "rejects", "lookup", *GOLD_TABLES, *MARTS], runs),
    }


def bronze_checks(bronze: DataFrame, now: datetime) -> list[K.Check | K.RowCheck | K.KeyCheck]:
    return [
        K.RowCheck("bronze batch id is set", bronze, F.col("_batch_id").isNull()),
        K.RowCheck("bronze complaint_id is set", bronze, F.col("complaint_id").isNull(), K.WARN),
        K.Check("bronze is at most 7 days old", K.freshness_violations(bronze, now, K.WARN), K.WARN),
        K.Check("bronze is at most 30 days old", K.freshness_violations(bronze, now, K.ERROR)),
    ]


def seed_checks(seeds: dict[str, DataFrame]) -> list[K.Check | K.RowCheck | K.KeyCheck]:
    """Before any lookup: one row per key, no empty key, and aliases that lead to a listed state."""
    checks: list[K.Check | K.RowCheck | K.KeyCheck] = []
    for name, (key, *_) in SEEDS.items():
        checks += [K.RowCheck(f"{name}.{key} is set", seeds[name], F.col(key).isNull()), K.KeyCheck(f"{name}.{key} is unique", seeds[name], [key])]
    listed = K.KeyCheck("state_alias leads to a listed state", seeds["state_alias"], ["state_code"], parent=seeds["state_ref"])
    return [*checks, listed]


def silver_checks(
    bronze: DataFrame,
    silver: DataFrame,
    rejected: DataFrame,
    lookup: DataFrame,
    seeds: dict[str, DataFrame],
    today: date,
    first_day: date = FIRST_DAY,
) -> list[K.Check | K.RowCheck | K.KeyCheck]:
    def missing(column: str) -> Column:
        return F.col(column).isNull()

    return [
        K.RowCheck("complaint_id is set", silver, missing("complaint_id")),
        K.RowCheck("date_received is set", silver, missing("date_received")),
        K.RowCheck("date_received is in range", silver, K.is_outside("date_received", first_day, today)),
        K.RowCheck("product_group is set", silver, missing("product_group")),
        K.RowCheck("company is set", silver, missing("company")),
        K.RowCheck("company is set in the lookup", lookup, missing("company")),
        K.RowCheck("channel is known", silver, K.is_unlisted("submitted_via", CHANNELS), K.WARN),
        K.RowCheck("days_to_send is not negative", silver, K.is_outside("days_to_send", low=0), K.WARN),
        K.RowCheck("reject_reason is known", rejected, K.is_unlisted("reject_reason", REJECT_REASONS)),
        K.KeyCheck("complaint_id is unique", silver, ["complaint_id"]),
        K.KeyCheck("product_group is listed", silver, ["product_group"], K.WARN, seeds["product_map"]),
        K.KeyCheck("state is listed", silver, ["state"], parent=seeds["state_ref"], parent_column="state_code"),
        K.KeyCheck("company_raw is unique in the lookup", lookup, ["company_raw"]),
        K.Check("no merge across legal forms", K.merged_across_legal_forms(lookup)),
        K.Check("bronze rows are all accounted for", K.bronze_reconciles(bronze, stage(bronze), silver)),
    ]


def gold_checks(silver: DataFrame, gold: dict[str, DataFrame]) -> list[K.Check | K.RowCheck | K.KeyCheck]:
    every = F.lit(True)
    totals = {
        "monthly_product_stats": (gold["monthly_product_stats"], "complaints", every),
        "company_scorecard": (gold["company_scorecard"], "complaints", F.col("company").isNotNull()),
        "channel_forwarding_stats": (gold["channel_forwarding_stats"], "complaints", F.col("days_to_send").isNotNull()),
    }
    return [
        K.Check("gold totals add back to silver", K.totals_add_back(silver, totals)),
        K.KeyCheck("company is unique in the scorecard", gold["company_scorecard"], ["company"]),
        K.RowCheck("late_pct is a percentage", gold["company_scorecard"], K.is_outside("late_pct", 0.0, 100.0)),
        K.KeyCheck("month and group are unique", gold["monthly_product_stats"], ["month", "product_group"]),
        K.Check("only the latest month is partial", K.partial_month_not_latest(gold["monthly_product_stats"])),
    ]


def mart_checks(marts: dict[str, DataFrame]) -> list[K.Check | K.RowCheck | K.KeyCheck]:
    """Keys of the dimensions, and a fact that finds a member for each of its keys."""
    fact = marts["fct_complaints"]
    keys = {"dim_date": "date_key", "dim_company": "company_key", "dim_product": "product_key", "dim_state": "state_key"}
    refers = {"date_received_key": "dim_date", "date_sent_key": "dim_date"} | {keys[d]: d for d in list(keys)[1:]}
    checks: list[K.Check | K.RowCheck | K.KeyCheck] = [
        K.RowCheck("fct_complaints.complaint_id is set", fact, F.col("complaint_id").isNull()),
        K.KeyCheck("fct_complaints.complaint_id is unique", fact, ["complaint_id"]),
        K.RowCheck("fct_complaints.complaint_count is 1", fact, ~F.col("complaint_count").eqNullSafe(F.lit(1))),
        K.KeyCheck("product and sub-product are unique", marts["dim_product"], ["product", "sub_product"]),
        K.KeyCheck("company_name is unique", marts["dim_company"], ["company_name"]),
        K.KeyCheck("state_code is unique", marts["dim_state"], ["state_code"]),
    ]
    for name, key in keys.items():
        checks += [K.RowCheck(f"{name}.{key} is set", marts[name], F.col(key).isNull()), K.KeyCheck(f"{name}.{key} is unique", marts[name], [key])]
    for column, name in refers.items():
        checks += [K.RowCheck(f"{column} is set", fact, F.col(column).isNull())]
        checks += [K.KeyCheck(f"{column} is in {name}", fact, [column], parent=marts[name], parent_column=keys[name])]
    return checks


def run_layers(
    spark: SparkSession,
    warehouse: Warehouse,
    csv_path: str | None = None,
    start: str = "bronze",
    snapshot: bool = False,
    keep_history: bool = False,
    seed_folder: str | None = None,
    now: datetime | None = None,
    first_day: date = FIRST_DAY,
    calendar: tuple[date, date] = CALENDAR,
) -> Run:
    """Build the layers from ``start`` on. Every layer is a stored table that the next one reads,
    so lineage ends at layer borders and a lost executor repeats one layer's tasks at most.

    Without ``keep_history`` a load replaces all of Bronze; with it, only its own batches. All tables are
    written beside those in use, and published together when every layer has passed its checks; an error
    stops the run (GateError) and leaves what was readable before. A run that starts at a later layer goes
    on from the latest layers that passed, published or not.
    """
    if start not in LAYERS:
        raise ValueError(f"start must be one of {LAYERS}")
    first = LAYERS.index(start)
    now = now or datetime.now()
    seeds = load_seeds(spark, seed_folder)
    timings: dict[str, float] = {}
    results: list[K.Result] = []
    at = time.time

    run = f"{now:%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"
    runs = warehouse.runs(spark, "passed")
    stage_as = lambda df, name: replace_table(df, warehouse.staged(name, run))

    def passed(*names: str) -> None:
        runs.update(dict.fromkeys(names, run))
        warehouse.note(spark, "passed", dict.fromkeys(names, run))

    with scratch_tables(spark):
        began = at()
        if first == 0:
            if csv_path is None:
                raise ValueError("csv_path is needed to build bronze")
            landed = land_csv(spark, csv_path, F.lit(now))
            before = warehouse.runs(spark).get("bronze")
            bronze = stage_version(landed, warehouse.root, run, before, replace_all=not keep_history).bronze
            results += K.gate(bronze_checks(bronze, now))
            passed("bronze")
            if snapshot:
                write_snapshot(bronze, warehouse.path("snapshots"))
            timings["bronze"] = at() - began
        bronze = read_version(spark, warehouse.root, runs["bronze"]).bronze

        began = at()
        if first <= 1:
            results += K.gate(seed_checks(seeds))
            lookup = assert_no_fanout(build_company_lookup(bronze, seeds, lambda df: stage_as(df, "lookup")), ["company_raw"])
            built = side_by_side(
                {
                    "silver": lambda: write_for_lookups(
                        build_silver(bronze, lookup, seeds), warehouse.staged("silver", run), "date_received", ["company"], "complaint_id"
                    ),
                    "rejects": lambda: stage_as(rejects(bronze), "rejects"),
                }
            )
            results += K.gate(silver_checks(bronze, built["silver"], built["rejects"], lookup, seeds, now.date(), first_day))
            passed("lookup", "silver", "rejects")
            timings["silver"] = at() - began
        silver, lookup = warehouse.read(spark, ["silver", "lookup"], runs).values()

        began = at()
        gold = side_by_side({name: lambda name=name, build=build: stage_as(build(silver), name) for name, build in GOLD_TABLES.items()})
        results += K.gate(gold_checks(silver, gold))
        passed(*gold)
        timings["gold"] = at() - began

        began = at()
        write = lambda df, name: (stage_as if name in MARTS else materialise)(df, name)
        marts = build_marts(silver, lookup, seeds["state_ref"], write, calendar)
        marts["fct_complaints"] = stage_as(marts["fct_complaints"], "fct_complaints")
        results += K.gate(mart_checks(marts))
        passed(*MARTS)
        timings["marts"] = at() - began
        warehouse.note(spark, "published", runs)

        began = at()
        report = build_report(tables(spark, warehouse), seeds["product_map"], results, timings, now)
        timings["report"] = at() - began
    return Run(results, timings, report)
