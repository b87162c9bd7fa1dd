"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR   table directory, default /root/testdata/sf0.1
BENCH_CPUS     local cores, default 8
BENCH_RUNS     timed runs per query, default 2; the median counts

All queries run once to warm up, then BENCH_RUNS times, each time beginning with another one.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession

from ledgertag import CREDIT, DEBIT
from ledgertag.functions.period import Period
from ledgertag.operators import resolve
from ledgertag.operators.compile import compile_rules
from ledgertag.operators.tag import blank_tags, tag_sides
from ledgertag.operators.validate import validate_rules
from workload import tables
from workload.queries import REGISTRY
from workload.strategies import apply_by, classify_by

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "2"))

#: At sf0.1 these are 19, 169 and 1,219 rules.
RULE_SETS = {"template": (), "pair": tables.PER_PAIR, "word": tables.PER_WORD}
HEADLINES = (
    "classify_transactions",
    "apply_rules",
    "resolve_union",
    "consolidate",
    "sink_partition_counts",
)


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("ledgertag-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def one_branch_per_rule(
    spark: SparkSession, sf_dir: str, per: tuple[str, ...]
) -> DataFrame:
    """The yardstick: a filter per rule, a window per side, aggregates and joins."""
    period = Period.parse(tables.START, tables.END)
    valid = validate_rules(
        tables.rules(spark, sf_dir, per), tables.classifier(spark, sf_dir), period
    )
    tx = tables.transactions(spark, sf_dir)
    matches = apply_by("per_rule", tx, compile_rules(valid, period))
    tagged = blank_tags(tag_sides(matches))
    winners = [resolve.resolve_side(tagged, s) for s in (CREDIT, DEBIT)]
    reported = resolve.report(winners[0].unionByName(winners[1]))
    return (
        reported.drop(DEBIT.result, CREDIT.result)
        .join(resolve.consolidate_items(reported), "id_pk")
        .dropDuplicates()
    )


def strategy(name: str, rule_set: str):
    per = RULE_SETS[rule_set]

    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        if name == "per_rule":
            return one_branch_per_rule(spark, sf_dir, per)
        return classify_by(
            name,
            tables.transactions(spark, sf_dir),
            tables.rules(spark, sf_dir, per),
            tables.classifier(spark, sf_dir),
            tables.START,
            tables.END,
        )

    return build


def cases() -> dict:
    found = {name: REGISTRY[name] for name in HEADLINES}
    wanted = [("per_rule", "template"), ("literal", "template"), ("join", "template"), ("join", "word")]
    if os.environ.get("BENCH_FULL"):
        found = {}
        # One branch per rule takes minutes per run from a rule per pair on.
        wanted.append(("join", "pair"))
    for name, rules in wanted:
        found[f"classify_{name}_{rules}_rules"] = strategy(name, rules)
    return found


def seconds(spark: SparkSession, build) -> float:
    """Wall time from building the plan to the last row."""
    start = time.perf_counter()
    build(spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = session()
    found = cases()
    taken: dict[str, list[float]] = {name: [] for name in found}
    for run in range(RUNS + 1):
        order = list(found)[run % len(found) :] + list(found)[: run % len(found)]
        for name in order:
            taken[name].append(seconds(spark, found[name]))
            print(f"run {run}, {name}: {taken[name][-1]:.3f}", file=sys.stderr, flush=True)
    timed = {name: round(statistics.median(t[1:]), 3) for name, t in taken.items()}
    print(
        json.dumps(
            {
                "metric": f"{next(iter(timed))} wall time",
                "value": next(iter(timed.values())),
                "unit": "sec",
                "queries": timed,
                "sf": os.path.basename(os.path.normpath(SF_DIR)).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
