"""The batch job: read three files, classify, write."""

from __future__ import annotations

import argparse
import logging

from pyspark.sql import DataFrame, SparkSession

from ledgertag.config import DEFAULT, Layout
from ledgertag.functions.period import Period
from ledgertag.operators.compile import rejected_rules
from ledgertag.operators.validate import applied_rules, validate_rules
from ledgertag.plans.classify import Watch, classify
from ledgertag.sources.readers import (
    BROKEN,
    broken_lines,
    read_classifier,
    read_rules,
    read_transactions,
    sound_rows,
)
from ledgertag.sources.sinks import write_result

log = logging.getLogger(__name__)


# Ids that a message lists; the number of rules is always given.
MOST_LISTED = 1000


def run_job(
    spark: SparkSession,
    paths: dict[str, str],
    start_date: str,
    end_date: str,
    out: str,
    mode: str = "errorifexists",
    source: str = "json",
    zone: str = "UTC",
    quarantine: str | None = None,
    layout: Layout = DEFAULT,
) -> dict[str, int]:
    """``paths`` names the ``transactions``, ``rules`` and ``classifier`` files.

    Moments are read and cut to days in ``zone``, whatever the session's own. Reports the
    ids of the rules that are applied, and warns if there are none. Rules that
    can't be applied at all end the job before anything is written. ``mode`` may be ``refresh``, which replaces the
    load dates that the result has and leaves others as they are.

    Lines of transactions that can't be read, as far as the job reads them, are counted and warned of. A transaction of which the id could be read takes part, with nulls for
    what could not. A broken line among the rules or the classifier
    ends the job, unless ``quarantine`` names a folder: there all broken lines are written, with their files, below
    the name of their input and the period, and the job goes on without them. Returns the counts of the run, which come from the
    pass that writes the result.
    """
    own = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        period = Period.parse(start_date, end_date)
        read = {
            "rules": read_rules(spark, paths["rules"], source, broken=True),
            "classifier": read_classifier(spark, paths["classifier"], source, broken=True),
            "transactions": read_transactions(spark, paths["transactions"], source, broken=True),
        }
        used = _used_columns(layout)
        for name in ("rules", "classifier"):
            _refuse_broken(read[name], name, used[name], quarantine, period)
        rules, classifier = (sound_rows(read[n], used[n]) for n in ("rules", "classifier"))
        if bad := rejected_rules(rules, layout).limit(MOST_LISTED).collect():
            listed = ", ".join(f"{r['rid']} ({r['reason']})" for r in bad)
            raise ValueError(f"rules that can't be applied: {listed}")
        valid = validate_rules(rules, classifier, period, layout)
        ids = [r["rid"] for r in applied_rules(valid, layout).limit(MOST_LISTED + 1).collect()]
        if ids:
            more = " and more" if len(ids) > MOST_LISTED else ""
            log.info("applied rules: %s%s", ", ".join(map(str, ids[:MOST_LISTED])), more)
        else:
            log.warning("no rule applies between %s and %s", start_date, end_date)
        transactions = read["transactions"]
        has_lines = BROKEN in transactions.columns
        # A scan of another format is left as it is, so that filters reach it.
        watch = Watch("lines" if has_lines else None, "matches" if ids else None, "result")
        result = classify(sound_rows(watch.lines(transactions), key=layout.key), rules, classifier, start_date, end_date, layout, watch)
        write_result(result, out, mode, layout)
        counts = (watch.found() if ids else {}) or {"rows": 0}
        log.info("counts: %s", ", ".join(f"{k} {v}" for k, v in counts.items()))
        if counts.get("broken"):
            log.warning("%d lines of the transactions can't be read", counts["broken"])
            if quarantine:
                _keep_broken(transactions, "transactions", used["transactions"], quarantine, period)
        return counts
    finally:
        spark.conf.set("spark.sql.session.timeZone", own)


def _used_columns(layout: Layout) -> dict[str, list[str]]:
    """The columns that decide about a result. Lines that are broken elsewhere only are as good as others."""
    of_side = [c for s in layout.sides for c in (s.item, s.code_list, s.account_list)]
    modes = [layout.account_mode, layout.purpose_mode, layout.purpose_list]
    both = [c for s in layout.sides for c in (s.account, s.code)]
    return {
        "rules": [layout.rule_key, *of_side, *modes, layout.rule_start, layout.rule_end],
        "classifier": [layout.cls_code, layout.cls_item, layout.cls_from, layout.cls_to],
        "transactions": [layout.key, layout.posted, layout.loaded, layout.purpose, *both],
    }


def _refuse_broken(read: DataFrame, name: str, columns: list[str], quarantine: str | None, period: Period) -> None:
    if BROKEN not in read.columns:
        return
    n = broken_lines(read, columns).count()
    if not n:
        return
    if not quarantine:
        raise ValueError(f"{n} lines of the {name} can't be read")
    log.warning("%d lines of the %s can't be read", n, name)
    _keep_broken(read, name, columns, quarantine, period)


def _keep_broken(read: DataFrame, name: str, columns: list[str], quarantine: str, period: Period) -> None:
    """Write the broken lines; a run for the same period replaces them."""
    path = f"{quarantine.rstrip('/')}/{name}/period={period.start}_{period.end}"
    broken_lines(read, columns).write.mode("overwrite").parquet(path)


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="ledgertag", description=__doc__)
    # How the flags are spelt.
    parser.add_argument("-s", "--start", "--start_date", dest="start_date")
    parser.add_argument("-e", "--end", "--end_date", dest="end_date")
    parser.add_argument("-q", "--quiet", action="store_true")
    parser.add_argument("--transactions", required=True)
    parser.add_argument("--rules", required=True)
    parser.add_argument("--classifier", required=True)
    parser.add_argument("--out", required=True)
    parser.add_argument("--mode", default="errorifexists")
    parser.add_argument("--source", default="json")
    parser.add_argument("--zone", default="UTC")
    parser.add_argument("--quarantine")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    args = arguments(argv)
    logging.basicConfig(level=logging.WARNING if args.quiet else logging.INFO)
    log.info("period %s to %s", args.start_date, args.end_date)
    spark = SparkSession.builder.appName("ledgertag").getOrCreate()
    paths = {n: getattr(args, n) for n in ("transactions", "rules", "classifier")}
    run_job(
        spark,
        paths,
        args.start_date,
        args.end_date,
        args.out,
        args.mode,
        args.source,
        args.zone,
        args.quarantine,
    )


if __name__ == "__main__":
    main()
