"""The whole classification as one plan."""

from __future__ import annotations

from datetime import date

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ledgertag.config import DEFAULT, Layout
from ledgertag.functions.period import Period
from ledgertag.functions.tags import taggable
from ledgertag.operators.apply import apply_rules
from ledgertag.operators.compile import assigning, compile_rules
from ledgertag.operators.resolve import candidates, consolidate, merge_ids
from ledgertag.operators.tag import tag_sides
from ledgertag.operators.validate import validate_rules
from ledgertag.sources.readers import BROKEN


class Watch:
    """Counts taken while the result is computed, without an action of their own.

    As rows are counted where they pass, a stage that runs again after a loss of executors may be counted again.
    Without names nothing is counted and no plan changes.
    """

    def __init__(self, lines: str | None = None, matches: str | None = None, result: str | None = None):
        self._seen = {k: Observation(n) if n else None for k, n in (("lines", lines), ("matches", matches), ("result", result))}
        self._names: dict[str, list[str]] = {}

    def lines(self, read: DataFrame) -> DataFrame:
        """Counts the lines of a scan that can't be read."""
        broken = F.count_if(F.col(BROKEN).isNotNull()) if BROKEN in read.columns else F.lit(0).cast("long")
        return self._observe("lines", read, {"lines": F.count(F.lit(1)), "broken": broken})

    def matches(self, pairs: DataFrame) -> DataFrame:
        """Counts pairs of transactions and rules, and the rules that matched, approximately."""
        return self._observe("matches", pairs, {"matches": F.count(F.lit(1)), "rules": F.approx_count_distinct("rid")})

    def result(self, rows: DataFrame, layout: Layout = DEFAULT) -> DataFrame:
        tagged = {f"{s.name}_tagged": F.count(s.result) for s in layout.sides}
        return self._observe("result", rows, {"rows": F.count(F.lit(1))} | tagged)

    def _observe(self, name: str, df: DataFrame, metrics: dict[str, Column]) -> DataFrame:
        self._names[name] = list(metrics)
        seen = self._seen[name]
        return df.observe(seen, *[c.alias(n) for n, c in metrics.items()]) if seen else df

    def found(self) -> dict[str, int]:
        """All counts, once the result has been computed. What Spark left out of the plan, as no row came there, counts as 0."""
        counts = {}
        for name, seen in self._seen.items():
            if seen:
                try:
                    counts |= seen.get
                except Py4JJavaError:  # an observation without a row
                    counts |= dict.fromkeys(self._names[name], 0)
        return counts


def classify(
    tx: DataFrame,
    rules: DataFrame,
    classifier: DataFrame,
    start_date: str | date,
    end_date: str | date,
    layout: Layout = DEFAULT,
    watch: Watch | None = None,
) -> DataFrame:
    """Tag transactions of a period with the items of the rules they meet.

    Building the plan checks, freezes and measures the rules, which are two actions over
    them; the transactions are not read before the caller's action. A rule that can't be
    applied (see :func:`ledgertag.operators.compile.rejected_rules`) raises an error that
    names it. Without a rule that applies the result is empty and has the same columns. ``watch`` counts
    what passes while the result is computed.
    """
    watch = watch or Watch()
    period = Period.parse(start_date, end_date)
    valid = validate_rules(rules, classifier, period, layout)
    compiled = assigning(compile_rules(valid, period, layout))
    matches = watch.matches(apply_rules(taggable_rows(tx, period, layout), compiled, layout))
    found = candidates(tag_sides(matches, layout), layout)
    result = watch.result(consolidate(merge_ids(found, layout), layout), layout)
    return result.select(
        layout.key,
        layout.loaded,
        layout.posted,
        F.current_timestamp().alias(layout.created),
        layout.debit.result,
        layout.credit.result,
    )


def taggable_rows(tx: DataFrame, period: Period, layout: Layout = DEFAULT) -> DataFrame:
    """The columns and rows that can lead to a tag; the filters reach the scan."""
    dt, kt = layout.sides
    return tx.filter(
        period.covers(F.col(layout.posted))
        & F.col(layout.key).isNotNull()
        & (taggable(F.col(dt.account), layout) | taggable(F.col(kt.account), layout))
    ).select(
        layout.key,
        layout.posted,
        layout.loaded,
        dt.account,
        kt.account,
        dt.code,
        kt.code,
        layout.purpose,
    )
