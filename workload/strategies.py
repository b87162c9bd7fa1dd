"""Other ways to apply rules, as yardsticks for tests and the benchmark.

``literal``   rules become literal predicates of one projection; one pass, no join.
``per_rule``  one filter per rule and a union; as many passes as rules.

Both bring the rules to the driver, and their plans grow with the number of rules.
"""

from __future__ import annotations

from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from ledgertag.config import DEFAULT, Layout
from ledgertag.functions.period import Period, day, within_days
from ledgertag.operators.apply import RULE_COLUMNS, apply_rules, no_matches
from ledgertag.operators.compile import ACCOUNT_LISTS, assigning, compile_rules
from ledgertag.operators.lookup import MOST_PAIRS
from ledgertag.operators.resolve import candidates, consolidate, merge_ids
from ledgertag.operators.tag import tag_sides
from ledgertag.operators.validate import validate_rules
from ledgertag.plans.classify import taggable_rows


def literal_condition(rule: Row, layout: Layout = DEFAULT, codes: bool = True) -> Column:
    """The whole condition of one rule, with its masks and dates as literals; all but its codes if these are met already."""
    dt, kt = layout.sides

    def listed(column: str, name: str) -> list[Column]:
        return [literal_any(F.col(column), rule[name])] if rule[name] else []

    accounts = listed(dt.account, "dt_accounts") + listed(kt.account, "kt_accounts")
    purposes = listed(layout.purpose, "purposes")
    terms = [within_days(F.col(layout.posted), day(rule["lo"]), day(rule["hi"]))]
    if codes:
        terms += listed(dt.code, "dt_codes") + listed(kt.code, "kt_codes")
    for group, include in (
        (accounts, rule["account_include"]),
        (purposes, rule["purpose_include"]),
    ):
        if group:
            together = reduce(Column.__and__, group)
            terms.append(together if include else ~together)
    return reduce(Column.__and__, terms)


def is_whole(pattern: str) -> bool:
    return not any(c in pattern for c in "%_\\")


def literal_any(value: Column, patterns: list[str]) -> Column:
    whole = [p for p in patterns if is_whole(p)]
    terms = [value.like(p) for p in patterns if p not in whole]
    if whole:
        terms.insert(0, value.isin(whole))
    return reduce(Column.__or__, terms)


def match_literal(tx: DataFrame, rules: list[Row], layout: Layout = DEFAULT) -> DataFrame:
    """One pass: the positions of the rules that match each row, exploded.

    Rules that differ in nothing but two whole codes are one predicate, which looks the codes up in a literal map. No higher-order
    function is used, as Spark interprets one with all predicates below it.
    """
    if not rules:
        return no_matches(tx)
    none = F.array().cast("array<int>")
    alike: dict[tuple, list[int]] = {}
    for n, rule in enumerate(rules):
        alike.setdefault(_but_for_codes(rule) or (n,), []).append(n)
    single = [group[0] for group in alike.values() if len(group) == 1]
    hits = F.array(*[F.when(literal_condition(rules[n], layout), F.lit(n)).otherwise(-1) for n in single])
    found = [F.array_remove(hits, -1)] if single else []
    for group in alike.values():
        if len(group) > 1:
            met = literal_condition(rules[group[0]], layout, codes=False)
            found.append(F.coalesce(F.when(met, _by_codes(rules, group, layout)), none))
    found = tx.select(*tx.columns, F.explode(F.concat(*found)).alias("_hit"))
    return found.select(
        *tx.columns, *[_value(rules, c, F.col("_hit")) for c in RULE_COLUMNS]
    )


def _but_for_codes(rule: Row) -> tuple | None:
    """What else a rule demands, if it has whole codes only, on both sides, and not too many pairs of them."""
    pairs = len(rule["dt_codes"]) * len(rule["kt_codes"])
    if not 1 <= pairs <= MOST_PAIRS or not all(map(is_whole, rule["dt_codes"] + rule["kt_codes"])):
        return None
    rest = [rule[n] for n in (*ACCOUNT_LISTS, "purposes")]
    return (rule["lo"], rule["hi"], rule["account_include"], rule["purpose_include"], *map(tuple, rest))


def _by_codes(rules: list[Row], group: list[int], layout: Layout) -> Column:
    """The positions of the rules that have the codes of a row, null for none, from one literal map in another."""
    pairs: dict[str, dict[str, list[int]]] = {}
    for n in group:
        for d, k in product(set(rules[n]["dt_codes"]), set(rules[n]["kt_codes"])):
            pairs.setdefault(d, {}).setdefault(k, []).append(n)

    def literal_map(entries: dict, value) -> Column:
        return F.create_map(*[c for key, v in entries.items() for c in (F.lit(key), value(v))])

    nested = literal_map(pairs, lambda inner: literal_map(inner, lambda found: F.array(*map(F.lit, found))))
    dt, kt = layout.sides
    return nested[F.col(dt.code)][F.col(kt.code)]


def match_per_rule(tx: DataFrame, rules: list[Row], layout: Layout = DEFAULT) -> DataFrame:
    if not rules:
        return no_matches(tx)
    parts = [
        tx.filter(literal_condition(r, layout)).select(
            *tx.columns, *[_value([r], c, F.lit(0)) for c in RULE_COLUMNS]
        )
        for r in rules
    ]
    return reduce(DataFrame.unionAll, parts)


def _value(rules: list[Row], name: str, position: Column) -> Column:
    kind = "bigint" if name == "rid" else "string"
    listed = F.array(*[F.lit(r[name]).cast(kind) for r in rules])
    return F.get(listed, position).alias(name)


WAYS = {"literal": match_literal, "per_rule": match_per_rule}
STRATEGIES = ("join", *WAYS)


def apply_by(strategy: str, tx: DataFrame, compiled: DataFrame, layout: Layout = DEFAULT) -> DataFrame:
    if strategy == "join":
        return apply_rules(tx, compiled, layout)
    return WAYS[strategy](tx, compiled.collect(), layout)


def classify_by(
    strategy: str,
    tx: DataFrame,
    rules: DataFrame,
    classifier: DataFrame,
    start_date,
    end_date,
    layout: Layout = DEFAULT,
) -> DataFrame:
    """As :func:`ledgertag.classify`, with another way to apply the rules."""
    period = Period.parse(start_date, end_date)
    valid = validate_rules(rules, classifier, period, layout)
    compiled = assigning(compile_rules(valid, period, layout))
    matches = apply_by(strategy, taggable_rows(tx, period, layout), compiled, layout)
    found = candidates(tag_sides(matches, layout), layout)
    return consolidate(merge_ids(found, layout), layout).withColumn(
        layout.created, F.current_timestamp()
    )
