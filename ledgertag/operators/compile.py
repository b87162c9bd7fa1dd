"""Rules in the form that is applied: mask arrays, plain flags, a date window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgertag.config import DEFAULT, Layout
from ledgertag.functions.masks import all_valid, compile_masks
from ledgertag.functions.period import Period
from ledgertag.functions.tags import blank_to_null

CODE_LISTS = ("dt_codes", "kt_codes")
ACCOUNT_LISTS = ("dt_accounts", "kt_accounts")
MASK_LISTS = (*CODE_LISTS, *ACCOUNT_LISTS, "purposes")


def mask_lists(rules: DataFrame, layout: Layout = DEFAULT) -> DataFrame:
    """The five mask lists of every rule as arrays of LIKE patterns."""
    dt, kt = layout.sides
    raw = (
        dt.code_list,
        kt.code_list,
        dt.account_list,
        kt.account_list,
        layout.purpose_list,
    )
    return rules.select(
        F.col(layout.rule_key).alias("rid"),
        *[compile_masks(F.col(c)).alias(n) for c, n in zip(raw, MASK_LISTS)],
    )


def mask_presence(rules: DataFrame, layout: Layout = DEFAULT) -> DataFrame:
    """Which conditions a rule has at all."""
    return mask_lists(rules, layout).select("rid", *_presence())


def mask_explode(rules: DataFrame, layout: Layout = DEFAULT) -> DataFrame:
    """One row per mask."""
    named = F.array(
        *[
            F.struct(F.lit(n).alias("list_name"), F.col(n).alias("masks"))
            for n in MASK_LISTS
        ]
    )
    return (
        mask_lists(rules, layout)
        .select("rid", F.inline(named))
        .select("rid", "list_name", F.explode("masks").alias("mask"))
    )


def no_conditions(rules: DataFrame, layout: Layout = DEFAULT) -> DataFrame:
    """Ids of rules without any condition; they match nothing."""
    return mask_lists(rules, layout).filter(~has_condition()).select("rid")


def rule_windows(
    rules: DataFrame, period: Period, layout: Layout = DEFAULT
) -> DataFrame:
    """First and last day on which each rule counts in this run."""
    return rules.select(
        F.col(layout.rule_key).alias("rid"),
        period.begin_of(F.col(layout.rule_start)).alias("lo"),
        period.end_of(F.col(layout.rule_end)).alias("hi"),
    )


def compile_rules(
    rules: DataFrame, period: Period, layout: Layout = DEFAULT
) -> DataFrame:
    """One row per rule that can match something.

    Left out: rules without conditions or with an empty window. A rule without an id or with a mask
    that LIKE refuses raises an error; :func:`rejected_rules` lists them all.
    """
    dt, kt = layout.sides
    raw = {
        "dt_codes": dt.code_list,
        "kt_codes": kt.code_list,
        "dt_accounts": dt.account_list,
        "kt_accounts": kt.account_list,
        "purposes": layout.purpose_list,
    }
    includes = {
        "account_include": layout.account_mode,
        "purpose_include": layout.purpose_mode,
    }
    return (
        rules.select(
            F.col(layout.rule_key).alias("rid"),
            F.col(dt.item).alias("dt_item"),
            F.col(kt.item).alias("kt_item"),
            *[compile_masks(F.col(c)).alias(n) for n, c in raw.items()],
            *[
                F.coalesce(F.col(c) == layout.include, F.lit(False)).alias(n)
                for n, c in includes.items()
            ],
            period.begin_of(F.col(layout.rule_start)).alias("lo"),
            period.end_of(F.col(layout.rule_end)).alias("hi"),
        )
        .filter(has_condition() & (F.col("lo") <= F.col("hi")))
        .withColumn("rid", _checked())
        .filter(F.col("rid").isNotNull())
    )


def _checked() -> Column:
    """The rule's id; an error if there is none, or if LIKE refuses a mask."""
    sound = F.col("rid").isNotNull()
    for name in MASK_LISTS:
        sound = sound & all_valid(F.col(name))
    named = F.coalesce(F.col("rid").cast("string"), F.lit("without id"))
    refused = F.raise_error(F.concat(F.lit("a rule can't be applied, see rejected_rules: "), named))
    return F.when(sound, F.col("rid")).otherwise(refused.cast("bigint"))


def rejected_rules(rules: DataFrame, layout: Layout = DEFAULT) -> DataFrame:
    """``rid, reason`` of rules that can't be applied: without an id, or with a mask that LIKE refuses.

    A mask is refused for a stray escape character. A rule is listed once per reason.
    """
    named = mask_lists(rules, layout)
    stray = [
        F.when(~all_valid(F.col(n)), F.lit(f"stray escape in {n}")) for n in MASK_LISTS
    ]
    without = F.when(F.col("rid").isNull(), F.lit("no id"))
    reasons = F.array_compact(F.array(without, *stray))
    return named.select("rid", F.explode(reasons).alias("reason"))


def assigning(compiled: DataFrame) -> DataFrame:
    """Compiled rules that assign an item at all, blank items as null."""
    items = {n: blank_to_null(F.col(n)) for n in ("dt_item", "kt_item")}
    return compiled.withColumns(items).filter(
        F.col("dt_item").isNotNull() | F.col("kt_item").isNotNull()
    )


def only_lists(compiled: DataFrame, *kept: str) -> DataFrame:
    """Compiled rules reduced to some of their mask lists, valid at any time."""
    empty = F.array().cast("array<string>")
    blanked = {n: empty for n in MASK_LISTS if n not in kept}
    open_end = {"lo": F.lit("0001-01-01"), "hi": F.lit("9999-12-31")}
    return compiled.withColumns(
        blanked | {n: day.cast("date") for n, day in open_end.items()}
    ).filter(has_condition())


def has_condition() -> Column:
    sizes = [F.size(n) for n in MASK_LISTS]
    return sum(sizes[1:], sizes[0]) > 0


def _presence() -> list[Column]:
    # The names these flags go by.
    flags = ("has_dt_ofr", "has_kt_ofr", "has_dt_acct", "has_kt_acct", "has_purpose")
    return [(F.size(n) > 0).alias(flag) for n, flag in zip(MASK_LISTS, flags)]
