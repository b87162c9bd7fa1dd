"""Which rules may be applied: agreement with the dated classifier."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgertag.config import DEFAULT, Layout, Side
from ledgertag.functions.masks import has_wildcard
from ledgertag.functions.period import LEVELS, Period, day, dyadic, interval_of
from ledgertag.functions.tags import forced

# Rows of one code and item in the classifier that a rule is compared with one by one.
MANY_VERSIONS = 64


def literal_rules(rules: DataFrame, side: Side) -> DataFrame:
    """Rules whose code list on ``side`` is present and free of wildcards."""
    codes = F.col(side.code_list)
    return rules.filter((codes != "") & ~has_wildcard(codes))


def classifier_join(
    rules: DataFrame, classifier: DataFrame, side: Side, layout: Layout = DEFAULT
) -> DataFrame:
    """Rules beside the classifier rows of the same code and item.

    The whole list is compared, so only a single code can agree. Neither side
    carries a hint: Spark broadcasts the smaller one when its size allows.
    """
    entries = classifier.select(
        layout.cls_code, layout.cls_item, layout.cls_from, layout.cls_to
    )
    agrees = (F.col(side.code_list) == F.col(layout.cls_code)) & (
        F.col(side.item) == F.col(layout.cls_item)
    )
    return literal_rules(rules, side).join(entries, agrees, "inner")


def classifier_asof(
    rules: DataFrame,
    classifier: DataFrame,
    side: Side,
    period: Period,
    layout: Layout = DEFAULT,
) -> DataFrame:
    """The part of :func:`classifier_join` that is valid when the rule ends.

    Where a code and item have more than ``MANY_VERSIONS`` rows in the classifier, each row is laid out as the dyadic intervals
    that make up its days, and a rule looks for the interval of each level in which its end lies: both sides meet by equality.
    """
    end = period.end_of(F.col(layout.rule_end))
    code, item = F.col(layout.cls_code), F.col(layout.cls_item)
    # Nothing is looked for after the period.
    until = F.least(F.coalesce(F.col(layout.cls_to), day(period.end)), day(period.end))
    entries = classifier.select(
        code, item, layout.cls_from, layout.cls_to, until.alias("_until")
    ).filter(F.col(layout.cls_from) <= F.col("_until"))
    many = entries.groupBy(code.alias("_code"), item.alias("_item")).count().filter(F.col("count") > MANY_VERSIONS)
    many = many.select("_code", "_item", F.lit(True).alias("_many"))
    undated = F.struct(F.lit(-1).alias("level"), F.lit(0).alias("place"))
    of_entry = (code == F.col("_code")) & (item == F.col("_item"))
    laid = entries.join(many, of_entry, "left").select(
        *[c for c in entries.columns if c != "_until"],
        F.inline(
            F.when(F.col("_many"), dyadic(F.col(layout.cls_from), F.col("_until"))).otherwise(F.array(undated))
        ).alias("_level", "_place"),
    )
    claims = literal_rules(rules, side).withColumn("_end", end)
    levels = F.transform(
        F.sequence(F.lit(0), F.lit(LEVELS - 1)),
        lambda n: F.struct(n.alias("level"), interval_of(F.col("_end"), n).alias("place")),
    )
    asked = claims.select(
        *rules.columns, "_end", F.inline(F.array_prepend(levels, undated)).alias("_at_level", "_at_place")
    )
    agrees = (
        (F.col(side.code_list) == code)
        & (F.col(side.item) == item)
        & (F.col("_at_level") == F.col("_level"))
        & (F.col("_at_place") == F.col("_place"))
        & (F.col(layout.cls_from) <= F.col("_end"))
        & (F.col(layout.cls_to).isNull() | (F.col(layout.cls_to) >= F.col("_end")))
    )
    own = [*rules.columns, layout.cls_code, layout.cls_item, layout.cls_from, layout.cls_to]
    return asked.join(laid, agrees, "inner").select(*own)


def validate_side(
    rules: DataFrame,
    classifier: DataFrame,
    side: Side,
    period: Period,
    layout: Layout = DEFAULT,
) -> DataFrame:
    """Rules that agree with the classifier on ``side`` or have a forced item there."""
    agreed = classifier_asof(rules, classifier, side, period, layout)
    return _keep(rules, agreed.select(layout.rule_key), (side,), layout)


def validate_rules(
    rules: DataFrame, classifier: DataFrame, period: Period, layout: Layout = DEFAULT
) -> DataFrame:
    """Rules that pass on either side, each listed once.

    Both sides are laid below each other and meet the classifier in one join.
    """
    claims = F.array(
        *[
            F.struct(F.col(s.code_list).alias("codes"), F.col(s.item).alias("item"))
            for s in layout.sides
        ]
    )
    laid = rules.select(layout.rule_key, layout.rule_end, F.inline(claims))
    one = Side("", "", "", "item", "codes", "", "")
    agreed = classifier_asof(laid, classifier, one, period, layout)
    return _keep(rules, agreed.select(layout.rule_key), layout.sides, layout)


def applied_rules(rules: DataFrame, layout: Layout = DEFAULT) -> DataFrame:
    """Ids of the given rules in order."""
    return rules.select(F.col(layout.rule_key).alias("rid")).distinct().orderBy("rid")


def _keep(
    rules: DataFrame, agreed: DataFrame, sides: tuple[Side, ...], layout: Layout
) -> DataFrame:
    """Rules whose id is among the agreed ones, and forced rules."""
    is_forced = F.lit(False)
    for side in sides:
        mine = forced(F.col(side.item), layout)
        is_forced = is_forced | F.coalesce(mine, F.lit(False))
    marked = agreed.distinct().withColumn("_agreed", F.lit(True))
    return (
        rules.join(marked, layout.rule_key, "left")
        .filter(F.col("_agreed") | is_forced)
        .select(*rules.columns)
    )
