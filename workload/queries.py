"""One query per operator, each over the whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgertag import CREDIT, DEBIT, classify
from ledgertag.functions.period import Period, within_days
from ledgertag.operators import compile as rule_forms
from ledgertag.operators import resolve, validate
from ledgertag.operators.apply import apply_rules
from ledgertag.operators.lookup import finds_whole_values, with_path
from ledgertag.operators.tag import blank_tags, tag_sides, with_priorities
from ledgertag.functions.tags import forced
from ledgertag.operators.settle import settle, shared_folder
from ledgertag.sources.sinks import lookup, write_result
from workload import tables
from workload.strategies import classify_by

Query = Callable[[SparkSession, str], DataFrame]

MATCH = ("id_pk", "operation_date", "rid")
RESULT = (
    "id_pk",
    "input_dt",
    "operation_date",
    "dt_tax_item_auto",
    "kt_tax_item_auto",
)
# A transaction that is tagged at every scale of the test tables.
LOOKED_UP = "100-1"


@dataclass
class Inputs:
    """The relations of one scale and the steps built on them."""

    spark: SparkSession
    sf_dir: str

    period = Period.parse(tables.START, tables.END)

    @cached_property
    def tx(self) -> DataFrame:
        return tables.transactions(self.spark, self.sf_dir)

    @cached_property
    def rules(self) -> DataFrame:
        """Frozen: else Spark brings conditions on rules below their grouping and tests them on every part."""
        return settle(tables.rules(self.spark, self.sf_dir))

    @cached_property
    def classifier(self) -> DataFrame:
        return tables.classifier(self.spark, self.sf_dir)

    @cached_property
    def compiled(self) -> DataFrame:
        """All rules that can match, agreed with the classifier or not."""
        return rule_forms.compile_rules(self.rules, self.period)

    @cached_property
    def applied(self) -> DataFrame:
        """Only the rules that passed validation."""
        valid = validate.validate_rules(self.rules, self.classifier, self.period)
        return rule_forms.compile_rules(valid, self.period)

    @cached_property
    def in_period(self) -> DataFrame:
        return self.tx.filter(self.period.covers(F.col("operation_date")))

    @cached_property
    def matches(self) -> DataFrame:
        return apply_rules(self.in_period, self.applied)

    @cached_property
    def tagged(self) -> DataFrame:
        return blank_tags(tag_sides(self.matches))

    def written(self) -> DataFrame:
        """The result as the sink has written it, below the shared folder."""
        path = f"{shared_folder(self.spark).rstrip('/')}/result-{uuid.uuid4().hex}"
        write_result(self.classified(), path)
        return self.spark.read.parquet(path)

    def classified(self) -> DataFrame:
        return classify(
            self.tx, self.rules, self.classifier, tables.START, tables.END
        ).select(*RESULT)


REGISTRY: dict[str, Query] = {}


def query(build: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
    REGISTRY[build.__name__] = lambda spark, sf_dir: build(Inputs(spark, sf_dir))
    return build


def both_sides(build: Callable[..., DataFrame]) -> DataFrame:
    """The rows of both sides with a ``side`` column."""
    parts = [build(s).withColumn("side", F.lit(s.name)) for s in (DEBIT, CREDIT)]
    return parts[0].unionByName(parts[1])


# --- relations ----------------------------------------------------------


@query
def tx_view(i: Inputs) -> DataFrame:
    return i.tx


@query
def rules_view(i: Inputs) -> DataFrame:
    return i.rules


@query
def classifier_view(i: Inputs) -> DataFrame:
    return i.classifier


@query
def operation_day(i: Inputs) -> DataFrame:
    day = F.to_date("operation_date")
    return i.tx.select("id_pk", day.alias("op_day"), F.to_date("input_dt").alias("input_dt"))


# --- rules --------------------------------------------------------------


@query
def mask_explode(i: Inputs) -> DataFrame:
    return rule_forms.mask_explode(i.rules)


@query
def mask_presence(i: Inputs) -> DataFrame:
    return rule_forms.mask_presence(i.rules)


@query
def rules_compiled(i: Inputs) -> DataFrame:
    return rule_forms.mask_lists(i.rules).select(
        "rid", *[F.size(n).alias(f"n_{n}") for n in rule_forms.MASK_LISTS]
    )


@query
def rule_no_conditions(i: Inputs) -> DataFrame:
    return rule_forms.no_conditions(i.rules)


@query
def rule_window(i: Inputs) -> DataFrame:
    return rule_forms.rule_windows(i.rules, i.period)


@query
def rule_effective_end(i: Inputs) -> DataFrame:
    return rule_forms.rule_windows(i.rules, i.period).select(
        "rid", F.col("hi").alias("effective_end")
    )


@query
def literal_rules(i: Inputs) -> DataFrame:
    return both_sides(
        lambda s: validate.literal_rules(i.rules, s).select(F.col("id_pk").alias("rid"))
    )


@query
def forced_rules(i: Inputs) -> DataFrame:
    return both_sides(
        lambda s: i.rules.filter(forced(F.col(s.item))).select(
            F.col("id_pk").alias("rid")
        )
    )


@query
def rule_classifier_join(i: Inputs) -> DataFrame:
    return both_sides(
        lambda s: validate.classifier_join(i.rules, i.classifier, s).select(
            F.col("id_pk").alias("rid"), "tax_item_ofr", "tax_item_code"
        )
    )


@query
def rule_classifier_asof(i: Inputs) -> DataFrame:
    return both_sides(
        lambda s: validate.classifier_asof(i.rules, i.classifier, s, i.period).select(
            F.col("id_pk").alias("rid"), "tax_item_ofr", "tax_item_code"
        )
    )


@query
def rule_check_side_dt(i: Inputs) -> DataFrame:
    return validate.validate_side(i.rules, i.classifier, DEBIT, i.period).select(
        F.col("id_pk").alias("rid")
    )


@query
def rule_check_side_kt(i: Inputs) -> DataFrame:
    return validate.validate_side(i.rules, i.classifier, CREDIT, i.period).select(
        F.col("id_pk").alias("rid")
    )


@query
def validated_rules(i: Inputs) -> DataFrame:
    return validate.validate_rules(i.rules, i.classifier, i.period).select(
        F.col("id_pk").alias("rid")
    )


@query
def applied_rules(i: Inputs) -> DataFrame:
    return validate.applied_rules(
        validate.validate_rules(i.rules, i.classifier, i.period)
    )


# --- single conditions --------------------------------------------------


def one_condition(i: Inputs, *lists: str, **changes: Column) -> DataFrame:
    rules = rule_forms.only_lists(i.compiled.withColumns(changes), *lists)
    return apply_rules(i.tx, rules).select(*MATCH)


@query
def mask_any_like(i: Inputs) -> DataFrame:
    """Any mask of the purpose list, whatever the mode of the rule."""
    return one_condition(i, "purposes", purpose_include=F.lit(True))


@query
def match_source_code(i: Inputs) -> DataFrame:
    return one_condition(i, *rule_forms.CODE_LISTS)


@query
def match_account(i: Inputs) -> DataFrame:
    return one_condition(i, *rule_forms.ACCOUNT_LISTS)


@query
def match_purpose(i: Inputs) -> DataFrame:
    return one_condition(i, "purposes")


@query
def match_all(i: Inputs) -> DataFrame:
    """All conditions of a rule, at any date."""
    return one_condition(i, *rule_forms.MASK_LISTS)


@query
def match_window(i: Inputs) -> DataFrame:
    """Transactions per day on which a rule counts.

    Days are moments at midnight, on which the operator's own condition is tested; the rules are brought to
    the days they could cover first, so that both sides meet by equality.
    """
    day = F.to_date("operation_date").alias("op_day")
    counts = i.tx.groupBy(day).agg(F.count("*").alias("n"))
    windows = rule_forms.rule_windows(i.rules, i.period)
    months = F.sequence(F.trunc("lo", "month"), F.col("hi"), F.expr("interval 1 month"))
    near = windows.filter("lo <= hi").select("rid", "lo", "hi", F.explode(months).alias("month"))
    dated = counts.withColumn("month", F.trunc("op_day", "month"))
    moment = F.col("op_day").cast("timestamp")
    met = near.join(dated, "month").filter(within_days(moment, F.col("lo"), F.col("hi")))
    return met.select("rid", "op_day", "n")


# --- application --------------------------------------------------------


@query
def apply_rules_all(i: Inputs) -> DataFrame:
    return i.matches.select(*MATCH)


REGISTRY["apply_rules"] = REGISTRY.pop("apply_rules_all")


@query
def apply_rules_equi(i: Inputs) -> DataFrame:
    """Rules found by a whole value."""
    return _by_path(i, finds_whole_values(F.col("path")))


@query
def apply_rules_theta(i: Inputs) -> DataFrame:
    """Rules found by a prefix or only by checking every transaction."""
    return _by_path(i, ~finds_whole_values(F.col("path")))


def _by_path(i: Inputs, chosen: Column) -> DataFrame:
    rules = with_path(i.applied).filter(chosen).drop("path", "keys")
    return apply_rules(i.in_period, rules).select(*MATCH)


@query
def tag_sides_raw(i: Inputs) -> DataFrame:
    return tag_sides(i.matches).select(*MATCH, "dt_tax_item", "kt_tax_item")


REGISTRY["tag_sides"] = REGISTRY.pop("tag_sides_raw")


@query
def blank_to_null(i: Inputs) -> DataFrame:
    return i.tagged.select(*MATCH, "dt_tax_item", "kt_tax_item")


@query
def tag_priority(i: Inputs) -> DataFrame:
    return with_priorities(i.tagged).select(*MATCH, "dt_prio", "kt_prio")


# --- resolution ---------------------------------------------------------

WINNER = (
    "id_pk",
    "input_dt",
    "operation_date",
    "rid",
    "dt_tax_item",
    "kt_tax_item",
)


@query
def resolve_side_dt(i: Inputs) -> DataFrame:
    return resolve.resolve_side(i.tagged, DEBIT).select(*WINNER)


@query
def resolve_side_kt(i: Inputs) -> DataFrame:
    return resolve.resolve_side(i.tagged, CREDIT).select(*WINNER)


@query
def resolve_union(i: Inputs) -> DataFrame:
    return resolve.resolve_union(i.tagged).select(*WINNER, "side")


@query
def report_projection(i: Inputs) -> DataFrame:
    return resolve.report(resolve.resolve_union(i.tagged))


@query
def consolidate_items(i: Inputs) -> DataFrame:
    return resolve.consolidate_items(
        resolve.report(resolve.resolve_union(i.tagged))
    )


@query
def consolidate(i: Inputs) -> DataFrame:
    merged = resolve.merge_ids(resolve.candidates(i.tagged))
    return resolve.consolidate(merged).select(*RESULT)


@query
def classify_transactions(i: Inputs) -> DataFrame:
    return i.classified()


@query
def classify_join(i: Inputs) -> DataFrame:
    """As ``classify_transactions``: the join is the only way."""
    return i.classified()


@query
def classify_literal(i: Inputs) -> DataFrame:
    """All rules as literal predicates, the yardstick without a join."""
    return classify_by(
        "literal", i.tx, i.rules, i.classifier, tables.START, tables.END
    ).select(*RESULT)


@query
def rejected_rules(i: Inputs) -> DataFrame:
    """What can't be applied, among the rules, copies with a stray escape and copies without an id."""
    list_ = "payment_purpose_pattern_list"
    stray = i.rules.withColumns({"id_pk": F.col("id_pk") + 10_000_000, list_: F.concat(list_, F.lit("a\\b"))})
    nameless = i.rules.filter(F.col(list_) != "").withColumn("id_pk", F.lit(None).cast("long"))
    return rule_forms.rejected_rules(i.rules.unionByName(stray).unionByName(nameless))


@query
def sink_partition_counts(i: Inputs) -> DataFrame:
    return i.written().groupBy("input_dt").agg(F.count("*").alias("n"))


@query
def count_tagged(i: Inputs) -> DataFrame:
    return i.classified().agg(F.count("*").alias("n"))


@query
def point_lookup(i: Inputs) -> DataFrame:
    return lookup(i.written(), LOOKED_UP).select(*RESULT)
