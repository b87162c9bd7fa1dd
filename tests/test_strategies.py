"""All ways to apply rules give the rows of the plain model."""

import random
from collections import Counter
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ledgertag import classify
from ledgertag.functions.period import Period
from ledgertag.operators import apply as application
from ledgertag.operators import lookup
from ledgertag.operators.compile import compile_rules, rejected_rules
from ledgertag.operators.lookup import EVERY, filed, measure
from ledgertag.operators.resolve import (
    candidates,
    consolidate,
    consolidate_items,
    merge_ids,
    report,
    resolve_side,
    resolve_union,
)
from ledgertag.operators.tag import blank_tags, tag_sides
from ledgertag.config import CREDIT, DEBIT
from ledgertag.schemas import CLASSIFIER_SCHEMA
from tests import model
from workload.strategies import STRATEGIES, apply_by, classify_by

START, END = date(2021, 1, 10), date(2021, 3, 20)
TX = (
    "id_pk string, input_dt date, operation_date timestamp, dt_account string, "
    "kt_account string, dt_tax_item_ofr string, kt_tax_item_ofr string, "
    "payment_purpose string"
)
RULE = (
    "id_pk long, dt_tax_item string, kt_tax_item string, "
    "dt_tax_item_ofr_list string, kt_tax_item_ofr_list string, "
    "account_mask_rule string, dt_account_mask_list string, "
    "kt_account_mask_list string, payment_purpose_rule string, "
    "payment_purpose_pattern_list string, start_date date, end_date date"
)


def make_data(seed, transactions=500, rules=24):
    rng = random.Random(seed)
    codes = [None, "", "A1", "A2", "B1", "B_1", "C"]
    accounts = [None, "70601", "70602", "40802", "47423", "7"]
    words = [None, "", "pay x", "pay y", "tax, x", "TAX"]
    items = ["30000", "50000", "9999", "11311", "21495", "", None]
    days = [datetime(2021, 1, 1, 13) + timedelta(days=n) for n in range(0, 90, 3)]
    txs = [
        {
            "id_pk": rng.choice([None] + [str(n) for n in range(transactions // 3)]),
            "input_dt": rng.choice([None, date(2021, 1, 1), date(2021, 1, 2)]),
            "operation_date": rng.choice([None, *days]),
            "dt_account": rng.choice(accounts),
            "kt_account": rng.choice(accounts),
            "dt_tax_item_ofr": rng.choice(codes),
            "kt_tax_item_ofr": rng.choice(codes),
            "payment_purpose": rng.choice(words),
        }
        for _ in range(transactions)
    ]

    def masks(options, likely):
        if rng.random() > likely:
            return rng.choice([None, "", ",,"])
        return ", ".join(rng.choices(options, k=rng.choice([1, 1, 2, 3])))

    code_masks = ["A1", "A2", "B1", "B_1", "C", "A%", "?1", "B?1", "%1", "", "A?%"]
    account_masks = ["70601", "7%", "706??", "%2", "4%", "47423", "7?6%1"]
    purpose_masks = ["pay x", "pay%", "%x", "tax/, x", "%a%", "TAX", "%", "p%y"]
    modes = ["INCLUDE", "EXCLUDE", "", None, "include"]
    dates = [None, *(date(2021, m, 1) for m in (1, 2, 3, 4)), date(1900, 1, 1)]
    rule_rows = [
        {
            "id_pk": rng.choice([n, n, n, n // 2]),
            "dt_tax_item": rng.choice(items),
            "kt_tax_item": rng.choice(items),
            "dt_tax_item_ofr_list": masks(code_masks, 0.6),
            "kt_tax_item_ofr_list": masks(code_masks, 0.3),
            "account_mask_rule": rng.choice(modes),
            "dt_account_mask_list": masks(account_masks, 0.3),
            "kt_account_mask_list": masks(account_masks, 0.3),
            "payment_purpose_rule": rng.choice(modes),
            "payment_purpose_pattern_list": masks(purpose_masks, 0.4),
            "start_date": rng.choice(dates),
            "end_date": rng.choice([None, date(2021, 2, 15), date(9999, 12, 31)]),
        }
        for n in range(rules)
    ]
    classifier = [
        {
            "tax_item_ofr": code,
            "tax_item_code": item,
            "actual_from": rng.choice([date(1990, 1, 1), date(2021, 3, 1)]),
            "actual_to": rng.choice([None, date(2021, 3, 1), date(2030, 1, 1)]),
        }
        for code in ("A1", "A2", "B1", "B_1", "C")
        for item in ("9999", "11311", "21495")
    ]
    return txs, rule_rows, classifier


def frames(spark, txs, rules, classifier):
    def frame(rows, schema):
        names = schema.names if hasattr(schema, "names") else [
            f.strip().split(" ")[0] for f in schema.split(",")
        ]
        return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], schema)

    return frame(txs, TX), frame(rules, RULE), frame(classifier, CLASSIFIER_SCHEMA)


def result_rows(df):
    return Counter(
        (r.id_pk, r.input_dt, r.operation_date, r.dt_tax_item_auto, r.kt_tax_item_auto)
        for r in df.collect()
    )


@pytest.fixture(scope="module", params=[1, 2])
def data(request, spark):
    raw = make_data(request.param)
    return raw, frames(spark, *raw)


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_classification_equals_the_model(data, strategy):
    raw, inputs = data
    expected = model.classify(*raw, START, END)
    assert len(expected) > 30
    got = result_rows(classify_by(strategy, *inputs, START, END))
    assert got == Counter(expected) == result_rows(classify(*inputs, START, END))


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_matches_equal_the_model(data, strategy):
    (txs, rules, _), (tx, rule_df, _) = data
    compiled = compile_rules(rule_df, Period(START, END))
    got = apply_by(strategy, tx, compiled)
    names = [*tx.columns, "rid"]
    expected = Counter(
        (*[t[c] for c in tx.columns], r["id_pk"])
        for t, r in model.pairs(txs, rules, START, END)
    )
    assert sum(expected.values()) > 100
    assert Counter(tuple(r[n] for n in names) for r in got.collect()) == expected


@pytest.mark.parametrize("part", ["blocks", "salted", "nothing fits"])
def test_rules_beyond_the_broadcast_limit(data, part):
    """The salted join, with the rules without a key in one block or in many, changes nothing."""
    (txs, rules, _), (tx, rule_df, _) = data
    compiled = compile_rules(rule_df, Period(START, END))
    found = measure(filed(compiled))
    assert EVERY in found.paths and len(found.paths) > 3 and found.general
    limit = {"blocks": found.every_bytes // 2, "salted": found.keyed_bytes - 1, "nothing fits": 1}[part]
    got = application.apply_rules(tx, compiled, broadcast_bytes=limit)
    expected = Counter(
        (t["id_pk"], r["id_pk"]) for t, r in model.pairs(txs, rules, START, END)
    )
    assert expected
    assert Counter((r.id_pk, r.rid) for r in got.collect()) == expected


@pytest.mark.parametrize("limit", [application.BROADCAST_BYTES, 1])
def test_crowded_keys_are_filed_anew(spark, limit, monkeypatch):
    """Rules by inner texts and by days give the pairs of the plain model, one row per pair of rows."""
    monkeypatch.setattr(lookup, "CROWD", 3)
    rng = random.Random(4)
    txs, rules, _ = make_data(5, transactions=300, rules=30)
    words = ["abcde", "bcdef", "cdefgh", "payment", "ментал", "aaaaaa", "ab", "tax, x"]
    for t in txs:
        t["payment_purpose"] = rng.choice([None, "", " ".join(rng.choices(words, k=rng.randrange(1, 6)))])
    for r in rules:
        masks = [f"%{rng.choice(words)[: rng.randrange(3, 8)].replace(',', '/,')}%" for _ in range(rng.choice([1, 1, 2, 3, 5]))]
        r["payment_purpose_pattern_list"] = ", ".join(masks + rng.choice([[], [], ["%a%b%"], ["%cdefgh%pay_ent%"]]))
        r["payment_purpose_rule"] = rng.choice(["INCLUDE", "INCLUDE", "INCLUDE", "EXCLUDE"])
        if rng.random() < 0.7:
            r["dt_tax_item_ofr_list"] = r["kt_tax_item_ofr_list"] = ""
            r["dt_account_mask_list"] = r["kt_account_mask_list"] = ""
        r["start_date"] = START + timedelta(days=rng.randrange(60))
        r["end_date"] = r["start_date"] + timedelta(days=rng.randrange(12))
    tx, rule_df, _ = frames(spark, txs, rules, [])
    compiled = compile_rules(rule_df, Period(START, END))
    kinds = {lookup.undated(p) for p in measure(lookup.refiled(filed(compiled))).paths}
    assert any(b >= lookup.gram_path(4, 0) for b, _ in kinds) and any(level >= 0 for _, level in kinds)
    got = application.apply_rules(tx, compiled, broadcast_bytes=limit)
    expected = Counter((t["id_pk"], r["id_pk"]) for t, r in model.pairs(txs, rules, START, END))
    assert sum(expected.values()) > 40
    assert Counter((r.id_pk, r.rid) for r in got.collect()) == expected


def test_the_steps_one_by_one_give_the_same_result(data):
    """Side winners, union, greatest items and join back, against the fast form."""
    _, (tx, rules, classifier) = data
    whole = classify(tx, rules, classifier, START, END).drop("created_ts")
    from ledgertag.operators.validate import validate_rules

    period = Period(START, END)
    valid = compile_rules(validate_rules(rules, classifier, period), period)
    matches = application.apply_rules(tx, valid)
    tagged = blank_tags(tag_sides(matches)).filter("id_pk IS NOT NULL")
    columns = resolve_union(tagged).drop("side").columns
    by_side = [resolve_side(tagged, s).select(*columns) for s in (CREDIT, DEBIT)]
    winners = by_side[0].unionByName(by_side[1])
    bag = lambda df: Counter(map(tuple, df.select(*columns).collect()))
    assert bag(winners) == bag(resolve_union(tagged))
    reported = report(winners)
    joined = (
        reported.drop("dt_tax_item_auto", "kt_tax_item_auto")
        .join(consolidate_items(reported), "id_pk")
        .dropDuplicates()
    )
    assert result_rows(joined) == result_rows(whole)
    fast = consolidate(merge_ids(candidates(tagged)))
    assert result_rows(fast) == result_rows(whole)


def test_order_and_copies_of_the_input_do_not_matter(data):
    _, (tx, rules, classifier) = data
    once = result_rows(classify(tx, rules, classifier, START, END))
    for strategy in ("literal", "join"):
        twice = classify_by(
            strategy,
            tx.union(tx).orderBy(F.rand(1)).repartition(5),
            rules.union(rules).orderBy(F.rand(2)),
            classifier.union(classifier),
            START,
            END,
        )
        assert result_rows(twice) == once


def test_rules_that_cannot_be_applied_are_named(spark):
    txs, rules, classifier = make_data(4, rules=3)
    base = dict(rules[0], id_pk=100, dt_tax_item="30000", end_date=None, start_date=None)
    base |= {c: "" for c in base if c.endswith("_list")}
    good = base | {"payment_purpose_pattern_list": "pay%", "payment_purpose_rule": "INCLUDE"}
    bad = good | {"id_pk": 101, "payment_purpose_pattern_list": "pay\\"}
    nameless = good | {"id_pk": None}
    tx, rule_df, cls = frames(spark, txs, [bad, good, nameless], classifier)
    found = {(r.rid, r.reason) for r in rejected_rules(rule_df).collect()}
    assert found == {(101, "stray escape in purposes"), (None, "no id")}
    for some, name in (([bad, good], "101"), ([nameless, good], "without id")):
        _, rule_df, _ = frames(spark, [], some, [])
        with pytest.raises(Exception, match=f"can't be applied.*{name}"):
            classify(tx, rule_df, cls, START, END).collect()
    _, rule_df, _ = frames(spark, [], [good], [])
    assert result_rows(classify(tx, rule_df, cls, START, END)) == Counter(
        model.classify(txs, [good], classifier, START, END)
    )


def test_an_item_of_the_other_side_may_win(spark):
    """The winner of one side brings its rule's item for the other side along."""
    tx = {
        "id_pk": "1",
        "input_dt": date(2021, 2, 1),
        "operation_date": datetime(2021, 2, 1),
        "dt_account": "70601",
        "kt_account": "70602",
        "dt_tax_item_ofr": "A1",
        "kt_tax_item_ofr": "C",
        "payment_purpose": "pay x",
    }
    blank = dict.fromkeys([f.strip().split(" ")[0] for f in RULE.split(",")], "")
    dates = {"start_date": None, "end_date": None}
    forced = blank | dates | {"id_pk": 1, "dt_tax_item": "30000", "dt_tax_item_ofr_list": "A1"}
    both = blank | dates | {"id_pk": 2, "dt_tax_item": "42222", "kt_tax_item": "33333", "kt_tax_item_ofr_list": "C"}
    cls = [{"tax_item_ofr": "C", "tax_item_code": "33333", "actual_from": date(1990, 1, 1), "actual_to": None}]
    inputs = frames(spark, [tx], [forced, both], cls)
    for strategy in STRATEGIES:
        rows = classify_by(strategy, *inputs, START, END).collect()
        assert [(r.dt_tax_item_auto, r.kt_tax_item_auto) for r in rows] == [("42222", "33333")]
