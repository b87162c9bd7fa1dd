"""Agreement with a classifier that has many versions of a code."""

import random
from collections import Counter
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from ledgertag.config import DEBIT
from ledgertag.functions.period import Period
from ledgertag.operators import validate
from ledgertag.schemas import CLASSIFIER_SCHEMA
from tests.test_strategies import RULE

PERIOD = Period.parse("2000-01-01", "2020-12-31")


def rule_frame(spark, rows):
    """Rules of (id, item, code, last day)."""
    names = [f.split()[0] for f in RULE.split(", ")]
    base = dict.fromkeys(names, "") | {"start_date": None}
    full = [base | {"id_pk": i, "dt_tax_item": t, "dt_tax_item_ofr_list": c, "end_date": e} for i, t, c, e in rows]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in full], RULE)


def pairs(df):
    return Counter((r.id_pk, r.actual_from, r.actual_to) for r in df.collect())


def plain(rules, classifier):
    found = Counter()
    for i, item, code, last in rules:
        end = min(x for x in (last, PERIOD.end) if x)
        for c, t, lo, hi in classifier:
            if (c, t) == (code, item) and lo and lo <= end and (hi is None or hi >= end):
                found[i, lo, hi] += 1
    return found


@pytest.mark.parametrize("many", [0, 5, 64])
def test_asof_like_the_plain_version(spark, monkeypatch, many):
    monkeypatch.setattr(validate, "MANY_VERSIONS", many)
    rng = random.Random(3)
    classifier = []
    for code in "ABC":
        for _ in range({"A": 90, "B": 5, "C": 1}[code]):
            lo = date(1990, 1, 1) + timedelta(days=rng.randrange(14_000))
            hi = rng.choice([None, lo + timedelta(days=rng.randrange(-2, 3000)), date(9999, 12, 31)])
            classifier.append((code, rng.choice("12"), rng.choice([lo, lo, lo, None]), hi))
    classifier += classifier[:4]  # repeated rows count as often as they come
    rules = [
        (i, rng.choice("12"), rng.choice(["A", "A", "B", "C", "D", "A%", ""]), rng.choice([None, date(1990, 1, 1) + timedelta(days=rng.randrange(14_000))]))
        for i in range(120)
    ]
    entries = spark.createDataFrame(classifier, CLASSIFIER_SCHEMA)
    got = validate.classifier_asof(rule_frame(spark, rules), entries, DEBIT, PERIOD)
    want = plain(rules, classifier)
    assert sum(want.values()) > 100 and pairs(got) == want


def test_a_code_with_very_many_versions(spark):
    """100,000 validity rows of one code and 2,000 rules: what meets is what agrees, not all pairs."""
    n = F.col("id").cast("int")
    first = F.date_add(F.lit("1900-01-01").cast("date"), (n % 40_000).cast("int"))
    entries = spark.range(100_000).select(
        F.lit("A").alias("tax_item_ofr"), F.lit("1").alias("tax_item_code"), first.alias("actual_from"), first.alias("actual_to")
    )
    rules = rule_frame(spark, [(i, "1", "A", date(2001, 1, 1) + timedelta(days=i)) for i in range(2000)])
    joined = validate.classifier_asof(rules, entries, DEBIT, PERIOD)
    assert joined.count() == sum(
        (40_000 * k + (date(2001, 1, 1) + timedelta(days=i) - date(1900, 1, 1)).days) < 100_000 for i in range(2000) for k in range(3)
    )
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    join = next(line for line in plan.splitlines() if "_at_place" in line and "Join" in line)
    assert "_at_level" in join and "_at_place" in join
    valid = validate.validate_side(rules, entries, DEBIT, PERIOD)
    assert valid.count() == 2000


def test_no_classifier(spark):
    entries = spark.createDataFrame([], CLASSIFIER_SCHEMA)
    assert validate.classifier_asof(rule_frame(spark, [(1, "1", "A", None)]), entries, DEBIT, PERIOD).count() == 0
