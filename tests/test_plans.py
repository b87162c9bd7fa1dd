"""The shape of the plans, and what a hot key does to them."""

import contextlib
import io
import re
from datetime import date, datetime

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from ledgertag import classify
from ledgertag.functions.period import Period, dyadic
from ledgertag.operators import lookup
from ledgertag.operators import apply as application
from ledgertag.operators.apply import apply_rules, deal
from ledgertag.operators.compile import compile_rules
from ledgertag.operators.lookup import EVERY, PAIR, filed, finds_whole_values, measure, path_of, refiled, with_path
from ledgertag.operators.resolve import merge_ids, resolve_side
from ledgertag.config import DEBIT, DEFAULT
from tests.test_strategies import END, START, frames, make_data
from workload.queries import Inputs
from workload.strategies import STRATEGIES, classify_by, match_literal


@pytest.fixture(scope="module")
def inputs(spark, tmp_path_factory):
    tx, rules, classifier = frames(spark, *make_data(7, rules=12))
    path = str(tmp_path_factory.mktemp("plans") / "tx")
    tx.withColumn("unused", F.lit("x" * 20)).write.parquet(path)
    return spark.read.parquet(path), rules, classifier


def plan_of(df):
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


def count(plan, operator):
    return len(re.findall(rf"(?m)^\W*(?:\*\(\d+\) )?{operator}\b", plan))


def test_join_plan_has_one_scan_one_exchange_and_one_hash_join(inputs):
    plan = plan_of(classify(*inputs, START, END))
    assert count(plan, "FileScan parquet") == 1
    assert count(plan, "Exchange") == 1
    # One for the keys, and one for the rules whose whole condition needs more than framed texts.
    assert 1 <= count(plan, "BroadcastHashJoin") <= 2
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_filters_and_columns_reach_the_scan(inputs):
    plan = plan_of(classify(*inputs, START, END))
    scan = next(line for line in plan.splitlines() if "FileScan parquet" in line)
    pushed = scan[scan.index("PushedFilters") :]
    assert "GreaterThanOrEqual(operation_date,2021-01-10" in pushed and "LessThan(op" in pushed
    schema = scan[scan.index("ReadSchema") :]
    assert "unused" not in schema


def test_nothing_reads_transactions_before_the_action(spark, inputs):
    """Building the plan must not touch the transactions."""
    _, rules, classifier = inputs
    boom = F.raise_error(F.lit("read too early")).cast("string")
    tx = inputs[0].withColumn("payment_purpose", boom)
    classify(tx, rules, classifier, START, END)


def test_building_runs_few_jobs(spark, inputs):
    """Freezing and measuring the rules; adaptive execution runs each shuffle stage as a job."""
    spark.sparkContext.setJobGroup("building", "")
    try:
        classify(*inputs, START, END)
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("building")
    finally:
        spark.sparkContext.setJobGroup("tests", "")
    assert 0 < len(jobs) <= 12


def plain_rules(spark, n, codes=None, purposes=None, dates=None):
    """Rules with the given expressions of ``id`` for code and purpose lists and dates."""
    i, blank = F.col("id"), F.lit("")
    lo, hi = dates or (F.lit(None).cast("date"), F.lit(None).cast("date"))
    return spark.range(n).select(
        i.alias("id_pk"),
        F.lit("30000").alias("dt_tax_item"),
        blank.alias("kt_tax_item"),
        (codes if codes is not None else blank).alias("dt_tax_item_ofr_list"),
        *[blank.alias(c) for c in ("kt_tax_item_ofr_list", "account_mask_rule", "dt_account_mask_list", "kt_account_mask_list")],
        F.lit("INCLUDE").alias("payment_purpose_rule"),
        (purposes if purposes is not None else blank).alias("payment_purpose_pattern_list"),
        lo.alias("start_date"),
        hi.alias("end_date"),
    )


def plain_transactions(spark, n, code, purpose="pay x", at="2021-02-01 10:00:00"):
    return spark.range(0, n, 1, 6).select(
        F.col("id").cast("string").alias("id_pk"),
        F.lit("2021-02-01").cast("date").alias("input_dt"),
        F.lit(at).cast("timestamp").alias("operation_date"),
        F.lit("70601").alias("dt_account"),
        F.lit("70602").alias("kt_account"),
        code.alias("dt_tax_item_ofr"),
        F.lit("C").alias("kt_tax_item_ofr"),
        F.lit(purpose).alias("payment_purpose"),
    )


def test_conditions_on_rules_are_not_tested_on_every_part(spark, tmp_path):
    """Rules are grouped from parts, and their conditions stay above the grouping."""
    i = F.col("id")
    parts = spark.range(40).select(
        i.alias("p_partkey"),
        F.lit("PROMO").alias("p_type"),
        F.concat(F.lit("Brand#"), i % 4).alias("p_brand"),
        F.lit("blue part").alias("p_name"),
    )
    parts.write.parquet(f"{tmp_path}/part.parquet")
    found = Inputs(spark, str(tmp_path))
    chosen = with_path(found.compiled).filter(finds_whole_values(F.col("path")))
    plan = plan_of(chosen)
    assert "part.parquet" not in plan and "Aggregate" not in plan
    # Three templates of whole codes, and one rule per pair.
    assert {r.rid for r in chosen.select("rid").collect()} == {21, 22, 32, 1000, 1001, 1002, 1003}


def test_a_hot_key_beyond_the_limit_is_salted_in_proportion(spark):
    """A third of all rows have one key; no task gets much more than the others, and cold rules come once."""
    compiled = compile_rules(plain_rules(spark, 4000, F.concat(F.lit("c"), F.col("id"))), Period(START, END))
    n = F.col("id")
    tx = plain_transactions(spark, 60_000, F.when(n % 3 == 0, "c7").otherwise(F.concat(F.lit("c"), n % 4000)))
    rules = lookup.filed(compiled)
    found = measure(rules)
    tasks = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        joined = apply_rules(tx, compiled, broadcast_bytes=1)
        plan = plan_of(joined)
        assert count(plan, "ShuffledHashJoin") == 1 and count(plan, "SortMergeJoin") == 0
        dealt, spread = deal(tx, rules, found, 1)
        copies = [r["count"] for r in spread.groupBy("key").count().filter("count > 1").collect()]
        assert len(copies) == 1 and 40 <= copies[0] <= 60 and spread.count() == 3999 + copies[0]
        placed = dealt.repartition(40, "_path", "_slot", "_key", "_salt").groupBy(F.spark_partition_id()).count()
        sizes = sorted(r["count"] for r in placed.collect())
        assert len(sizes) == 40 and sizes[-1] <= 3 * sizes[20]
        assert joined.count() == 60_000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", tasks)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_rules_without_a_key_beyond_the_limit_are_dealt_to_blocks(spark):
    """Every transaction meets every block once, in one join of one scan; nothing that grows is broadcast."""
    masks = F.concat(F.lit("%"), F.col("id") % 7, F.lit("%"))
    compiled = compile_rules(plain_rules(spark, 500, purposes=masks), Period(START, END))
    tx = plain_transactions(spark, 2000, F.lit("c"), "pay 1 and 2")
    rules = lookup.filed(compiled)
    found = measure(rules)
    assert found.paths == [EVERY] and not found.crowded
    limit = found.every_bytes // 3
    dealt, spread = deal(tx, rules, found, limit)
    blocks = dealt.select("_slot").distinct().count()
    assert blocks >= 16 and dealt.count() == 2000 * blocks
    per_task = spread.withColumn("bytes", lookup.row_bytes(rules.select(*[c for c in rules.columns if c in spread.columns]).schema))
    per_task = per_task.repartition(8, "path", "slot", "key", "salt").groupBy(F.spark_partition_id()).agg(F.sum("bytes")).collect()
    assert max(r[1] for r in per_task) <= limit
    joined = apply_rules(tx, compiled, broadcast_bytes=limit)
    assert joined.count() == 2000 * sum(n % 7 in (1, 2) for n in range(500))


def candidates_of(spark, rules, purpose, day):
    """Pairs of one transaction and filed rules that share a key."""
    found = measure(rules)
    tx = plain_transactions(spark, 1, F.lit("c"), purpose, f"{day} 10:00:00")
    probe = application._probe(tx, found.paths, DEFAULT)
    on = (F.col("_path") == F.col("path")) & (F.col("_key") == F.col("key")) & (F.col("_slot") == F.col("slot"))
    return probe.join(rules, on).count()


def test_candidates_among_many_rules_for_inner_texts(spark):
    """Rules that fix no end of a value are found by the rarest characters of their texts."""
    texts = F.concat(F.lit("%contract no "), F.format_string("%06d", F.col("id")), F.lit("%"))
    compiled = compile_rules(plain_rules(spark, 20_000, purposes=texts), Period(START, END))
    first = filed(compiled)
    assert measure(first).crowded and measure(first).paths == [EVERY]
    rules = refiled(first).cache()
    assert rules.filter(F.col("path") == EVERY).isEmpty() and rules.count() == 20_000
    assert candidates_of(spark, rules, "payment under contract no 004242, second part", "2021-02-01") <= 12
    tx = plain_transactions(spark, 3, F.lit("c"), "payment under contract no 004242, contract no 004243")
    assert sorted({r.rid for r in apply_rules(tx, compiled).collect()}) == [4242, 4243]
    assert apply_rules(tx, compiled).count() == 6
    rules.unpersist()


def test_candidates_among_many_versions_of_a_rule(spark):
    """Ten thousand versions, each valid for a month, meet a day by its dyadic intervals."""
    first = F.add_months(F.lit("1200-01-01").cast("date"), F.col("id").cast("int"))
    versions = plain_rules(spark, 10_000, F.lit("c"), dates=(first, F.last_day(first)))
    period = Period(date(1200, 1, 1), date(2030, 1, 1))
    rules = refiled(filed(compile_rules(versions, period))).cache()
    assert rules.count() <= 10_000 * 10
    assert rules.groupBy("uid").count().filter("count > 10").isEmpty()
    assert measure(filed(compile_rules(versions, period))).crowded
    assert candidates_of(spark, rules, "x", "2021-02-01") == 1
    assert candidates_of(spark, rules, "x", "1900-12-31") == 1
    tx = plain_transactions(spark, 2, F.lit("c"))
    got = apply_rules(tx, compile_rules(versions, period)).collect()
    assert [r.rid for r in got] == [(2021 - 1200) * 12 + 1] * 2
    rules.unpersist()


def test_dyadic_intervals(spark):
    rows = [(5, 4), *((lo, lo + n) for lo in (-40, -3, 0, 5, 8, 1023) for n in (0, 1, 2, 3, 7, 8, 30, 364, 5000))]
    days = [F.date_add(F.lit("1970-01-01").cast("date"), F.col(c)) for c in ("lo", "hi")]
    df = spark.createDataFrame(rows, "lo int, hi int").select("lo", "hi", dyadic(*days).alias("p"))
    for r in df.collect():
        days = [d for p in r.p for d in range(p.place << p.level, (p.place + 1) << p.level)]
        assert sorted(days) == list(range(r.lo, r.hi + 1))
        assert len(r.p) <= 2 * (r.hi - r.lo + 1).bit_length()


def test_the_residual_stays_in_generated_code_that_java_compiles(spark, inputs):
    """No higher-order function in the join, and no method of more than 8,000 bytes."""
    tx, rules, classifier = inputs
    joined = apply_rules(tx, compile_rules(rules, Period(START, END)))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = io.StringIO()
        with contextlib.redirect_stdout(out):
            joined.explain("codegen")
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", out.getvalue())]
    plan = next(part for part in out.getvalue().split("== Subtree") if "Generate" in part and "BroadcastHashJoin" in part)
    assert max(sizes) <= 8000 and "array_contains" in plan


def test_literal_rules_that_differ_in_codes_only_are_one_predicate(spark):
    """No higher-order function, which Spark interprets, and a plan that grows by codes, not by conditions."""

    def listed(rid, dt, kt, purposes=(), dates=(date(2021, 1, 1), date(2021, 3, 31)), include=True):
        lists = {"dt_codes": dt, "kt_codes": kt, "dt_accounts": [], "kt_accounts": [], "purposes": list(purposes)}
        modes = {"account_include": False, "purpose_include": include}
        return Row(rid=rid, dt_item=f"d{rid}", kt_item=None, lo=dates[0], hi=dates[1], **lists, **modes)

    alike = [listed(n, [f"c{n}"], ["C", "B"]) for n in range(60)]
    others = [
        listed(60, ["c1", "c2", "c2"], ["C"]),  # copies, and codes that other rules have
        listed(61, ["c1"], ["C"], purposes=["pay%"]),
        listed(62, ["c1"], ["C"], purposes=["pay%"], include=False),
        listed(63, ["c3"], ["C"], dates=(date(2021, 2, 2), date(2021, 3, 31))),
        listed(64, ["c%"], ["C"]),
        listed(65, ["c4"], []),
        listed(5, ["c5"], ["C"]),
    ]
    rules = alike + others
    code = F.when(F.col("id") < 99, F.concat(F.lit("c"), F.col("id")))
    tx = plain_transactions(spark, 100, code)
    found = match_literal(tx, rules)
    plan = plan_of(found)
    assert "lambda" not in plan and plan.count("CASE WHEN") < 15
    expected = [(str(n), n) for n in range(60)] + [("1", 60), ("2", 60), ("1", 61), ("4", 65), ("5", 5)]
    expected += [(str(n), 64) for n in range(99)]
    assert sorted((r.id_pk, r.rid) for r in found.collect()) == sorted(expected)


def test_candidates_per_transaction_among_many_rules(spark):
    """Masks with a common head or a fixed tail are told apart by their keys."""
    n = F.col("id")
    blank = {c: F.lit("") for c in ("dt_tax_item_ofr_list", "kt_tax_item_ofr_list", "account_mask_rule", "dt_account_mask_list", "kt_account_mask_list")}
    rules = spark.range(20_000).select(
        n.alias("id_pk"),
        F.lit("30000").alias("dt_tax_item"),
        F.lit("").alias("kt_tax_item"),
        *[v.alias(c) for c, v in blank.items()],
        F.lit("INCLUDE").alias("payment_purpose_rule"),
        F.when(n % 2 == 0, F.concat(F.lit("payment under contract "), n.cast("string"), F.lit("-%")))
        .otherwise(F.concat(F.lit("%, ref "), n.cast("string")).substr(F.lit(1), F.lit(60)))
        .alias("payment_purpose_pattern_list"),
        F.lit(None).cast("date").alias("start_date"),
        F.lit(None).cast("date").alias("end_date"),
    )
    rules = rules.withColumn("payment_purpose_pattern_list", F.replace("payment_purpose_pattern_list", F.lit("%, "), F.lit("%")))
    keyed = filed(compile_rules(rules, Period(START, END)))
    per_key = keyed.groupBy("path", "key").count().agg(F.max("count")).head()[0]
    assert per_key <= 12
    assert keyed.filter(F.col("path") == EVERY).isEmpty()
    paths = [r.path for r in keyed.select("path").distinct().collect()]
    one = spark.createDataFrame([("x", "payment under contract 4242-7 and ref 4243")], "a string, payment_purpose string")
    one = one.withColumns({c: F.lit("") for c in ("dt_tax_item_ofr", "kt_tax_item_ofr", "dt_account", "kt_account")})
    probe = one.select(F.inline(lookup.probes(paths, F.lit(START))))
    assert probe.join(keyed, ["path", "key"]).count() <= 24


def test_paths(spark):
    blank = dict.fromkeys(
        ("dt_tax_item_ofr_list", "kt_tax_item_ofr_list", "account_mask_rule",
         "dt_account_mask_list", "kt_account_mask_list", "payment_purpose_rule",
         "payment_purpose_pattern_list"), ""
    ) | {"dt_tax_item": "1", "kt_tax_item": "", "start_date": None, "end_date": None}
    cases = [
        ({"dt_tax_item_ofr_list": "A, B"}, path_of(0, 0), ["A", "B"]),
        ({"kt_tax_item_ofr_list": "A, A"}, path_of(1, 0), ["A"]),
        ({"dt_tax_item_ofr_list": "A", "kt_tax_item_ofr_list": "B, CD"}, PAIR, ["1:AB", "1:ACD"]),
        ({"dt_tax_item_ofr_list": "A%", "kt_tax_item_ofr_list": "B"}, path_of(1, 0), ["B"]),
        ({"dt_tax_item_ofr_list": "111%, 11222?"}, path_of(0, 3), ["111", "112"]),
        ({"dt_tax_item_ofr_list": "111%, %2"}, EVERY, [""]),
        ({"dt_account_mask_list": "70601%"}, EVERY, [""]),
        ({"dt_account_mask_list": "70601%", "account_mask_rule": "INCLUDE"}, path_of(2, 5), ["70601"]),
        ({"payment_purpose_pattern_list": "a long text of many words%", "payment_purpose_rule": "INCLUDE"}, path_of(4, 24), ["a long text of many word"]),
        ({"payment_purpose_pattern_list": "x", "payment_purpose_rule": "EXCLUDE"}, EVERY, [""]),
        ({"payment_purpose_pattern_list": "%URGENT, a%LURGENT", "payment_purpose_rule": "INCLUDE"}, path_of(4, 6, True), ["URGENT"]),
        ({"payment_purpose_pattern_list": "%inner%", "payment_purpose_rule": "INCLUDE"}, EVERY, [""]),
    ]
    rules = [blank | change | {"id_pk": n} for n, (change, _, _) in enumerate(cases)]
    _, df, _ = frames(spark, [], rules, [])
    found = with_path(compile_rules(df, Period(START, END))).orderBy("rid").collect()
    assert [(r.path, r["keys"]) for r in found] == [(p, k) for _, p, k in cases]


def test_a_pair_of_transaction_and_rule_meets_once(spark, inputs):
    tx, rules, _ = inputs
    compiled = compile_rules(rules.dropDuplicates(["id_pk"]), Period(START, END))
    numbered = tx.withColumn("n", F.monotonically_increasing_id())
    pairs = apply_rules(numbered, compiled)
    assert pairs.groupBy("n", "rid").count().filter("count > 1").isEmpty()
    assert filed(compiled).groupBy("rid", "path", "key").count().filter(
        "count > 1"
    ).isEmpty()


def test_a_hot_id_is_reduced_before_the_exchange(spark):
    """An id with a third of all rows reaches the exchange as a row per task."""
    rows = spark.range(0, 90_000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("id_pk"),
        F.struct(
            (F.col("id") % 2 + 1).alias("prio"), F.col("id").alias("rid")
        ).alias("dt_best"),
        F.lit(None).cast("struct<prio:bigint,rid:bigint>").alias("kt_best"),
    )
    merged = merge_ids(rows)
    assert [r.dt_best.rid for r in merged.filter("id_pk = 'hot'").collect()] == [0]
    assert merged.count() == 60_001
    plan = plan_of(merged)
    assert plan.index("partial_min") > plan.index("Exchange")


def test_the_window_form_limits_groups_before_the_exchange(spark):
    tagged = spark.createDataFrame(
        [("1", date(2021, 1, 1), datetime(2021, 1, 1), 1, "30000", None)],
        "id_pk string, input_dt date, operation_date timestamp, rid long, "
        "dt_tax_item string, kt_tax_item string",
    )
    plan = plan_of(resolve_side(tagged, DEBIT))
    assert count(plan, "WindowGroupLimit") == 2
    assert count(plan, "Exchange") == 1


def test_hot_ids_and_hot_codes_end_to_end(spark):
    """A third of all rows share one id, and a third one code."""
    _, rules, classifier = make_data(8)
    _, rule_df, cls = frames(spark, [], rules, classifier)
    n = F.col("id")
    tx = spark.range(0, 60_000, 1, 6).select(
        F.when(n % 3 == 0, "hot").otherwise(n.cast("string")).alias("id_pk"),
        F.lit("2021-02-01").cast("date").alias("input_dt"),
        F.lit("2021-02-01 10:00:00").cast("timestamp").alias("operation_date"),
        F.lit("70601").alias("dt_account"),
        F.when(n % 2 == 0, "70602").otherwise("47423").alias("kt_account"),
        F.when(n % 3 == 1, "A1").otherwise("B1").alias("dt_tax_item_ofr"),
        F.when(n % 5 == 0, "C").alias("kt_tax_item_ofr"),
        F.lit("pay x").alias("payment_purpose"),
    )
    results = [
        classify_by(s, tx, rule_df, cls, START, END).drop("created_ts") for s in STRATEGIES
    ]
    assert results[0].count() > 20_000
    for other in results[1:]:
        assert results[0].exceptAll(other).isEmpty()
        assert other.exceptAll(results[0]).isEmpty()
