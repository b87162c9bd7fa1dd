"""Rule application: which transaction meets which rule.

The result has one row per pair: all transaction columns, the rule's id and the
items it would assign. Rules stay a relation whatever their number: a hash join on lookup keys finds
the candidates, the full condition is the residual, and the transactions are
scanned once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgertag.config import DEFAULT, Layout
from ledgertag.functions.masks import framed
from ledgertag.functions.period import day, within_days
from ledgertag.functions.predicates import LIST_SLOTS, plain_condition, rule_condition
from ledgertag.operators.compile import MASK_LISTS
from ledgertag.operators.lookup import EVERY, RuleSet, filed, is_gram, measure, probes, refiled
from ledgertag.operators.settle import settle

# Rules up to this many bytes are broadcast in one go.
BROADCAST_BYTES = 64 * 1024 * 1024
# Beyond it, keys with more than this part of a task's even share of transactions are spread over several tasks.
SHARE = 4

RULE_COLUMNS = ("rid", "dt_item", "kt_item")
_INCLUDES = ("account_include", "purpose_include")


def apply_rules(
    tx: DataFrame,
    compiled: DataFrame,
    layout: Layout = DEFAULT,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Pairs of transactions and compiled rules that match.

    Building the plan runs two actions over the rules: they are filed and frozen, and what was
    frozen is measured. Where too many rules share a key, they are filed anew, which
    runs two more. Rules that are small enough are broadcast together. Else all rules meet the transactions in one
    shuffle join on key and salt; keys of many transactions have salts in proportion, and the rules that every
    transaction must be checked against are dealt out to blocks that fit.
    """
    rules = settle(filed(compiled))
    found = measure(rules)
    if found.crowded:
        rules = settle(refiled(rules))
        found = measure(rules)
    if not found.paths:
        return no_matches(tx)
    inside = tx.filter(
        within_days(F.col(layout.posted), day(found.first_day), day(found.last_day))
    )
    if found.keyed_bytes + found.every_bytes <= broadcast_bytes:
        return _together(inside, rules, found, layout)
    return _salted(inside, rules, found, broadcast_bytes, layout)


def _probe(tx: DataFrame, paths: list[int], layout: Layout, blocks: int = 1) -> DataFrame:
    """A row per transaction and key that it looks up."""
    dt, kt = layout.sides
    values = zip(MASK_LISTS, (dt.code, kt.code, dt.account, kt.account, layout.purpose), strict=True)
    texts = {f"_{n}": framed(F.col(c)) for n, c in values}
    dated = tx.withColumns({"_day": F.to_date(F.col(layout.posted))} | texts)
    own = dated.columns
    looked = F.inline(probes(paths, F.col("_day"), blocks, layout))
    if not any(is_gram(p) for p in paths):
        return dated.select(*own, looked.alias("_path", "_slot", "_key")).filter("_key IS NOT NULL")
    spread = dated.select(*own, looked.alias("_path", "_slot", "_key", "_value", "_width"))
    starts = F.char_length("_value") - F.col("_width") + 1
    places = F.when(F.col("_width") == 0, F.array(F.lit(0))).when(starts > 0, F.sequence(F.lit(1), starts))
    placed = spread.select(*own, "_path", "_slot", "_key", "_value", "_width", F.explode(places).alias("_at"))
    key = F.when(F.col("_at") == 0, F.col("_key")).otherwise(F.substring("_value", F.col("_at"), F.col("_width")))
    # Characters that a value has twice are looked up once.
    first = (F.col("_at") == 0) | (F.position("_key", "_value") == F.col("_at"))
    named = placed.withColumn("_key", key).filter(F.col("_key").isNotNull() & first)
    return named.select(*own, "_path", "_slot", "_key")


def _forms() -> list[Column]:
    """The forms as columns without nulls."""
    columns = [F.coalesce(F.col(n), F.lit(True)).alias(n) for n in _INCLUDES]
    for i, name in enumerate(MASK_LISTS):
        form = F.get("forms", F.lit(i))
        none = F.array().cast("array<string>")
        columns.append(F.coalesce(form["whole"], none).alias(f"{name}_whole"))
        for k in range(LIST_SLOTS[name]):
            columns.append(F.coalesce(F.get(form["texts"], F.lit(k)), F.lit("")).alias(f"{name}_text{k}"))
            columns.append(F.coalesce(F.get(form["sizes"], F.lit(k)), F.lit(-1)).alias(f"{name}_size{k}"))
    return columns


def _together(tx: DataFrame, rules: DataFrame, found: RuleSet, layout: Layout) -> DataFrame:
    """All rules broadcast. What plain forms can tell is checked in the join, the rest on the pairs that pass it."""
    keyed = rules.select("uid", "path", "slot", "key", "lo", "hi", "general", *RULE_COLUMNS, *_forms())
    t, r = _probe(tx, found.paths, layout).alias("t"), F.broadcast(keyed).alias("r")
    on = _same_key() & _counts() & plain_condition(_of("t"), _of("r"))
    met = t.join(r, on, "inner")
    if not found.general:
        return met.select(*_columns(tx, "t"), *[F.col(f"r.{c}") for c in RULE_COLUMNS])
    kept = met.select(
        *[F.col(f"t.{c}") for c in (*tx.columns, "_key")],
        *[F.col(f"r.{c}").alias(f"_{c}") for c in RULE_COLUMNS],
        F.when(F.col("r.general"), F.col("r.uid")).alias("_uid"),
    ).alias("t")
    rest = rules.filter("general AND nth = 0").select("uid", *_INCLUDES, "lists", "text_list", "texts")
    checked = kept.join(F.broadcast(rest.alias("g")), F.col("t._uid") == F.col("g.uid"), "left").filter(
        F.col("t._uid").isNull() | _whole(_of("t"), "g", F.col("t._key"), layout)
    )
    return checked.select(*_columns(tx, "t"), *[F.col(f"t._{c}").alias(c) for c in RULE_COLUMNS])


def _salted(
    tx: DataFrame, rules: DataFrame, found: RuleSet, broadcast_bytes: int, layout: Layout
) -> DataFrame:
    """One shuffle join for rules that are too large to be broadcast."""
    dealt, spread = deal(tx, rules, found, broadcast_bytes, layout)
    t, r = dealt.alias("t"), spread.hint("shuffle_hash").alias("r")
    on = _same_key() & (F.col("t._salt") == F.col("r.salt")) & _counts() & plain_condition(_of("t"), _of("r"))
    if found.general:
        on = on & F.when(F.col("r.general"), _whole(_of("t"), "r", F.col("t._key"), layout)).otherwise(F.lit(True))
    return t.join(r, on, "inner").select(*_columns(tx, "t"), *[F.col(f"r.{c}") for c in RULE_COLUMNS])


def deal(
    tx: DataFrame, rules: DataFrame, found: RuleSet, broadcast_bytes: int, layout: Layout = DEFAULT
) -> tuple[DataFrame, DataFrame]:
    """What the transactions look up and the filed rules, both with salts.

    A sketch of the keys that are looked up tells which ones are hot: those with more than a part of a task's even
    share, of which there are fewer than ``SHARE`` times the tasks. Their transactions get salts in proportion and
    their rules a copy per salt; all other rules come once. Rules that every transaction must be checked against are
    dealt out to so many blocks that a task holds about ``SHARE`` of them, half the limit together.
    """
    tasks = int(tx.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    most = SHARE * tasks
    blocks = min(most, max(1, -(-2 * SHARE * found.every_bytes // broadcast_bytes)))
    probe = _probe(tx, found.paths, layout, blocks).withColumn("_name", F.xxhash64("_path", "_slot", "_key"))
    tracked = F.lit(max(1024, min(16 * most, 1_000_000)))
    top = F.call_function("approx_top_k", "_name", F.lit(min(most, 100_000)), tracked)
    sketch = probe.agg(top.alias("top"), F.count(F.lit(1)).alias("total"))
    salts = F.ceil(F.col("count") * most / F.col("total")).cast("int")
    hot = sketch.select("total", F.inline("top")).select(F.col("item").alias("_name"), salts.alias("_salts"))
    hot = F.broadcast(hot.filter("_salts > 1"))
    slot = F.when(F.col("path") == EVERY, F.pmod("uid", F.lit(blocks)).cast("int")).otherwise(F.col("slot"))
    named = rules.withColumn("slot", slot).withColumn("_name", F.xxhash64("path", "slot", "key"))
    copies = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)
    kept = ("path", "slot", "key", "lo", "hi", "general", "lists", "text_list", "texts", *RULE_COLUMNS)
    spread = named.join(hot, "_name", "left").select(*kept, *_forms(), F.explode(copies).alias("salt"))
    salt = F.coalesce(F.pmod(F.xxhash64(*tx.columns), F.col("_salts")).cast("int"), F.lit(0))
    dealt = probe.join(hot, "_name", "left").withColumn("_salt", salt).drop("_name", "_salts")
    return dealt, spread


def _of(alias: str):
    return lambda name: F.col(f"{alias}.{name}")


def _columns(tx: DataFrame, alias: str) -> list[Column]:
    return [F.col(f"{alias}.{c}") for c in tx.columns]


def _same_key() -> Column:
    return (
        (F.col("t._path") == F.col("r.path"))
        & (F.col("t._key") == F.col("r.key"))
        & (F.col("t._slot") == F.col("r.slot"))
    )


def _counts() -> Column:
    return F.col("t._day").between(F.col("r.lo"), F.col("r.hi"))


def _whole(value, alias: str, key: Column, layout: Layout) -> Column:
    """The whole condition of a general rule, and that its other keys don't find the same pair."""
    of = _of(alias)
    lists = {n: F.get(of("lists"), F.lit(i)) for i, n in enumerate(MASK_LISTS)}
    dt, kt = layout.sides
    values = F.array(*[value(c) for c in (dt.code, kt.code, dt.account, kt.account, layout.purpose)])
    text = F.get(values, of("text_list"))
    least = F.array_min(F.filter(of("texts"), lambda x: F.contains(text, x)))
    once = of("texts").isNull() | (least == key)
    return once & rule_condition(value, lambda n: lists.get(n, of(n)), layout)


def no_matches(tx: DataFrame) -> DataFrame:
    return (
        tx.filter(F.lit(False))
        .withColumn("rid", F.lit(None).cast("long"))
        .withColumn("dt_item", F.lit(None).cast("string"))
        .withColumn("kt_item", F.lit(None).cast("string"))
    )
