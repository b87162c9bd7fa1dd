"""Lookup keys for rules, so that a transaction meets few rules, not all.

Every rule has at most one *path*: a transaction column of which the rule fixes
the whole value, the first or the last characters, or both code columns together. The rule
then only needs to be checked on transactions that agree on that key. Rules for
which no mask list fixes anything (inner texts, excluding lists only) are put under one key that every
transaction has.

How many characters a key has follows from the rules: as many as all masks of the
list fix, rounded down by a ninth at most, so that the number of paths grows with the
logarithm of the longest mask. A rule appears once per distinct key of its path, and a transaction has exactly
one key per path, so a pair of transaction and rule meets at most once.

Where that leaves too many rules under one key they are filed anew (:func:`refiled`): rules for inner texts under
the rarest characters of each text, and rules that count at different times under the days on which they do.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgertag.config import DEFAULT, Layout
from ledgertag.functions.masks import frames, parse_masks
from ledgertag.functions.period import dyadic, interval_of
from ledgertag.functions.predicates import LIST_SLOTS
from ledgertag.operators.compile import CODE_LISTS, MASK_LISTS

# Keys have at most so many characters.
WIDEST = 4096
# Paths are numbered _STEP * (2 * list + from the end) + width; width 0 stands for whole values.
_STEP = 100_000
# Both codes as whole values.
PAIR = 2 * len(MASK_LISTS) * _STEP
EVERY = PAIR + 1
# Paths of characters at any place are numbered _GRAMS + _PER_LIST * list + width.
_GRAMS, _PER_LIST = 2 * PAIR, 100
# Paths by days are numbered _DATED * (level + 1) + the path without days.
_DATED = 4 * PAIR
# A rule with more combinations of codes than this is found by the codes of one side,
# so that a rule has no more keys than codes or this number.
MOST_PAIRS = 64

# So many characters of an inner text make a key: as many as the shortest text allows.
GRAM_WIDTHS = (12, 8, 5, 3)
# Values have about as many keys of that kind, which is what looking them up costs. With fewer rules that
# have no other key, checking each is cheaper.
CROWD = 64

# Cells in which the size of the rules is measured.
CELLS = 256


def path_of(i: int, width: int, ending: bool = False) -> int:
    return _STEP * (2 * i + ending) + width


def gram_path(i: int, width: int) -> int:
    return _GRAMS + _PER_LIST * i + width


def dated(path: int | Column, level: int | Column) -> int | Column:
    return _DATED * (level + 1) + path


def undated(path: int) -> tuple[int, int]:
    """The path without days, and its level (-1 for none)."""
    level, base = divmod(path, _DATED)
    return base, level - 1


def is_gram(path: int) -> bool:
    return undated(path)[0] >= _GRAMS


def _masked_columns(layout: Layout) -> tuple[str, ...]:
    dt, kt = layout.sides
    return (dt.code, kt.code, dt.account, kt.account, layout.purpose)


def _parsed(compiled: DataFrame) -> DataFrame:
    """Compiled rules with their parsed lists as one array, and which of them a value must meet."""
    lists = F.transform(F.array(*[F.col(n) for n in MASK_LISTS]), parse_masks)
    # Lists that aren't there exclude nothing.
    account = F.col("account_include") | (F.size("dt_accounts") + F.size("kt_accounts") == 0)
    purpose = F.col("purpose_include") | (F.size("purposes") == 0)
    required = F.array(F.lit(True), F.lit(True), account, account, purpose)
    included = {"account_include": account, "purpose_include": purpose}
    return compiled.withColumns({"_lists": lists, "_required": required} | included)


def _best_path(parsed: DataFrame) -> DataFrame:
    """Parsed rules plus ``path``, the array of their ``keys``, and what :func:`refiled` needs."""

    def options(masks: Column, i: Column) -> Column:
        usable = F.get("_required", i) & (F.size(masks) > 0)
        whole = F.forall(masks, lambda m: m["literal"])

        def option(ending: bool) -> Column:
            part = "tail" if ending else "head"
            fixed = F.array_min(F.transform(masks, lambda m: F.char_length(m[part])))
            width = F.when(whole, 0).otherwise(_rounded(F.least(fixed, F.lit(WIDEST))))
            score = F.when(whole, WIDEST + 1).otherwise(width)

            def key(m: Column) -> Column:
                cut = F.right(m["mask"], width) if ending else F.substring(m["mask"], F.lit(1), width)
                return F.when(whole, m["mask"]).otherwise(cut)

            return F.when(
                usable & (score > 0) & ~(whole & F.lit(ending)),
                F.struct(
                    score.alias("score"),
                    (-2 * i - int(ending)).alias("turn"),
                    (_STEP * (2 * i + int(ending)) + width).alias("path"),
                    F.array_distinct(F.transform(masks, key)).alias("keys"),
                ),
            )

        return F.array(option(False), option(True))

    def text(masks: Column, i: Column) -> Column:
        runs = F.transform(masks, lambda m: m["run"])
        shortest = F.array_min(F.transform(runs, F.char_length))
        width = F.lit(None).cast("int")
        for w in reversed(GRAM_WIDTHS):
            width = F.when(shortest >= w, w).otherwise(width)
        return F.when(
            F.get("_required", i) & width.isNotNull(),
            F.struct(width.alias("width"), (-i).alias("turn"), i.alias("list"), F.array_distinct(runs).alias("runs")),
        )

    none = F.struct(
        F.lit(0).alias("score"),
        F.lit(0).alias("turn"),
        F.lit(EVERY).alias("path"),
        F.array(F.lit("")).alias("keys"),
    )
    found = F.concat(F.array(none, _pair_option()), F.flatten(F.transform("_lists", options)))
    best = parsed.withColumns(
        {"_best": F.array_max(F.array_compact(found)), "_text": F.array_max(F.array_compact(F.transform("_lists", text)))}
    )
    return best.withColumns({"path": F.col("_best.path"), "keys": F.col("_best.keys")}).drop("_best")


def with_path(compiled: DataFrame) -> DataFrame:
    """Compiled rules plus ``path`` and the array of their ``keys``."""
    found = _best_path(_parsed(compiled.withColumn("_modes", F.struct("account_include", "purpose_include"))))
    return found.withColumns({n: F.col(f"_modes.{n}") for n in ("account_include", "purpose_include")}).select(
        *compiled.columns, "path", "keys"
    )


def _rounded(width: Column) -> Column:
    """A width without its binary digits beyond the first four: eight widths to each doubling."""
    beyond = F.greatest(F.lit(0), F.length(F.bin(width)) - 4)
    return F.call_function("shiftleft", F.call_function("shiftright", width, beyond), beyond)


def _pair_option() -> Column:
    dt, kt = F.get("_lists", F.lit(0)), F.get("_lists", F.lit(1))
    count = F.size(dt) * F.size(kt)
    keys = F.flatten(F.transform(dt, lambda d: F.transform(kt, lambda k: _pair(d["mask"], k["mask"]))))
    return F.when(
        count.between(1, MOST_PAIRS)
        & F.forall(dt, lambda m: m["literal"])
        & F.forall(kt, lambda m: m["literal"]),
        F.struct(
            F.lit(WIDEST + 2).alias("score"),
            F.lit(0).alias("turn"),
            F.lit(PAIR).alias("path"),
            F.array_distinct(keys).alias("keys"),
        ),
    )


def _pair(dt: Column, kt: Column) -> Column:
    # The length in front keeps two pairs from giving the same text.
    return F.concat(F.length(dt).cast("string"), F.lit(":"), dt, kt)


def filed(compiled: DataFrame) -> DataFrame:
    """One row per rule and key, in the form that is joined.

    ``uid`` numbers the rules, ``nth`` the keys of one. ``forms`` has the lists in the form that needs no
    higher-order function; rules that such forms can't decide are ``general`` and keep ``lists``. A list of whole
    values that serves as the path is met by the key itself, so it isn't carried along. ``slot`` is the place
    of a path by days. ``texts`` are the keys of a rule of which a transaction may have several: the
    least of them counts.
    """
    numbered = _best_path(_parsed(compiled)).withColumn("uid", F.monotonically_increasing_id())
    n_codes = len(CODE_LISTS)

    def left(masks: Column, i: Column) -> Column:
        met = (F.col("path") == 2 * _STEP * i) | ((F.col("path") == PAIR) & (i < n_codes))
        return F.when(met, F.slice(masks, 1, 0)).otherwise(masks)

    trimmed = numbered.withColumn("_lists", F.transform("_lists", left))
    slots = F.array(*[F.lit(LIST_SLOTS[n]) for n in MASK_LISTS])
    shaped = trimmed.withColumn(
        "forms", F.transform("_lists", lambda masks, i: frames(masks, F.get("_required", i), F.get(slots, i)))
    )
    general = F.exists("forms", lambda f: ~f["exact"])
    text = F.when(F.col("path") == EVERY, F.col("_text"))
    none = F.lit(None)
    return (
        shaped.withColumn("general", general)
        .select(
            "uid",
            *[c for c in compiled.columns if c not in MASK_LISTS],
            "path",
            F.lit(0).alias("slot"),
            F.posexplode("keys").alias("nth", "key"),
            "forms",
            "general",
            F.when(F.col("general") | (F.size(text["runs"]) > 1), F.col("_lists")).alias("lists"),
            text.alias("text"),
            none.cast("int").alias("text_list"),
            none.cast("array<string>").alias("texts"),
        )
    )


def refiled(rules: DataFrame) -> DataFrame:
    """Filed rules, with other keys where too many rules share one.

    Rules without a key whose masks all hold some text are filed, per mask, under the rarest piece of its longest
    text: the one that the fewest such rules have. Where more than ``CROWD`` rules share a key and
    count, on average, on less than a quarter of its days, each is filed under the dyadic intervals
    that make up its days, two per level at most; a day lies in one interval of a level.
    """
    return _by_days(_by_texts(rules))


def _by_texts(rules: DataFrame) -> DataFrame:
    able = (F.col("path") == EVERY) & F.col("text").isNotNull()
    texts = rules.filter(able).select("uid", "text.list", "text.width", F.posexplode("text.runs").alias("j", "run"))
    starts = F.sequence(F.lit(1), F.char_length("run") - F.col("width") + 1)
    grams = texts.select("uid", "list", "width", "j", "run", F.explode(starts).alias("at")).select(
        "uid", "list", "width", "j", F.substring("run", F.col("at"), F.col("width")).alias("gram")
    )
    held = grams.groupBy("list", "width", "gram").agg(F.count_distinct("uid").alias("n"))
    rarest = grams.join(held, ["list", "width", "gram"]).groupBy("uid", "j").agg(F.min(F.struct("n", "gram"))["gram"].alias("gram"))
    keys = rarest.groupBy("uid").agg(F.array_sort(F.collect_set("gram")).alias("_grams"))
    several = F.size("_grams") > 1
    placed = rules.filter(able).join(keys, "uid")
    moved = {
        "path": _GRAMS + _PER_LIST * F.col("text.list") + F.col("text.width"),
        "text_list": F.col("text.list"),
        "texts": F.when(several, F.col("_grams")),
        "general": F.col("general") | several,
        "text": F.lit(None).cast(rules.schema["text"].dataType),
    }
    placed = placed.withColumns(moved).drop("nth", "key")
    placed = placed.select("*", F.posexplode("_grams").alias("nth", "key")).select(*rules.columns)
    return rules.filter(~able).unionByName(placed)


def _crowded() -> Column:
    """Of the rules of one key: whether days would tell them apart."""
    span = F.datediff(F.max("hi"), F.min("lo")) + 1
    days = F.sum(F.datediff("hi", "lo") + 1)
    count = F.count(F.lit(1))
    return (count > CROWD) & (4 * days < count * span)


def _by_days(rules: DataFrame) -> DataFrame:
    crowded = rules.groupBy("path", "key").agg(_crowded().alias("_crowded")).filter("_crowded")
    placed = rules.join(crowded, ["path", "key"], "left")
    pieces = F.when(F.col("_crowded"), dyadic(F.col("lo"), F.col("hi"))).otherwise(
        F.array(F.struct(F.lit(-1).alias("level"), F.col("slot").alias("place")))
    )
    other = [c for c in rules.columns if c not in ("path", "slot", "nth")]
    spread = placed.select(*other, "path", "nth", F.posexplode(pieces).alias("_n", "_piece"))
    return spread.select(
        *other,
        F.when(F.col("_piece.level") < 0, F.col("path")).otherwise(dated(F.col("path"), F.col("_piece.level"))).alias("path"),
        F.col("_piece.place").alias("slot"),
        (F.col("nth") + F.col("_n")).alias("nth"),
    ).select(*rules.columns)


def probes(paths: list[int], day: Column, blocks: int = 1, layout: Layout = DEFAULT) -> Column:
    """What one transaction looks up: ``array<struct<path, slot, key, value, width>>``.

    On a path of characters at any place the key is null, and all of ``width`` characters of ``value`` are keys. Rules that every
    transaction must be checked against are in so many ``blocks``.
    """
    columns = _masked_columns(layout)

    def key(base: int) -> Column:
        if base == EVERY:
            return F.lit("")
        if base == PAIR:
            return _pair(F.col(layout.debit.code), F.col(layout.credit.code))
        if base >= _GRAMS:
            return F.lit(None).cast("string")
        place, width = divmod(base, _STEP)
        i, ending = divmod(place, 2)
        value = F.col(columns[i])
        if not width:
            return value
        return F.right(value, F.lit(width)) if ending else F.substring(value, 1, width)

    with_texts = any(is_gram(p) for p in paths)
    found = []
    for path in sorted(paths):
        base, level = undated(path)
        slots = [F.lit(b) for b in range(blocks if path == EVERY else 1)]
        if level >= 0:
            slots = [interval_of(day, level)]
        texts = []
        if with_texts:
            i, width = divmod(base - _GRAMS, _PER_LIST) if base >= _GRAMS else (0, 0)
            value = F.col(columns[i]) if width else F.lit(None).cast("string")
            texts = [value.alias("value"), F.lit(width).alias("width")]
        found += [F.struct(F.lit(path).alias("path"), s.alias("slot"), key(base).alias("key"), *texts) for s in slots]
    return F.array(*found)


def finds_whole_values(path: Column) -> Column:
    """Is the key of this path met by whole values only?"""
    return path % _STEP == 0


@dataclass
class RuleSet:
    """What one job finds out about the filed rules before they are joined."""

    paths: list[int] = field(default_factory=list)
    first_day: object = None
    last_day: object = None
    keyed_bytes: int = 0
    every_bytes: int = 0
    general: bool = False
    crowded: bool = False


def row_bytes(schema: T.StructType) -> Column:
    """An upper bound of the binary size of one row in Spark's row format.

    A word for each field and for the null bits of each 64; texts and arrays are padded to words, and an array
    has its number in front.
    """

    def more(value: Column, kind: T.DataType) -> Column | None:
        """What a value takes beside its word."""
        if isinstance(kind, T.StringType):
            return 8 + F.coalesce(F.octet_length(value), F.lit(0))
        if isinstance(kind, T.StructType):
            return fields(lambda f: value[f.name], kind)
        if isinstance(kind, T.ArrayType):

            def add(n: Column, x: Column) -> Column:
                extra = more(x, kind.elementType)
                return n + 9 if extra is None else n + 9 + extra

            return 16 + F.coalesce(F.aggregate(value, F.lit(0).cast("long"), add), F.lit(0))
        return None

    def fields(of, kind: T.StructType) -> Column:
        total = F.lit(16 + 8 * len(kind)).cast("long")
        for f in kind:
            extra = more(of(f), f.dataType)
            if extra is not None:
                total = total + extra
        return total

    return fields(lambda f: F.col(f.name), schema)


def measure(rules: DataFrame) -> RuleSet:
    """Paths in use, days covered and bytes: at most ``2 * CELLS`` rows come to the driver."""
    per_key = (
        rules.select("path", "key", "slot", "lo", "hi", "general", F.col("text").isNotNull().alias("able"), row_bytes(rules.schema).alias("bytes"))
        .groupBy("path", "key", "slot")
        .agg(
            F.min("lo").alias("lo"),
            F.max("hi").alias("hi"),
            F.sum("bytes").alias("bytes"),
            F.bool_or("general").alias("general"),
            F.count_if("able").alias("able"),
            (_crowded() & (F.first("path") < _DATED)).alias("crowded"),
        )
    )
    rows = (
        per_key.groupBy((F.col("path") == EVERY).alias("every"), F.pmod(F.xxhash64("key"), F.lit(CELLS)).alias("cell"))
        .agg(
            F.collect_set("path").alias("paths"),
            F.min("lo").alias("lo"),
            F.max("hi").alias("hi"),
            F.sum("bytes").alias("bytes"),
            F.bool_or("general").alias("general"),
            F.max("able").alias("able"),
            F.bool_or("crowded").alias("crowded"),
        )
        .collect()
    )
    if not rows:
        return RuleSet()
    return RuleSet(
        paths=sorted({p for r in rows for p in r["paths"]}),
        first_day=min(r["lo"] for r in rows),
        last_day=max(r["hi"] for r in rows),
        keyed_bytes=sum(r["bytes"] for r in rows if not r["every"]),
        every_bytes=sum(r["bytes"] for r in rows if r["every"]),
        general=any(r["general"] for r in rows),
        crowded=any(r["crowded"] or r["able"] > CROWD for r in rows),
    )
