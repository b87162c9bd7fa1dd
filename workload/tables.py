"""The four relations over the given tables.

Transactions are line items with their order and part. Codes are the part types
(debit) and brands (credit) that occur in ``part``. The classifier and the rules
are issued for these codes: a template stands for the semantics it exercises and
is issued when its code occurs; one further rule is issued per pair of type and
brand.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

START, END = "1996-01-01", "2000-12-31"

_FROM, _TO = "1995-01-01", "2001-12-31"

RULE_COLUMNS = (
    "id_pk",
    "dt_tax_item",
    "kt_tax_item",
    "dt_tax_item_ofr_list",
    "kt_tax_item_ofr_list",
    "account_mask_rule",
    "dt_account_mask_list",
    "kt_account_mask_list",
    "payment_purpose_rule",
    "payment_purpose_pattern_list",
    "start_date",
    "end_date",
)


def _rule(
    rid: int,
    anchor: str,
    dt: str = "",
    kt: str = "",
    codes: tuple[str, str] = ("", ""),
    accounts: tuple[str, str, str] = ("", "", ""),
    purposes: tuple[str, str] = ("", ""),
    dates: tuple[str, str] = (_FROM, _TO),
) -> tuple:
    return (rid, dt, kt, *codes, *accounts, *purposes, *dates, anchor)


_PADDED = "70606810????????????"
_EARLY = ("1996-03-01", "1997-10-31")

# The rule templates, the last field being the code they are issued for.
TEMPLATES = [
    # Two sides, whole codes, and heads, tails and inner texts of purposes.
    _rule(21, "PROMO", "24001", codes=("PROMO", ""), purposes=("INCLUDE", "blue%, red/, x%")),
    _rule(22, "PROMO", kt="30000", codes=("PROMO", ""), purposes=("INCLUDE", "%gizmo%")),
    _rule(23, "LARGE", "50000", purposes=("INCLUDE", "%HIGH, %NOT SPECIFIED")),
    _rule(24, "SMALL", "50000", purposes=("INCLUDE", "%small%ring%")),
    _rule(25, "STANDARD", "26004", "36004", codes=("STANDARD", "Brand#4")),
    # Wildcards in codes, which no classifier row can agree with.
    _rule(26, "SMALL", "30000", codes=("SMALL%", ""), purposes=("INCLUDE", "%")),
    _rule(27, "LARGE", "24001", codes=("LARG?", "")),
    _rule(28, "SMALL", kt="30000", codes=("", "Brand#1%, Brand#2?")),
    # Excluding lists, alone and beside others.
    _rule(29, "MEDIUM", "30000", purposes=("EXCLUDE", "%URGENT, hot%, cold%")),
    _rule(30, "PROMO", kt="50000", accounts=("EXCLUDE", _PADDED, "%7")),
    _rule(31, "LARGE", "27002", codes=("LARGE", ""), purposes=("EXCLUDE", "%5-LOW")),
    # Accounts that must match.
    _rule(32, "Brand#3", kt="50000", codes=("", "Brand#3"), accounts=("INCLUDE", "", "70601%")),
    _rule(33, "STANDARD", "30000", accounts=("INCLUDE", _PADDED + ", %42", "")),
    # Dates, a twin, a rule without conditions and one that is never in force.
    _rule(34, "LARGE", "27002", codes=("LARGE", ""), purposes=("INCLUDE", "%2-HIGH"), dates=_EARLY),
    _rule(35, "LARGE", "27002", codes=("LARGE", ""), purposes=("INCLUDE", "%2-HIGH"), dates=_EARLY),
    _rule(36, "MEDIUM", "28005", codes=("MEDIUM", ""), purposes=("INCLUDE", "%")),
    _rule(37, "MEDIUM", "30000"),
    _rule(38, "PROMO", "30000", codes=("PROMO", ""), dates=("2031-01-01", "9999-12-31")),
    _rule(39, "SMALL", "30000", purposes=("INCLUDE", "small%"), dates=("1900-01-01", "9999-12-31")),
]

# Items of single codes, with the dates on which they hold.
CODE_ITEMS = [
    ("PROMO", "24001", "1991-01-01", None),
    ("LARGE", "27002", "1991-01-01", "2031-01-01"),
    ("LARGE", "24001", "1991-01-01", None),
    ("SMALL", "25003", "1991-01-01", None),
    ("STANDARD", "26004", "1991-01-01", None),
    ("Brand#4", "36004", "1991-01-01", None),
    ("MEDIUM", "28005", "1991-01-01", "1996-09-30"),
]

# Ids of the rules per group of parts start here.
GROUP_RULES = 1000

PER_PAIR = ("p_type", "p_brand")
PER_WORD = (*PER_PAIR, "word")


def values(rows: list[tuple], columns: tuple[str, ...], alias: str) -> str:
    """Rows as a SQL VALUES list, for Spark and for the oracle."""

    def literal(v) -> str:
        if v is None:
            return "NULL"
        return str(v) if isinstance(v, int) else "'" + v.replace("'", "''") + "'"

    listed = ", ".join(f"({', '.join(map(literal, r))})" for r in rows)
    return f"(VALUES {listed}) AS {alias}({', '.join(columns)})"


TEMPLATE_VALUES = values(TEMPLATES, (*RULE_COLUMNS, "anchor"), "templates")
CODE_ITEM_VALUES = values(
    CODE_ITEMS, ("code", "item", "valid_from", "valid_to"), "code_items"
)


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = load(spark, sf_dir, "lineitem")
    orders = load(spark, sf_dir, "orders")
    parts = load(spark, sf_dir, "part")
    debit = F.col("l_returnflag") == "R"
    credit = F.col("l_linestatus") == "O"

    def account(own: str, is_own, key: str):
        return F.concat(
            F.when(is_own, own).otherwise("40802"),
            F.lit("810"),
            F.lpad(F.col(key).cast("string"), 12, "0"),
        )

    return (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.concat("l_orderkey", F.lit("-"), "l_linenumber").alias("id_pk"),
            F.to_date("o_orderdate").alias("input_dt"),
            F.col("l_shipdate").alias("operation_date"),
            account("70606", debit, "l_partkey").alias("dt_account"),
            account("70601", credit, "l_suppkey").alias("kt_account"),
            F.when(debit, F.col("p_type")).alias("dt_tax_item_ofr"),
            F.when(credit, F.col("p_brand")).alias("kt_tax_item_ofr"),
            F.concat("p_name", F.lit(" "), "o_orderpriority").alias("payment_purpose"),
            F.col("l_extendedprice").cast("decimal(38,10)").alias("amount"),
        )
    )


def codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every code that occurs, once."""
    parts = load(spark, sf_dir, "part")
    return (
        parts.select(F.explode(F.array("p_type", "p_brand")).alias("code"))
        .filter(F.col("code").isNotNull())
        .distinct()
    )


def classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = codes(spark, sf_dir)
    items = spark.sql(f"SELECT * FROM {CODE_ITEM_VALUES}")
    single = known.join(items, "code").select(
        F.col("code").alias("tax_item_ofr"),
        F.col("item").alias("tax_item_code"),
        F.col("valid_from").cast("date").alias("actual_from"),
        F.col("valid_to").cast("date").alias("actual_to"),
    )
    brands = known.filter(F.col("code").startswith("Brand#")).select(
        F.col("code").alias("tax_item_ofr"),
        _brand_item("code").alias("tax_item_code"),
        F.lit("1990-01-01").cast("date").alias("actual_from"),
        F.lit(None).cast("date").alias("actual_to"),
    )
    return single.unionByName(brands)


def rules(spark: SparkSession, sf_dir: str, per: tuple[str, ...] = PER_PAIR) -> DataFrame:
    """Templates whose code occurs, and one rule per distinct ``per`` of parts.

    ``per`` is empty (templates only), type and brand, or these and ``word``, the
    first word of the part's name.
    """
    templates = spark.sql(f"SELECT * FROM {TEMPLATE_VALUES}")
    issued = templates.join(
        codes(spark, sf_dir), F.col("anchor") == F.col("code"), "left_semi"
    ).select(
        F.col("id_pk").cast("long").alias("id_pk"),
        *RULE_COLUMNS[1:-2],
        F.col("start_date").cast("date").alias("start_date"),
        F.col("end_date").cast("date").alias("end_date"),
    )
    if not per:
        return issued
    blank = F.lit("")
    by_word = "word" in per
    per_group = (
        load(spark, sf_dir, "part")
        .withColumn("word", F.split_part("p_name", F.lit(" "), F.lit(1)))
        .groupBy(*per)
        .agg(F.min("p_partkey").alias("first_part"))
        .select(
            (F.col("first_part") + GROUP_RULES).alias("id_pk"),
            F.concat(
                F.lit("25"), F.lpad(F.length("p_type").cast("string"), 3, "0")
            ).alias("dt_tax_item"),
            _brand_item("p_brand").alias("kt_tax_item"),
            F.col("p_type").alias("dt_tax_item_ofr_list"),
            F.col("p_brand").alias("kt_tax_item_ofr_list"),
            *[blank.alias(c) for c in RULE_COLUMNS[5:8]],
            (F.lit("INCLUDE") if by_word else blank).alias(RULE_COLUMNS[8]),
            (F.concat("word", F.lit("%")) if by_word else blank).alias(RULE_COLUMNS[9]),
            F.lit(_FROM).cast("date").alias("start_date"),
            F.lit(_TO).cast("date").alias("end_date"),
        )
    )
    return issued.unionByName(per_group)


def _brand_item(column: str):
    number = F.replace(F.col(column), F.lit("Brand#"), F.lit(""))
    return F.concat(F.lit("6"), F.lpad(number, 4, "0"))
