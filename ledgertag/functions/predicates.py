"""Does a transaction meet a rule? Conditions over a transaction joined with a rule.

All conditions keep SQL's three-valued logic: a null value makes its mask list
null, and negating null is null, so an excluding list drops null values too.
Absent conditions count as true here; rules without any are left out earlier.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgertag.config import DEFAULT, Layout
from ledgertag.functions.masks import any_mask

Field = Callable[[str], Column]

# Masks with wildcards that each list may have and still be checked by the plain condition.
LIST_SLOTS = {"dt_codes": 1, "kt_codes": 1, "dt_accounts": 2, "kt_accounts": 2, "purposes": 3}


def if_present(n: Column, found: Column) -> Column:
    return (n == 0) | found


def include_or_not(condition: Column, include: Column) -> Column:
    return F.when(include, condition).otherwise(~condition)


def rule_condition(value: Field, masks: Field, layout: Layout = DEFAULT) -> Column:
    """The whole condition, over parsed mask lists. Has higher-order functions.

    Excluding accounts negates both sides together, so one side that differs is enough.
    """
    dt, kt = layout.sides

    def found(column: str, name: str) -> Column:
        return if_present(F.size(masks(name)), any_mask(value(column), masks(name)))

    accounts = found(dt.account, "dt_accounts") & found(kt.account, "kt_accounts")
    with_accounts = (F.size(masks("dt_accounts")) > 0) | (F.size(masks("kt_accounts")) > 0)
    purposes = any_mask(value(layout.purpose), masks("purposes"))
    return (
        found(dt.code, "dt_codes")
        & found(kt.code, "kt_codes")
        & F.when(with_accounts, include_or_not(accounts, masks("account_include"))).otherwise(F.lit(True))
        & F.when(F.size(masks("purposes")) > 0, include_or_not(purposes, masks("purpose_include"))).otherwise(F.lit(True))
    )


def plain_condition(value: Field, form: Field) -> Column:
    """What :func:`ledgertag.functions.masks.frames` can tell: true wherever the whole condition is.

    For rules whose lists are all exact it is the whole condition. Neither side has nulls, so that little code is generated: Java
    compiles a method of a join only up to 8,000 bytes. A null value is framed as the empty text, which meets absent
    lists only, and fails no excluding list.
    """

    def hit(name: str) -> Column:
        text = value(f"_{name}")
        found = F.array_contains(form(f"{name}_whole"), text)
        for k in range(LIST_SLOTS[name]):
            size = form(f"{name}_size{k}")
            found = found | (F.contains(text, form(f"{name}_text{k}")) & ((size < 0) | (F.char_length(text) == size + 2)))
        return found

    def fails(name: str, include: Column) -> Column:
        return ~hit(name) & (include | (value(f"_{name}") != ""))

    accounts, purposes = form("account_include"), form("purpose_include")
    return (
        hit("dt_codes")
        & hit("kt_codes")
        & (fails("purposes", purposes) != purposes)
        & ((fails("dt_accounts", accounts) | fails("kt_accounts", accounts)) != accounts)
    )
