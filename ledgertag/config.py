"""Names and parameters shared by all operators.

Everything that ties the operators to one table layout is here, so the same
operators run on any two-sided transaction table: pass another ``Layout``.
"""

from __future__ import annotations

from dataclasses import dataclass

# The column names, marks and codes that rule tables and results use.


@dataclass(frozen=True)
class Side:
    """One side of a transaction, with the rule columns that describe it."""

    name: str
    account: str
    code: str
    item: str
    code_list: str
    account_list: str
    result: str


DEBIT = Side(
    name="dt",
    account="dt_account",
    code="dt_tax_item_ofr",
    item="dt_tax_item",
    code_list="dt_tax_item_ofr_list",
    account_list="dt_account_mask_list",
    result="dt_tax_item_auto",
)

CREDIT = Side(
    name="kt",
    account="kt_account",
    code="kt_tax_item_ofr",
    item="kt_tax_item",
    code_list="kt_tax_item_ofr_list",
    account_list="kt_account_mask_list",
    result="kt_tax_item_auto",
)


@dataclass(frozen=True)
class Layout:
    """Column names of the four relations plus the business parameters."""

    debit: Side = DEBIT
    credit: Side = CREDIT

    # transactions
    key: str = "id_pk"
    posted: str = "operation_date"
    loaded: str = "input_dt"
    purpose: str = "payment_purpose"

    # rules
    rule_key: str = "id_pk"
    account_mode: str = "account_mask_rule"
    purpose_mode: str = "payment_purpose_rule"
    purpose_list: str = "payment_purpose_pattern_list"
    rule_start: str = "start_date"
    rule_end: str = "end_date"

    # classifier
    cls_code: str = "tax_item_ofr"
    cls_item: str = "tax_item_code"
    cls_from: str = "actual_from"
    cls_to: str = "actual_to"

    # result
    created: str = "created_ts"

    # business parameters
    include: str = "INCLUDE"
    forced_items: tuple[str, ...] = ("30000", "50000")
    taggable: str = "7%"

    @property
    def sides(self) -> tuple[Side, Side]:
        return (self.debit, self.credit)

    def other(self, side: Side) -> Side:
        return self.credit if side.name == self.debit.name else self.debit


DEFAULT = Layout()
