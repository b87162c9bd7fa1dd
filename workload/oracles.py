"""The same results in plain SQL over the same tables.

Each text starts with the shared relations and steps and ends in one SELECT.
The SQL is written from the definition of the results, not from the plans: it
pairs rules with distinct codes and checks whole mask lists, without lookup
keys, broadcast or early choice.
"""

from __future__ import annotations

from workload.queries import LOOKED_UP, REGISTRY
from workload.tables import (
    CODE_ITEM_VALUES,
    END,
    GROUP_RULES,
    START,
    TEMPLATE_VALUES,
)

_BRAND_ITEM = "'6' || lpad(replace({c}, 'Brand#', ''), 4, '0')"

_RELATIONS = f"""
tx AS (
  SELECT l_orderkey || '-' || l_linenumber AS id_pk,
    CAST(o_orderdate AS DATE) AS input_dt,
    l_shipdate AS operation_date,
    (CASE l_returnflag WHEN 'R' THEN '70606' ELSE '40802' END)
      || '810' || lpad(CAST(l_partkey AS VARCHAR), 12, '0') AS dt_account,
    (CASE l_linestatus WHEN 'O' THEN '70601' ELSE '40802' END)
      || '810' || lpad(CAST(l_suppkey AS VARCHAR), 12, '0') AS kt_account,
    CASE WHEN l_returnflag = 'R' THEN p_type END AS dt_tax_item_ofr,
    CASE WHEN l_linestatus = 'O' THEN p_brand END AS kt_tax_item_ofr,
    p_name || ' ' || o_orderpriority AS payment_purpose,
    CAST(l_extendedprice AS DECIMAL(38,10)) AS amount
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
                JOIN part ON l_partkey = p_partkey),
codes AS (
  SELECT p_type AS code FROM part WHERE p_type IS NOT NULL
  UNION SELECT p_brand FROM part WHERE p_brand IS NOT NULL),
classifier AS (
  SELECT code AS tax_item_ofr, item AS tax_item_code,
    CAST(valid_from AS DATE) AS actual_from, CAST(valid_to AS DATE) AS actual_to
  FROM codes JOIN {CODE_ITEM_VALUES} USING (code)
  UNION ALL
  SELECT code, {_BRAND_ITEM.format(c="code")}, DATE '1990-01-01', CAST(NULL AS DATE)
  FROM codes WHERE starts_with(code, 'Brand#')),
templates_issued AS (
  SELECT CAST(id_pk AS BIGINT) AS id_pk, dt_tax_item, kt_tax_item,
    dt_tax_item_ofr_list, kt_tax_item_ofr_list, account_mask_rule,
    dt_account_mask_list, kt_account_mask_list, payment_purpose_rule,
    payment_purpose_pattern_list,
    CAST(start_date AS DATE) AS start_date, CAST(end_date AS DATE) AS end_date
  FROM {TEMPLATE_VALUES} WHERE anchor IN (SELECT code FROM codes))"""

_ALL_RULES = f"""
rules AS (
  SELECT * FROM templates_issued
  UNION ALL
  SELECT min(p_partkey) + {GROUP_RULES},
    '25' || lpad(CAST(length(p_type) AS VARCHAR), 3, '0'),
    {_BRAND_ITEM.format(c="p_brand")}, p_type, p_brand, '', '', '', '', '',
    DATE '1995-01-01', DATE '2001-12-31'
  FROM part GROUP BY p_type, p_brand)"""

# chr(1) stands for an escaped comma while a list is split.
_HELD = "regexp_replace(replace(coalesce({c}, ''), '/,', chr(1)), ',+$', '')"
_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _masks(column: str) -> str:
    held = _HELD.format(c=column)
    piece = f"translate(trim(replace(m, chr(1), ','), {_BLANKS}), '?', '_')"
    return (
        f"CASE WHEN {held} = '' THEN CAST([] AS VARCHAR[]) "
        f"ELSE list_transform(string_split({held}, ','), lambda m: {piece}) END"
    )


_FORCED = "{c} IN ('30000', '50000')"
_EFFECTIVE = f"least(end_date, DATE '{END}')"

_COMPILED = f"""
lists AS (
  SELECT *, id_pk AS rid,
    {_masks("dt_tax_item_ofr_list")} AS dt_codes,
    {_masks("kt_tax_item_ofr_list")} AS kt_codes,
    {_masks("dt_account_mask_list")} AS dt_accounts,
    {_masks("kt_account_mask_list")} AS kt_accounts,
    {_masks("payment_purpose_pattern_list")} AS purposes,
    coalesce(account_mask_rule = 'INCLUDE', false) AS account_include,
    coalesce(payment_purpose_rule = 'INCLUDE', false) AS purpose_include,
    greatest(start_date, DATE '{START}') AS lo,
    {_EFFECTIVE} AS hi
  FROM rules),
compiled AS (
  SELECT * FROM lists
  WHERE len(dt_codes) + len(kt_codes) + len(dt_accounts) + len(kt_accounts)
    + len(purposes) > 0 AND lo <= hi)"""

_VALIDATION = f"""
sided AS (
  SELECT *, 'dt' AS side, dt_tax_item_ofr_list AS code_list, dt_tax_item AS item
  FROM rules
  UNION ALL
  SELECT *, 'kt', kt_tax_item_ofr_list, kt_tax_item FROM rules),
literal AS (
  SELECT * FROM sided
  WHERE code_list <> '' AND NOT contains(code_list, '%')
    AND NOT contains(code_list, '?')),
agreed AS (
  SELECT l.id_pk AS rid, l.side, c.tax_item_ofr, c.tax_item_code,
    c.actual_from <= {_EFFECTIVE}
      AND (c.actual_to IS NULL OR c.actual_to >= {_EFFECTIVE}) AS in_force
  FROM literal l JOIN classifier c
    ON l.code_list = c.tax_item_ofr AND l.item = c.tax_item_code),
passed AS (
  SELECT id_pk AS rid, side FROM sided s
  WHERE {_FORCED.format(c="item")}
    OR EXISTS (SELECT 1 FROM agreed a
               WHERE a.in_force AND a.rid = s.id_pk AND a.side = s.side)),
valid AS (SELECT DISTINCT rid FROM passed)"""


def _any(value: str, masks: str) -> str:
    return f"list_bool_or(list_transform({masks}, lambda m: {value} LIKE m))"


def _if_present(value: str, masks: str) -> str:
    return f"CASE WHEN len({masks}) = 0 THEN true ELSE {_any(value, masks)} END"


_CODES = (
    f"({_if_present('dt_tax_item_ofr', 'dt_codes')})"
    f" AND ({_if_present('kt_tax_item_ofr', 'kt_codes')})"
)
_BOTH_ACCOUNTS = (
    f"(({_if_present('dt_account', 'dt_accounts')})"
    f" AND ({_if_present('kt_account', 'kt_accounts')}))"
)
_ACCOUNTS = (
    "CASE WHEN len(dt_accounts) + len(kt_accounts) = 0 THEN true "
    f"WHEN account_include THEN {_BOTH_ACCOUNTS} ELSE NOT {_BOTH_ACCOUNTS} END"
)
_PURPOSES = (
    "CASE WHEN len(purposes) = 0 THEN true "
    f"WHEN purpose_include THEN {_any('payment_purpose', 'purposes')} "
    f"ELSE NOT {_any('payment_purpose', 'purposes')} END"
)

# Rules beside distinct pairs of codes first, as these are few.
_PAIRED = f"""
code_pairs AS (
  SELECT d.*, r.*
  FROM (SELECT DISTINCT dt_tax_item_ofr, kt_tax_item_ofr FROM tx) d, compiled r
  WHERE {_CODES}),
paired AS (
  SELECT t.*, p.* EXCLUDE (id_pk, dt_tax_item_ofr, kt_tax_item_ofr)
  FROM tx t JOIN code_pairs p
    ON t.dt_tax_item_ofr IS NOT DISTINCT FROM p.dt_tax_item_ofr
    AND t.kt_tax_item_ofr IS NOT DISTINCT FROM p.kt_tax_item_ofr)"""

_IN_WINDOW = "CAST(operation_date AS DATE) BETWEEN lo AND hi"

_MATCHED = f"""
matched AS (
  SELECT * FROM paired
  WHERE rid IN (SELECT rid FROM valid) AND {_IN_WINDOW}
    AND ({_ACCOUNTS}) AND ({_PURPOSES}))"""

_TAGGED = """
tagged AS (
  SELECT id_pk, input_dt, operation_date, rid,
    CASE WHEN dt_account LIKE '7%' THEN nullif(dt_tax_item, '') END AS dt_tax_item,
    CASE WHEN kt_account LIKE '7%' THEN nullif(kt_tax_item, '') END AS kt_tax_item
  FROM matched),
prioritised AS (
  SELECT *,
    CASE WHEN dt_tax_item IN ('30000', '50000') THEN 1 ELSE 2 END AS dt_prio,
    CASE WHEN kt_tax_item IN ('30000', '50000') THEN 1 ELSE 2 END AS kt_prio
  FROM tagged)"""


def _winners(side: str, other: str) -> str:
    return f"""
winners_{side} AS (
  SELECT * FROM prioritised WHERE {side}_tax_item IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY id_pk ORDER BY {side}_prio, rid,
    operation_date, {side}_tax_item, {other}_tax_item NULLS FIRST,
    input_dt NULLS FIRST) = 1)"""


_RESOLVED = (
    _winners("dt", "kt")
    + ","
    + _winners("kt", "dt")
    + """,
winners AS (
  SELECT *, 'dt' AS side FROM winners_dt
  UNION ALL SELECT *, 'kt' FROM winners_kt),
report AS (
  SELECT id_pk, input_dt, dt_tax_item AS dt_tax_item_auto,
    kt_tax_item AS kt_tax_item_auto, operation_date
  FROM winners),
items AS (
  SELECT id_pk, max(dt_tax_item_auto) AS dt_tax_item_auto,
    max(kt_tax_item_auto) AS kt_tax_item_auto
  FROM report GROUP BY id_pk),
result AS (
  SELECT DISTINCT r.id_pk, r.input_dt, r.operation_date,
    i.dt_tax_item_auto, i.kt_tax_item_auto
  FROM report r JOIN items i ON r.id_pk = i.id_pk)"""
)

_VIEWS = [_RELATIONS, _ALL_RULES]
_RULES = [*_VIEWS, _COMPILED]
_CHECKED = [*_RULES, _VALIDATION]
_PAIRS = [*_RULES, _PAIRED]
_MATCHES = [*_CHECKED, _PAIRED, _MATCHED]
_TAGS = [*_MATCHES, _TAGGED]
_RESULT = [*_TAGS, _RESOLVED]

_MATCH = "SELECT id_pk, operation_date, rid FROM"
_WINNER = (
    "SELECT id_pk, input_dt, operation_date, rid, dt_tax_item, kt_tax_item FROM"
)


def _with(steps: list[str], select: str) -> str:
    return f"WITH {','.join(steps)}\n{select}"


def _crossed(condition: str) -> str:
    """Transactions beside all rules for which one condition holds."""
    return f"SELECT t.id_pk, t.operation_date, r.rid FROM tx t, compiled r WHERE {condition}"


_WHOLE = "len(list_filter({m}, lambda m: contains(m, '%') OR contains(m, '_'))) = 0"


def _is_equi() -> str:
    """Does some list that must be met consist of whole values only?"""
    options = [
        f"(len({m}) > 0 AND {_WHOLE.format(m=m)}{needs})"
        for m, needs in (
            ("dt_codes", ""),
            ("kt_codes", ""),
            ("dt_accounts", " AND account_include"),
            ("kt_accounts", " AND account_include"),
            ("purposes", " AND purpose_include"),
        )
    ]
    return "(" + " OR ".join(options) + ")"


_LISTS = ("dt_codes", "kt_codes", "dt_accounts", "kt_accounts", "purposes")
_FLAGS = ("has_dt_ofr", "has_kt_ofr", "has_dt_acct", "has_kt_acct", "has_purpose")
_RESULT_ROWS = "SELECT * FROM result"

_SQL: dict[str, str] = {
    "tx_view": _with(_VIEWS, "SELECT * FROM tx"),
    "rules_view": _with(_VIEWS, "SELECT * FROM rules"),
    "classifier_view": _with(_VIEWS, "SELECT * FROM classifier"),
    "operation_day": _with(
        _VIEWS,
        "SELECT id_pk, CAST(operation_date AS DATE) AS op_day, input_dt FROM tx",
    ),
    "mask_explode": _with(
        _RULES,
        " UNION ALL ".join(
            f"SELECT rid, '{m}' AS list_name, unnest({m}) AS mask FROM lists"
            for m in _LISTS
        ),
    ),
    "mask_presence": _with(
        _RULES,
        "SELECT rid, "
        + ", ".join(f"len({m}) > 0 AS {f}" for m, f in zip(_LISTS, _FLAGS))
        + " FROM lists",
    ),
    "rules_compiled": _with(
        _RULES,
        "SELECT rid, "
        + ", ".join(f"CAST(len({m}) AS INTEGER) AS n_{m}" for m in _LISTS)
        + " FROM lists",
    ),
    "rule_no_conditions": _with(
        _RULES,
        "SELECT rid FROM lists WHERE "
        + " AND ".join(f"len({m}) = 0" for m in _LISTS),
    ),
    "rule_window": _with(_RULES, "SELECT rid, lo, hi FROM lists"),
    "rule_effective_end": _with(_RULES, "SELECT rid, hi AS effective_end FROM lists"),
    "literal_rules": _with(_CHECKED, "SELECT id_pk AS rid, side FROM literal"),
    "forced_rules": _with(
        _CHECKED,
        f"SELECT id_pk AS rid, side FROM sided WHERE {_FORCED.format(c='item')}",
    ),
    "rule_classifier_join": _with(
        _CHECKED, "SELECT rid, side, tax_item_ofr, tax_item_code FROM agreed"
    ),
    "rule_classifier_asof": _with(
        _CHECKED,
        "SELECT rid, side, tax_item_ofr, tax_item_code FROM agreed WHERE in_force",
    ),
    "rule_check_side_dt": _with(_CHECKED, "SELECT rid FROM passed WHERE side = 'dt'"),
    "rule_check_side_kt": _with(_CHECKED, "SELECT rid FROM passed WHERE side = 'kt'"),
    "validated_rules": _with(_CHECKED, "SELECT rid FROM valid"),
    "applied_rules": _with(_CHECKED, "SELECT rid FROM valid ORDER BY rid"),
    "mask_any_like": _with(
        _RULES,
        _crossed(f"len(purposes) > 0 AND {_any('payment_purpose', 'purposes')}"),
    ),
    "match_source_code": _with(
        _PAIRS, f"{_MATCH} paired WHERE len(dt_codes) + len(kt_codes) > 0"
    ),
    "match_account": _with(
        _RULES,
        _crossed(f"len(dt_accounts) + len(kt_accounts) > 0 AND ({_ACCOUNTS})"),
    ),
    "match_purpose": _with(_RULES, _crossed(f"len(purposes) > 0 AND ({_PURPOSES})")),
    "match_all": _with(
        _PAIRS, f"{_MATCH} paired WHERE ({_ACCOUNTS}) AND ({_PURPOSES})"
    ),
    "match_window": _with(
        _RULES,
        f"""SELECT l.rid, d.op_day, d.n FROM lists l JOIN (
  SELECT CAST(operation_date AS DATE) AS op_day, count(*) AS n FROM tx
  WHERE CAST(operation_date AS DATE) BETWEEN DATE '{START}' AND DATE '{END}'
  GROUP BY 1) d ON d.op_day BETWEEN l.lo AND l.hi""",
    ),
    "apply_rules": _with(_MATCHES, f"{_MATCH} matched"),
    "apply_rules_equi": _with(_MATCHES, f"{_MATCH} matched WHERE {_is_equi()}"),
    "apply_rules_theta": _with(_MATCHES, f"{_MATCH} matched WHERE NOT {_is_equi()}"),
    "tag_sides": _with(
        _MATCHES,
        """SELECT id_pk, operation_date, rid,
  CASE WHEN dt_account LIKE '7%' THEN dt_tax_item END AS dt_tax_item,
  CASE WHEN kt_account LIKE '7%' THEN kt_tax_item END AS kt_tax_item
FROM matched""",
    ),
    "blank_to_null": _with(
        _TAGS, "SELECT id_pk, operation_date, rid, dt_tax_item, kt_tax_item FROM tagged"
    ),
    "tag_priority": _with(
        _TAGS, "SELECT id_pk, operation_date, rid, dt_prio, kt_prio FROM prioritised"
    ),
    "resolve_side_dt": _with(_RESULT, f"{_WINNER} winners_dt"),
    "resolve_side_kt": _with(_RESULT, f"{_WINNER} winners_kt"),
    "resolve_union": _with(_RESULT, "SELECT * EXCLUDE (dt_prio, kt_prio) FROM winners"),
    "report_projection": _with(_RESULT, "SELECT * FROM report"),
    "consolidate_items": _with(_RESULT, "SELECT * FROM items"),
    "consolidate": _with(_RESULT, _RESULT_ROWS),
    "classify_transactions": _with(_RESULT, _RESULT_ROWS),
    "classify_join": _with(_RESULT, _RESULT_ROWS),
    "classify_literal": _with(_RESULT, _RESULT_ROWS),
    "rejected_rules": _with(
        _VIEWS,
        """SELECT id_pk + 10000000 AS rid, 'stray escape in purposes' AS reason FROM rules
UNION ALL SELECT CAST(NULL AS BIGINT), 'no id' FROM rules WHERE payment_purpose_pattern_list <> ''""",
    ),
    "sink_partition_counts": _with(
        _RESULT, "SELECT input_dt, count(*) AS n FROM result GROUP BY input_dt"
    ),
    "count_tagged": _with(_RESULT, "SELECT count(*) AS n FROM result"),
    "point_lookup": _with(
        _RESULT, f"SELECT * FROM result WHERE id_pk = '{LOOKED_UP}'"
    ),
}

ORACLES = {name: _SQL[name] for name in REGISTRY if name in _SQL}
