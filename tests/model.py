"""The whole classification over Python lists, written for clarity only."""

from __future__ import annotations

import re

FORCED = ("30000", "50000")


def masks(text):
    """Masks of a list, in the form of LIKE patterns."""
    if not text:
        return []
    pieces, current = [], ""
    for n, c in enumerate(text):
        if c == "," and (n == 0 or text[n - 1] != "/"):
            pieces.append(current)
            current = ""
        else:
            current += c
    pieces.append(current)
    while pieces and pieces[-1] == "":
        pieces.pop()
    blanks = "".join(map(chr, range(33)))
    return [p.replace("/,", ",").strip(blanks).replace("?", "_") for p in pieces]


def like(value, mask):
    if value is None:
        return None
    signs = {"%": ".*", "_": "."}
    pattern = "".join(signs.get(c) or re.escape(c) for c in mask)
    return re.fullmatch(pattern, value, re.DOTALL) is not None


def any_like(value, patterns):
    return None if value is None else any(like(value, p) for p in patterns)


def both(a, b):
    if a is False or b is False:
        return False
    return None if a is None or b is None else True


def flip(a):
    return None if a is None else not a


def matches(tx, rule):
    def one(value, text):
        found = masks(rule[text])
        return [any_like(tx[value], found)] if found else []

    def together(terms):
        result = True
        for t in terms:
            result = both(result, t)
        return result

    codes = one("dt_tax_item_ofr", "dt_tax_item_ofr_list") + one(
        "kt_tax_item_ofr", "kt_tax_item_ofr_list"
    )
    accounts = one("dt_account", "dt_account_mask_list") + one(
        "kt_account", "kt_account_mask_list"
    )
    purposes = one("payment_purpose", "payment_purpose_pattern_list")
    terms = list(codes)
    if accounts:
        found = together(accounts)
        include = rule["account_mask_rule"] == "INCLUDE"
        terms.append(found if include else flip(found))
    if purposes:
        include = rule["payment_purpose_rule"] == "INCLUDE"
        terms.append(purposes[0] if include else flip(purposes[0]))
    return bool(terms) and together(terms) is True


def in_window(tx, rule, start, end):
    if tx["operation_date"] is None:
        return False
    lo = max(filter(None, (rule["start_date"], start)))
    hi = min(filter(None, (rule["end_date"], end)))
    return lo <= tx["operation_date"].date() <= hi


def valid_rules(rules, classifier, end):
    passed = set()
    for r in rules:
        last = min(filter(None, (r["end_date"], end)))
        for codes, item in (
            ("dt_tax_item_ofr_list", "dt_tax_item"),
            ("kt_tax_item_ofr_list", "kt_tax_item"),
        ):
            if not r[codes] or re.search("[%?]", r[codes]):
                continue
            for c in classifier:
                if (
                    (c["tax_item_ofr"], c["tax_item_code"]) == (r[codes], r[item])
                    and c["actual_from"] <= last
                    and (c["actual_to"] is None or c["actual_to"] >= last)
                ):
                    passed.add(r["id_pk"])
    return [
        r
        for r in rules
        if r["id_pk"] in passed
        or r["dt_tax_item"] in FORCED
        or r["kt_tax_item"] in FORCED
    ]


def pairs(txs, rules, start, end):
    return [
        (t, r)
        for t in txs
        for r in rules
        if in_window(t, r, start, end) and matches(t, r)
    ]


def classify(txs, rules, classifier, start, end):
    sides = ("dt", "kt")
    tagged = []
    for t, r in pairs(txs, valid_rules(rules, classifier, end), start, end):
        tags = {
            s: (r[f"{s}_tax_item"] or None)
            if (t[f"{s}_account"] or "").startswith("7")
            else None
            for s in sides
        }
        tagged.append((t, r, tags))

    def rank(entry, side, other):
        t, r, tags = entry
        second = tags[other]
        return (
            tags[side] not in FORCED,
            r["id_pk"],
            t["operation_date"],
            tags[side],
            (second is not None, second or ""),
            (t["input_dt"] is not None, str(t["input_dt"])),
        )

    kept = {}
    for side, other in (sides, sides[::-1]):
        best = {}
        for e in tagged:
            key = e[0]["id_pk"]
            if e[2][side] is None or key is None:
                continue
            if key not in best or rank(e, side, other) < rank(best[key], side, other):
                best[key] = e
        for key, e in best.items():
            kept.setdefault(key, []).append(e)
    result = set()
    for key, entries in kept.items():
        items = [
            max((e[2][s] for e in entries if e[2][s] is not None), default=None)
            for s in sides
        ]
        for t, _, _ in entries:
            result.add((key, t["input_dt"], t["operation_date"], *items))
    return result
