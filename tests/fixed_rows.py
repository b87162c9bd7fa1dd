"""Small transactions and rules with known results."""

from ledgertag.schemas import RULE_SCHEMA, TX_SCHEMA

ID_PREFIX = "Z1000001-7781-301v-8b56-0000000"

# Rows for which the results are known.
CLIENT = "40802810430000024501"

# id suffix, debit account, credit account, debit code, credit code, purpose
TRANSACTIONS = [
    ("11732", CLIENT, "70601810154002940798", None, "29407.98", "RNU46(D)-fis-(NOT_AUTO_KNU)"),
    ("11734", CLIENT, "70601810154001111700", None, "11117", "RNU46(V)-fis-(AUTO_KNU_30000)"),
    ("11731", "70601810154002940798", CLIENT, "29407.98", None, "RNU46(D)-fis-(AUTO_KNU)"),
    ("11730", "70606810154004780399", CLIENT, "47803.99", None, "NOT_AUTO_KNU"),
    ("11729", CLIENT, "70606810154004780399", None, "47803.99", "RNU57(D)-fis-(NOT_AUTO_KNU)"),
    ("11737", "70601810154001111700", CLIENT, "11117", None, "RNU46(V)-fis-(NOT_AUTO_KNU)"),
    ("11738", CLIENT, "70601810154002110229", None, "21102.29", "RNU46(V)-fis-(AUTO_KNU_30000)"),
    ("11736", CLIENT, "70601810154001111700", None, "11117", "NOT_AUTO_KNU"),
    ("11733", "70601810154002940798", CLIENT, "29407.98", None, "NOT_AUTO_KNU"),
    ("11735", "47423810430000024537", "70601810154001111700", None, "11117", "RNU46(V)-fis-(AUTO_KNU_30000)"),
    ("11728", "70606810154004780399", CLIENT, "47803.99", None, "RNU57(D)-fis-(AUTO_KNU)"),
    ("11728", "70606810154004780399", CLIENT, "47803.99", None, "RNU57(D)-fis-(AUTO_KNU)"),
    ("02383", "20101810116002461234", "70601810116002460102", "47803.99", None, "MSK-1-P 301-70601"),
    ("1173111", CLIENT, "70601810154002110229", None, "21102.29", "RNU46(V)-fis-(AUTO_KNU_30000)"),
]

PURPOSES = (
    "RNU57(D)-fis-(AUTO_KNU), RNU57(D)-fis-(NOT_AUTO_KNU), "
    "RNU46(D)-fis-(AUTO_KNU), RNU46(D)-fis-(NOT_AUTO_KNU)"
)
WITH_COMMA = "TEST/, SOME COMMA, " + PURPOSES
ONE_DAY = ("2021-03-01", "2021-03-01")

# id, debit item, credit item, debit codes, credit codes, account mode, debit
# accounts, credit accounts, purpose mode, purposes, first day, last day
RULES = [
    (1, "21495", "", "47803.99", "", "", "", "", "INCLUDE", WITH_COMMA, *ONE_DAY),
    (6, "", "31495", "47803.99", "", "", "", "", "INCLUDE", WITH_COMMA, *ONE_DAY),
    (2, "", "30000", "", "11117%, 21102%", "EXCLUDE", "47423?????????????37%", "", "EXCLUDE", "NOT_AUTO_KNU", *ONE_DAY),
    (3, "30000", "", "47803.99", "", "", "", "", "INCLUDE", PURPOSES, *ONE_DAY),
    (4, "11311", "", "29407.98", "", "", "", "", "INCLUDE", PURPOSES, *ONE_DAY),
    (5, "11311", "", "29407.98", "", "", "", "", "INCLUDE", PURPOSES, *ONE_DAY),
    (8, "11310", "", "29407.98?", "", "", "", "", "INCLUDE", PURPOSES, *ONE_DAY),
    (9, "11310", "", "29407.98%", "", "", "", "", "INCLUDE", PURPOSES, *ONE_DAY),
    (10, "21495", "", "29407.98", "", "", "", "", "INCLUDE", PURPOSES, *ONE_DAY),
    (14, "30000", "", "", "", "", "", "", "INCLUDE", "MSK-1-P 301-70601", "1900-01-01", "9999-12-31"),
]

# An assumption: no classifier is given for these rows.
CLASSIFIER = [
    ("47803.99", "21495", "1900-01-01", None),
    ("29407.98", "21495", "1900-01-01", None),
]

# Tags by id suffix; ids that are not listed have no row.
EXPECTED = {
    "11728": ("30000", None),
    "11731": ("21495", None),
    "11734": (None, "30000"),
    "11738": (None, "30000"),
    "1173111": (None, "30000"),
}

RULE_FIELDS = RULE_SCHEMA.names[:12]
CLASSIFIER_FIELDS = ("tax_item_ofr", "tax_item_code", "actual_from", "actual_to")
TX_FIELDS = (
    "id_pk",
    "dt_account",
    "kt_account",
    "dt_tax_item_ofr",
    "kt_tax_item_ofr",
    "payment_purpose",
)


def transaction_records():
    """Records as they stand in a file, all fields present."""
    for row in TRANSACTIONS:
        record = dict.fromkeys(TX_SCHEMA.names)
        record |= dict(zip(TX_FIELDS, row))
        record["id_pk"] = ID_PREFIX + row[0]
        record["operation_date"] = "2021-03-01T20:00:00.000+03:00"
        record["input_dt"] = "2021-03-01T00:00:00.000+03:00"
        record["document_date"] = ""
        record["usl_div_sk"] = 5000000000016111
        yield record


def rule_records():
    for row in RULES:
        stamp = "" if row[0] == 14 else "2021-03-01"
        yield dict(zip(RULE_FIELDS, row)) | {"updated_ts": stamp, "user_login": "1"}


def classifier_records():
    for row in CLASSIFIER:
        yield dict(zip(CLASSIFIER_FIELDS, row))
