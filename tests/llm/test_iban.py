"""IBANs before words and numbers that look like a further group."""

from __future__ import annotations

import pytest

from siltbed.llm.pii import find_pii, mask_pii

ACCOUNTS = [
    "ES91 2100 0418 4502 0005 1332",
    "AT61 1904 3002 3457 3201",
    "BE68 5390 0754 7034",
    "SE45 5000 0000 0583 9825 7466",
    "CZ65 0800 0000 1920 0014 5399",
    "PL61 1090 1014 0000 0712 1981 2874",
    "GB82 WEST 1234 5698 7654 32",
    "NO93 8601 1117 947",
    "MT84 MALT 0110 0001 2345 MTLC AST0 01S",
    "ES9121000418450200051332",
]
AFTER = ["", " EUR 50", " BIC CAIXESBB", " 2012 0432", " Bank", " 8", ", GB82", " X1 and 1234", "\nBIC AB"]


@pytest.fixture(scope="module")
def texts(spark):
    rows = [(f"to {a}{x}", a, x) for a in ACCOUNTS for x in AFTER]
    rows.append((f"{ACCOUNTS[0]} {ACCOUNTS[1]}", ACCOUNTS[0], " [iban]"))
    return spark.createDataFrame(rows, "text string, account string, after string")


def test_an_account_ends_where_its_country_says(texts):
    for r in find_pii(texts).collect():
        spans = [r.text[s.s : s.e] for s in r.added_spans if s.kind == "iban"]
        assert spans == ([r.account] if r.after != " [iban]" else ACCOUNTS[:2]), r.text
    for r in mask_pii(texts).collect():
        assert r.text in (f"to [iban]{r.after}", f"[iban]{r.after}")


def test_other_lengths_and_digits_are_no_accounts(spark):
    rows = [("ES91 2100 0418 4502 0005 1333 EUR",), ("ES91 2100 0418 4502 0005 13",), ("xES91 2100 0418 4502 0005 1332",)]
    for r in find_pii(spark.createDataFrame(rows, "text string")).collect():
        assert r.added_spans == []
