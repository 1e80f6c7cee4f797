"""Randomized rows: the Spark cleaning chain against a plain-Python statement of its rules."""

import random

from loanlens.operators.cleaning import prepare_loans

from conftest import acq_frame, acq_row

CHOICES = ["", " ", "0", "7", "25", "25.5", "abc", "-3", " 12 ", "700", "680", "850", "1e3"]
DATES = ["", "01/2000", "12/1999", "13-2001", "06/2003", "2/2001", "ab/cd", "07/", "/2004", " 03/2002 "]


def _int(text):
    t = (text or "").strip()
    if t == "":
        return None
    try:
        return int(t) if t.lstrip("-").isdigit() else None
    except ValueError:
        return None


def _expected(row):
    d = (row["origination_date"] or "").strip()
    parts = d.split("/") if d else []
    year = _int(parts[1]) if len(parts) > 1 else None
    b, c = row["borrower_credit_score"], row["co_borrower_credit_score"]
    present = lambda v: (v or "").strip() != ""
    if year is None or year < 2000 or not (present(b) or present(c)):
        return None
    bi, ci = _int(b), _int(c)
    mcs = min(1000 if bi is None else bi, 1000 if ci is None else ci)
    ins = _int(row["insurance_percentage"])
    mi = 1 if ins is not None and ins > 0 else 0
    return (year, mcs, mi)


def test_random_rows_match_python_rules(spark):
    rnd = random.Random(7)
    rows, dicts = [], []
    for i in range(600):
        d = {
            "loan_id": str(i),
            "origination_date": rnd.choice(DATES),
            "borrower_credit_score": rnd.choice(CHOICES),
            "co_borrower_credit_score": rnd.choice(CHOICES),
            "insurance_percentage": rnd.choice(CHOICES),
        }
        dicts.append(d)
        rows.append(acq_row(**d))
    got = {r["loan_id"]: (r["origination_year"], r["min_credit_score"], r["mi"]) for r in prepare_loans(acq_frame(spark, rows)).collect()}
    expected = {d["loan_id"]: e for d in dicts if (e := _expected(d)) is not None}
    assert got == expected
