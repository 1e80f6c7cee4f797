import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from loanlens.session import build_session

    scratch = tempfile.mkdtemp(prefix="loanlens-tests-")
    s = build_session(
        "loanlens-tests",
        "local[*]",
        8,
        extra={"spark.checkpoint.dir": os.path.join(scratch, "checkpoints")},
    )
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_small():
    return SF001


def acq_row(**overrides):
    """One raw acquisition record (all text); override fields by name."""
    from loanlens.schemas import ACQ_FIELDS

    base = {
        "loan_id": "100",
        "channel": "R",
        "seller_name": "BANK",
        "original_interest_rate": "4.25",
        "original_unpaid_principal_balance": "200000",
        "original_loan_term": "360",
        "origination_date": "03/2001",
        "first_payment_date": "05/2001",
        "ltv": "80",
        "cltv": "80",
        "borrower_count": "2",
        "dti": "30",
        "borrower_credit_score": "720",
        "first_time_homebuyer": "N",
        "loan_purpose": "P",
        "property_type": "SF",
        "unit_count": "1",
        "occupancy_status": "P",
        "property_state": "CA",
        "zip": "940",
        "insurance_percentage": "",
        "product_type": "FRM",
        "co_borrower_credit_score": "740",
        "mortgage_insurance_type": "",
        "relocation_mortgage_indicator": "N",
        "unknownCol": "",
    }
    base.update(overrides)
    return tuple(base[c] for c in ACQ_FIELDS)


def acq_frame(spark, rows):
    from loanlens.schemas import ACQ_SCHEMA

    return spark.createDataFrame(rows, ACQ_SCHEMA)
