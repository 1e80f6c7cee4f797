"""Record layouts of the mortgage files and the derived stages.

Every raw field is text; typing happens in the cleaning operators with
``try_cast`` so a malformed value becomes null instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: acquisition file layout (26 pipe-separated fields, in file order) ---
ACQ_FIELDS = [
    "loan_id",
    "channel",
    "seller_name",
    "original_interest_rate",
    "original_unpaid_principal_balance",
    "original_loan_term",
    "origination_date",
    "first_payment_date",
    "ltv",
    "cltv",
    "borrower_count",
    "dti",
    "borrower_credit_score",
    "first_time_homebuyer",
    "loan_purpose",
    "property_type",
    "unit_count",
    "occupancy_status",
    "property_state",
    "zip",
    "insurance_percentage",
    "product_type",
    "co_borrower_credit_score",
    "mortgage_insurance_type",
    "relocation_mortgage_indicator",
    "unknownCol",
]

# --- fixed values: columns after the feature-engineering and drop steps (24, in order) ---
LOAN_FIELDS = [
    "loan_id",
    "channel",
    "seller_name",
    "original_interest_rate",
    "original_unpaid_principal_balance",
    "original_loan_term",
    "origination_month",
    "origination_year",
    "first_payment_month",
    "first_payment_year",
    "ltv",
    "cltv",
    "borrower_count",
    "dti",
    "min_credit_score",
    "first_time_homebuyer",
    "loan_purpose",
    "property_type",
    "unit_count",
    "occupancy_status",
    "property_state",
    "mi",
    "product_type",
    "relocation_mortgage_indicator",
]

# --- fixed values: the 14 numeric model inputs, cast to double ---
NUMERIC_FEATURES = [
    "original_interest_rate",
    "original_unpaid_principal_balance",
    "original_loan_term",
    "origination_month",
    "origination_year",
    "first_payment_month",
    "first_payment_year",
    "ltv",
    "cltv",
    "borrower_count",
    "dti",
    "min_credit_score",
    "unit_count",
    "mi",
]

# --- fixed values: the 8 categorical columns indexed by frequency ---
CATEGORICAL_FEATURES = [
    "channel",
    "seller_name",
    "first_time_homebuyer",
    "loan_purpose",
    "product_type",
    "property_type",
    "occupancy_status",
    "relocation_mortgage_indicator",
]

# The 22 model inputs in the order they are imputed, assembled and tested.
MODEL_FEATURES = NUMERIC_FEATURES + [c + "_index" for c in CATEGORICAL_FEATURES]

# --- fixed values: columns of the rows-with-nulls filter ---
DROP_NA_SUBSET = ["cltv", "borrower_count", "dti", "min_credit_score"]

# --- fixed values: plot-job projection, raw acquisition field -> display name ---
PLOT_COLUMNS = [
    ("original_interest_rate", "OriginalInterestRate"),
    ("original_unpaid_principal_balance", "OriginalUnpaiPrincipalBalance"),
    ("original_loan_term", "OriginalLoanTerm"),
    ("ltv", "OriginalLoanToValue"),
    ("cltv", "OriginalCombinedLoanToValue"),
    ("borrower_count", "NumberOfBorrowers"),
    ("dti", "DebtToIncomeRatio"),
    ("borrower_credit_score", "BorrowerCreditScore"),
    ("loan_purpose", "LoanPurpose"),
    ("insurance_percentage", "MortgageInsurancePercentage"),
    ("co_borrower_credit_score", "CoBorrowerCreditScore"),
    ("mortgage_insurance_type", "MortgageInsuranceType"),
]
PLOT_CATEGORICAL = "LoanPurpose"

# --- fixed values: decision threshold used for the confusion tables ---
CONFUSION_THRESHOLD = 0.415856

# --- fixed values: split weights and seed, model iteration counts, GLM settings ---
SPLIT_WEIGHTS = (0.7, 0.3)
SPLIT_SEED = 11
GLM_MAX_ITER = 10
GLM_REG_PARAM = 0.3
LR_MAX_ITER = 10
GBT_MAX_ITER = 10

# Performance file: only three positions carry meaning (0 = loan id,
# 1 = reporting date MM/dd/yyyy, 15 = foreclosure date, blank when none).
# The unnamed positions in between keep a positional name.
PERF_LOAN_ID = "loan_id"
PERF_DATE = "reporting_date"
PERF_FORECLOSURE = "foreclosure_date"
PERF_DATE_FORMAT = "MM/dd/yyyy"


def perf_fields(n_fields: int = 16) -> list[str]:
    """Names for a performance record with ``n_fields`` positions (at least 16)."""
    if n_fields < 16:
        raise ValueError("a performance record has at least 16 fields")
    names = [f"field_{i:02d}" for i in range(n_fields)]
    names[0] = PERF_LOAN_ID
    names[1] = PERF_DATE
    names[15] = PERF_FORECLOSURE
    return names


PERF_FIELDS = perf_fields()


def text_schema(names: list[str]) -> T.StructType:
    """All-string schema used to read raw pipe-delimited records."""
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


ACQ_SCHEMA = text_schema(ACQ_FIELDS)
PERF_SCHEMA = text_schema(PERF_FIELDS)
