import datetime

from loanlens.functions import (
    blank_to_null,
    mi_flag,
    min_credit_score,
    month_part,
    parse_mdy,
    readable_label,
    readable_label_py,
    try_double,
    year_part,
)
from loanlens.schemas import MODEL_FEATURES


def test_readable_label_column_equals_python(spark):
    names = [f"out_{c}" for c in MODEL_FEATURES] + ["out_first_time_homebuyer_index", "plain"]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    got = {r["name"]: r["label"] for r in df.select("name", readable_label("name").alias("label")).collect()}
    assert got == {n: readable_label_py(n) for n in names}
    assert readable_label_py("out_original_unpaid_principal_balance") == "Original Unpaid Principal Balance"
    assert readable_label_py("out_relocation_mortgage_indicator_index") == "Relocation Mortgage Indicator"


def test_scalar_helpers(spark):
    df = spark.createDataFrame(
        [("  ", "03/2001", "02/29/2000", "25", "700", "", "1.5"), (None, "x", "13/45/2000", "0", "", "", "abc")],
        "a string, d string, ts string, ins string, b string, c string, num string",
    )
    rows = df.select(
        blank_to_null("a").alias("a"),
        month_part("d").alias("m"),
        year_part("d").alias("y"),
        parse_mdy("ts").alias("ts"),
        mi_flag("ins").alias("mi"),
        min_credit_score("b", "c").alias("mcs"),
        try_double("num").alias("num"),
    ).collect()
    assert tuple(rows[0]) == (None, 3, 2001, datetime.date(2000, 2, 29), 1, 700, 1.5)
    assert tuple(rows[1]) == (None, None, None, None, 0, 1000, None)
