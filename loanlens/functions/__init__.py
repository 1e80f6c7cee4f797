"""Column expressions shared by the operators (all JVM-side, codegen friendly)."""

from loanlens.functions.columns import (  # noqa: F401
    blank_to_null,
    credit_or_default,
    is_blank,
    mi_flag,
    min_credit_score,
    missing_double,
    month_part,
    not_blank,
    parse_mdy,
    readable_label,
    readable_label_py,
    try_bigint,
    try_double,
    try_int,
    year_part,
)
