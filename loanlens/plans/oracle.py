"""DuckDB SQL for the registered queries (independent re-statement of each job).

The views ``orders lineitem customer nation`` are registered by the caller.
The first CTEs rebuild the raw acquisition / performance records with the
same rules as ``loanlens.sources.tables``; everything after them states the
job itself in plain SQL.
"""

from __future__ import annotations

from loanlens.schemas import (
    ACQ_FIELDS,
    CATEGORICAL_FEATURES,
    CONFUSION_THRESHOLD,
    DROP_NA_SUBSET,
    GLM_REG_PARAM,
    LOAN_FIELDS,
    MODEL_FEATURES,
    NUMERIC_FEATURES,
    PERF_FIELDS,
    PLOT_COLUMNS,
)

DIGITS = 6


def _r(expr: str, digits: int = DIGITS) -> str:
    return f"(CASE WHEN round({expr}, {digits}) = 0 THEN 0.0::DOUBLE ELSE round({expr}, {digits}) END)"


def _nb(col: str) -> str:
    """Blank text -> NULL."""
    return f"nullif(trim({col}), '')"


_ACQ_EXPRS = {
    "loan_id": "cast(ok AS VARCHAR)",
    "channel": "o_orderstatus",
    "seller_name": "c_mktsegment",
    "original_interest_rate": (
        "cast(cast(floor(rate / 100) AS BIGINT) AS VARCHAR) || '.' || lpad(cast(rate % 100 AS VARCHAR), 2, '0')"
    ),
    "original_unpaid_principal_balance": "cast(upb AS VARCHAR)",
    "original_loan_term": "cast(120 + 60 * n_lines AS VARCHAR)",
    "origination_date": "strftime(o_orderdate, '%m/%Y')",
    "first_payment_date": "strftime(o_orderdate + INTERVAL 2 MONTH, '%m/%Y')",
    "ltv": "coalesce(cast(ltv_num AS VARCHAR), '')",
    "cltv": (
        "CASE WHEN ok % 37 = 0 OR ltv_num IS NULL THEN '' "
        "ELSE cast(ltv_num + CASE WHEN ok % 5 = 0 THEN 5 ELSE 0 END AS VARCHAR) END"
    ),
    "borrower_count": "CASE WHEN ok % 101 <> 0 THEN cast(1 + ok % 2 AS VARCHAR) ELSE '' END",
    "dti": "CASE WHEN ck % 11 <> 0 THEN cast(ck % 65 AS VARCHAR) ELSE '' END",
    "borrower_credit_score": (
        "CASE WHEN c_acctbal >= 0 THEN cast(300 + cast(floor(c_acctbal) AS BIGINT) % 551 AS VARCHAR) ELSE '' END"
    ),
    "first_time_homebuyer": "CASE WHEN ok % 7 = 0 THEN 'U' WHEN ok % 7 < 3 THEN 'Y' ELSE 'N' END",
    "loan_purpose": "substr(o_orderpriority, 1, 1)",
    "property_type": "CASE ck % 3 WHEN 0 THEN 'SF' WHEN 1 THEN 'CO' ELSE 'PU' END",
    "unit_count": "cast(1 + ok % 4 AS VARCHAR)",
    "occupancy_status": "CASE WHEN ck % 5 = 0 THEN 'S' WHEN ck % 5 = 1 THEN 'I' ELSE 'P' END",
    "property_state": "n_name",
    "zip": "lpad(cast(ck % 1000 AS VARCHAR), 3, '0')",
    "insurance_percentage": (
        "CASE WHEN ltv_num >= 80 THEN cast(6 + ok % 25 AS VARCHAR) WHEN ok % 13 = 0 THEN '0' ELSE '' END"
    ),
    "product_type": "'FRM'",
    "co_borrower_credit_score": "CASE WHEN ok % 2 = 1 THEN cast(300 + (ck * 13) % 551 AS VARCHAR) ELSE '' END",
    "mortgage_insurance_type": "CASE WHEN ltv_num >= 80 THEN cast(1 + ok % 2 AS VARCHAR) ELSE '' END",
    "relocation_mortgage_indicator": "CASE WHEN ok % 50 = 0 THEN 'Y' ELSE 'N' END",
    "unknownCol": "''",
}

ACQ_CTE = (
    "li_agg AS (SELECT l_orderkey, count(*) AS n_lines, "
    "cast(round(sum(l_discount) * 100) AS BIGINT) AS disc, cast(sum(l_quantity) AS BIGINT) AS qty "
    "FROM lineitem GROUP BY l_orderkey),\n"
    "acq_base AS (SELECT o.o_orderkey AS ok, o.o_custkey AS ck, o.o_orderstatus, o.o_orderdate, o.o_orderpriority, "
    "c.c_acctbal, c.c_mktsegment, n.n_name, coalesce(li.n_lines, 0) AS n_lines, "
    "coalesce(li.disc, 0) + 300 AS rate, 20 + li.qty % 78 AS ltv_num, cast(round(o.o_totalprice) AS BIGINT) AS upb "
    "FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey "
    "LEFT JOIN li_agg li ON li.l_orderkey = o.o_orderkey),\n"
    "acq AS (SELECT " + ", ".join(f"{_ACQ_EXPRS[c]} AS {c}" for c in ACQ_FIELDS) + " FROM acq_base)"
)

_PERF_DATE = "strftime(l_shipdate, '%m/%d/%Y')"
_PERF_EXPRS = {
    "loan_id": "cast(l_orderkey AS VARCHAR)",
    "reporting_date": _PERF_DATE,
    "foreclosure_date": f"CASE WHEN l_returnflag = 'R' AND l_quantity >= 45 THEN {_PERF_DATE} ELSE '' END",
    "field_02": "cast(l_linenumber AS VARCHAR)",
    "field_03": "cast(l_partkey AS VARCHAR)",
    "field_04": "cast(l_suppkey AS VARCHAR)",
    "field_05": "cast(cast(l_quantity AS BIGINT) AS VARCHAR)",
    "field_06": "cast(cast(round(l_extendedprice * 100) AS BIGINT) AS VARCHAR)",
    "field_07": "cast(cast(round(l_discount * 100) AS BIGINT) AS VARCHAR)",
    "field_08": "cast(cast(round(l_tax * 100) AS BIGINT) AS VARCHAR)",
    "field_09": "l_returnflag",
    "field_10": "l_linestatus",
}
PERF_CTE = "perf AS (SELECT " + ", ".join(f"{_PERF_EXPRS.get(c, chr(39) * 2)} AS {c}" for c in PERF_FIELDS) + " FROM lineitem)"

_HEAD = ACQ_FIELDS[: ACQ_FIELDS.index("original_loan_term") + 1]
_TAIL = ACQ_FIELDS[ACQ_FIELDS.index("ltv") : ACQ_FIELDS.index("relocation_mortgage_indicator") + 1]


def _month(col: str) -> str:
    return f"try_cast(split_part({_nb(col)}, '/', 1) AS INTEGER)"


def _year(col: str) -> str:
    return f"try_cast(split_part({_nb(col)}, '/', 2) AS INTEGER)"


PARTS_CTE = (
    "parts AS (SELECT "
    + ", ".join(_HEAD)
    + f", {_month('origination_date')} AS origination_month, {_year('origination_date')} AS origination_year"
    + f", {_month('first_payment_date')} AS first_payment_month, {_year('first_payment_date')} AS first_payment_year, "
    + ", ".join(_TAIL)
    + " FROM acq)"
)

FILTERED_CTE = (
    "filtered AS (SELECT * FROM parts WHERE origination_year >= 2000 AND "
    f"({_nb('borrower_credit_score')} IS NOT NULL OR {_nb('co_borrower_credit_score')} IS NOT NULL))"
)

_LOAN_EXPRS = {
    "min_credit_score": (
        f"cast(least(coalesce(try_cast({_nb('borrower_credit_score')} AS INTEGER), 1000), "
        f"coalesce(try_cast({_nb('co_borrower_credit_score')} AS INTEGER), 1000)) AS INTEGER)"
    ),
    "mi": f"CASE WHEN try_cast({_nb('insurance_percentage')} AS INTEGER) > 0 THEN 1 ELSE 0 END",
}
LOANS_CTE = (
    "loans AS (SELECT " + ", ".join(f"{_LOAN_EXPRS[c]} AS {c}" if c in _LOAN_EXPRS else c for c in LOAN_FIELDS)
    + " FROM filtered)"
)

IDS_CTE = (
    "ids AS (SELECT DISTINCT try_cast(" + _nb("loan_id") + " AS BIGINT) AS f_loan_id FROM perf "
    f"WHERE {_nb('foreclosure_date')} IS NOT NULL AND try_cast({_nb('loan_id')} AS BIGINT) IS NOT NULL)"
)

LABELLED_CTE = (
    "labelled AS (SELECT l.*, i.f_loan_id, CASE WHEN i.f_loan_id IS NOT NULL THEN 1 ELSE 0 END AS is_foreclosed "
    f"FROM loans l LEFT JOIN ids i ON try_cast({_nb('l.loan_id')} AS BIGINT) = i.f_loan_id)"
)


def _double(col: str) -> str:
    return f"try_cast({_nb(f'cast({col} AS VARCHAR)')} AS DOUBLE)"


CASTED_CTE = (
    "casted AS (SELECT "
    + ", ".join(f"{_double(c)} AS {c}" if c in NUMERIC_FEATURES else c for c in LOAN_FIELDS + ["f_loan_id", "is_foreclosed"])
    + " FROM labelled)"
)


def _index_ctes(source: str, order: str, suffix: str, dtype: str) -> list[str]:
    ctes = []
    for c in CATEGORICAL_FEATURES:
        order_by = "n DESC, v" if order == "freq" else "v"
        ctes.append(
            f"idx_{c} AS (SELECT v, cast(row_number() OVER (ORDER BY {order_by}) - 1 AS {dtype}) AS {c}{suffix} "
            f"FROM (SELECT coalesce({c}, '') AS v, count(*) AS n FROM {source} GROUP BY 1))"
        )
    return ctes


def _index_join(source: str, suffix: str) -> str:
    cols = ", ".join(f"idx_{c}.{c}{suffix}" for c in CATEGORICAL_FEATURES)
    joins = " ".join(f"JOIN idx_{c} ON coalesce(s.{c}, '') = idx_{c}.v" for c in CATEGORICAL_FEATURES)
    return f"SELECT s.*, {cols} FROM {source} s {joins}"


INDEXED_CTES = _index_ctes("casted", "freq", "_index", "DOUBLE") + [f"indexed AS ({_index_join('casted', '_index')})"]
IMPUTED_CTE = (
    "imputed AS (SELECT *, "
    + ", ".join(f"coalesce({c}, avg({c}) OVER ()) AS out_{c}" for c in MODEL_FEATURES)
    + " FROM indexed)"
)


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


BASE = [ACQ_CTE, PERF_CTE]
LOANS = [ACQ_CTE, PARTS_CTE, FILTERED_CTE, LOANS_CTE]
LABELLED = [*LOANS, PERF_CTE, IDS_CTE, LABELLED_CTE]
MODEL = [*LABELLED, CASTED_CTE, *INDEXED_CTES, IMPUTED_CTE]

_PERF_ORDER = ", ".join(
    [f"try_strptime({_nb('reporting_date')}, '%m/%d/%Y') DESC NULLS LAST"]
    + [f"{c} DESC NULLS LAST" for c in PERF_FIELDS if c != "loan_id"]
)
_LATEST = _with(PERF_CTE) + (
    "SELECT " + ", ".join(PERF_FIELDS) + f" FROM (SELECT *, row_number() OVER (PARTITION BY loan_id ORDER BY {_PERF_ORDER}) AS rn "
    "FROM perf) WHERE rn = 1"
)

_SCORED = "scored AS (SELECT loan_id, is_foreclosed AS label, 1.0::DOUBLE - cast(min_credit_score AS DOUBLE) / 1000.0::DOUBLE AS score FROM labelled)"
_HIST = (
    "hist AS (SELECT round(score, 3) AS score, sum(CASE WHEN label > 0.5 THEN 1 ELSE 0 END) AS pos, "
    "sum(CASE WHEN label > 0.5 THEN 0 ELSE 1 END) AS neg FROM scored GROUP BY 1)"
)
_CURVE = (
    "curve AS (SELECT score AS threshold, "
    "cast(sum(pos) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS tp, "
    "cast(sum(neg) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS fp, "
    "(SELECT sum(pos) FROM hist) AS p_all, (SELECT sum(neg) FROM hist) AS n_all FROM hist)"
)


def _plot_imputed() -> str:
    numeric = [(src, dst) for src, dst in PLOT_COLUMNS if dst != "LoanPurpose"]
    cols = ", ".join(f"try_cast({_nb(src)} AS DOUBLE) AS {dst}" for src, dst in numeric)
    return f"plot AS (SELECT loan_id, {cols}, loan_purpose AS LoanPurpose FROM acq)"


_CORR_COLS = [f"out_{c}" for c in MODEL_FEATURES]

# --- fixed values: display labels of the 22 model inputs, in their order ---
_LABELS = [
    "Original Interest Rate",
    "Original Unpaid Principal Balance",
    "Original Loan Term",
    "Origination Month",
    "Origination Year",
    "First Payment Month",
    "First Payment Year",
    "Ltv",
    "Cltv",
    "Borrower Count",
    "Dti",
    "Min Credit Score",
    "Unit Count",
    "Mi",
    "Channel",
    "Seller Name",
    "First Time Homebuyer",
    "Loan Purpose",
    "Product Type",
    "Property Type",
    "Occupancy Status",
    "Relocation Mortgage Indicator",
]


def _correlation_sql() -> str:
    n = len(_CORR_COLS)
    aggs = [f"stddev_pop({c}) AS s{i}" for i, c in enumerate(_CORR_COLS)]
    aggs += [f"covar_pop({_CORR_COLS[i]}, {_CORR_COLS[j]}) AS c{i}_{j}" for i in range(n) for j in range(i)]
    agg_cte = "agg AS (SELECT " + ", ".join(aggs) + " FROM imputed)"
    parts = []
    for i in range(n):
        for j in range(i):
            a, b = _LABELS[i], _LABELS[j]
            r = f"CASE WHEN s{i} * s{j} = 0 THEN NULL ELSE c{i}_{j} / (s{i} * s{j}) END"
            parts.append(f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, {_r(r)} AS r FROM agg")
    return _with(*MODEL, agg_cte) + " UNION ALL ".join(parts)


def _z(c: str) -> str:
    x = f"out_{c}"
    return f"CASE WHEN stddev_samp({x}) OVER () = 0 THEN 0.0 ELSE ({x} - avg({x}) OVER ()) / stddev_samp({x}) OVER () END"


def _standardize_sql() -> str:
    return _with(*MODEL) + "SELECT loan_id, " + ", ".join(f"{_r(_z(c))} AS z_{c}" for c in MODEL_FEATURES) + " FROM imputed"


SCALED_CTE = "scaled AS (SELECT is_foreclosed, " + ", ".join(f"{_z(c)} AS z_{c}" for c in MODEL_FEATURES) + " FROM imputed)"


def _glm_moments_sql() -> str:
    n = len(MODEL_FEATURES)
    cells = [("n", "", "", "cast(count(*) AS DOUBLE)")]
    cells += [("mean", c, "", f"avg(z_{c})") for c in MODEL_FEATURES] + [("mean", "is_foreclosed", "", "avg(cast(is_foreclosed AS DOUBLE))")]
    cells += [("xx", MODEL_FEATURES[i], MODEL_FEATURES[j], f"sum(z_{MODEL_FEATURES[i]} * z_{MODEL_FEATURES[j]})") for i in range(n) for j in range(i + 1)]
    cells += [("xy", c, "is_foreclosed", f"sum(z_{c} * cast(is_foreclosed AS DOUBLE))") for c in MODEL_FEATURES]
    one = "one AS (SELECT " + ", ".join(f"{e} AS v{i}" for i, (_, _, _, e) in enumerate(cells)) + " FROM scaled)"
    parts = [f"SELECT '{m}' AS moment, '{a}' AS a, '{b}' AS b, {_r(f'v{i}', 4)} AS value FROM one" for i, (m, a, b, _) in enumerate(cells)]
    return _with(*MODEL, SCALED_CTE, one) + " UNION ALL ".join(parts)


# logistic score with the coefficients 1, -1/2, 1/3, ... over the standardized inputs
LINEAR_CTE = (
    "scored AS (SELECT label, round(1.0::DOUBLE / (1.0::DOUBLE + exp(-logit)), 6) AS score FROM (SELECT is_foreclosed AS label, 0.0::DOUBLE + "
    + " + ".join(f"({(-1) ** i}.0::DOUBLE / {i + 1}.0::DOUBLE) * round(z_{c}, 6)" for i, c in enumerate(MODEL_FEATURES))
    + " AS logit FROM scaled))"
)
LINEAR = [*MODEL, SCALED_CTE, LINEAR_CTE]
_EXACT_HIST = "hist AS (SELECT score, sum(label) AS pos, sum(1 - label) AS neg FROM scored GROUP BY 1)"
_BELOW = "c AS (SELECT pos, neg, sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - neg AS below FROM hist)"
_CONFUSION = (
    "SELECT cast(g.label AS INTEGER) AS label, cast(g.predicted AS INTEGER) AS predicted, count(s.score) AS n "
    "FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) AS g(label, predicted) "
    f"LEFT JOIN scored s ON s.label = g.label AND (CASE WHEN s.score > {CONFUSION_THRESHOLD}::DOUBLE THEN 1 ELSE 0 END) = g.predicted GROUP BY 1, 2"
)


def _split_expr(key: str = "loan_id") -> str:
    u = f"cast(('0x' || substr(md5({key} || ':11'), 1, 8))::UBIGINT AS DOUBLE) / 4294967296.0::DOUBLE"
    return f"CASE WHEN {u} < 0.7::DOUBLE THEN 'train' ELSE 'test' END"


def _grouped_ctes(group: str) -> list[str]:
    """``keyed`` (``yr``, the 22 inputs of each loan, the label) to ``gram``: population moments of the standardized inputs, one row a ``yr``.

    ``group`` is the SQL of ``yr`` over the loans joined to their orders.
    """
    n = len(MODEL_FEATURES)
    ctes = [
        f"keyed AS (SELECT {group} AS yr, c.* FROM casted c JOIN orders o ON try_cast(c.loan_id AS BIGINT) = o.o_orderkey)",
    ]
    for c in CATEGORICAL_FEATURES:
        ctes.append(
            f"idx_{c} AS (SELECT yr, v, cast(row_number() OVER (PARTITION BY yr ORDER BY n DESC, v) - 1 AS DOUBLE) AS {c}_index "
            f"FROM (SELECT yr, coalesce({c}, '') AS v, count(*) AS n FROM keyed GROUP BY 1, 2))"
        )
    joins = " ".join(f"JOIN idx_{c} ON k.yr = idx_{c}.yr AND coalesce(k.{c}, '') = idx_{c}.v" for c in CATEGORICAL_FEATURES)
    ctes.append("indexed AS (SELECT k.*, " + ", ".join(f"idx_{c}.{c}_index" for c in CATEGORICAL_FEATURES) + f" FROM keyed k {joins})")
    ctes.append(
        "filled AS (SELECT yr, loan_id, cast(is_foreclosed AS DOUBLE) AS y, "
        + ", ".join(f"coalesce({c}, avg({c}) OVER (PARTITION BY yr)) AS x{i}" for i, c in enumerate(MODEL_FEATURES))
        + " FROM indexed)"
    )
    std = lambda i: f"coalesce(stddev_samp(x{i}) OVER (PARTITION BY yr), 0)"
    ctes.append(
        "scaled AS MATERIALIZED (SELECT yr, loan_id, y, "
        + ", ".join(f"CASE WHEN {std(i)} = 0 THEN 0.0::DOUBLE ELSE (x{i} - avg(x{i}) OVER (PARTITION BY yr)) / {std(i)} END AS z{i}" for i in range(n))
        + " FROM filled)"
    )
    cov = ", ".join("[" + ", ".join(f"covar_pop(z{max(i, j)}, z{min(i, j)})" for j in range(n)) + "]" for i in range(n))
    ctes.append(
        f"gram AS MATERIALIZED (SELECT yr, cast(count(*) AS DOUBLE) AS n, [{cov}] AS cov, [" + ", ".join(f"avg(z{i})" for i in range(n)) + "] AS mean, "
        "[" + ", ".join(f"covar_pop(z{i}, y)" for i in range(n)) + "] AS cxy, avg(y) AS y, var_pop(y) AS vy FROM scaled GROUP BY yr)"
    )
    return ctes


_FLAT = "1e-12"


def _grouped_correlation_sql(group: str) -> str:
    pairs = [(i, j) for i in range(len(_LABELS)) for j in range(i)]
    rows = ", ".join(f"{{'a': '{_LABELS[i]}', 'b': '{_LABELS[j]}', 'i': {i + 1}, 'j': {j + 1}}}" for i, j in pairs)
    r = f"CASE WHEN cov[p.i][p.i] > {_FLAT} AND cov[p.j][p.j] > {_FLAT} THEN cov[p.i][p.j] / sqrt(cov[p.i][p.i] * cov[p.j][p.j]) END"
    return (
        _with(*LABELLED, CASTED_CTE, *_grouped_ctes(group))
        + f"SELECT yr AS year, p.a AS feature_a, p.b AS feature_b, {_r(r)} AS r FROM (SELECT *, unnest([{rows}]) AS p FROM gram)"
    )


def _grouped_hypotheses_sql(group: str, year: bool) -> str:
    """Ridge normal equations by Gauss-Jordan elimination with the identity alongside (a recursive step a pivot), the t tail by Simpson's rule."""
    n = len(MODEL_FEATURES)
    live = lambda i: f"cov[{i}][{i}] > {_FLAT}"
    penalty = f"{GLM_REG_PARAM}::DOUBLE / sqrt(vy)"
    cell = (
        f"CASE WHEN i = j THEN CASE WHEN {live('i')} THEN 1 + {penalty} ELSE 1.0 END "
        f"WHEN {live('i')} AND {live('j')} THEN cov[i][j] / sqrt(cov[i][i] * cov[j][j]) ELSE 0.0 END"
    )
    right = f"CASE WHEN {live('i')} THEN cxy[i] / sqrt(cov[i][i]) ELSE 0.0 END"
    at = f"range(1, {n + 1})"
    start = (
        f"list_transform({at}, lambda i : list_concat(list_transform({at}, lambda j : {cell}), "
        f"list_transform({at}, lambda j : CASE WHEN i = j THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), [{right}]))"
    )
    step = (
        "list_transform(m, lambda r, i : CASE WHEN i = k THEN list_transform(r, lambda x : x / r[k]) "
        "ELSE list_transform(r, lambda x, j : x - r[k] * m[k][j] / m[k][k]) END)"
    )
    names = ", ".join(f"'{x}'" for x in [*_LABELS, "Intercept"])
    density = "exp(lgamma((df + 1) / 2) - lgamma(df / 2) - 0.5 * ln(df * pi()) - (df + 1) / 2 * ln(1 + u * u / df))"
    weight = "CASE WHEN i = 0 OR i = 4000 THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END"
    simpson = f"list_sum(list_transform(range(0, 4001), lambda i : {weight} * {density.replace('u * u', '(i * abs(t) / 4000) * (i * abs(t) / 4000)')})) * abs(t) / 4000 / 3"
    ctes = [
        *LABELLED,
        CASTED_CTE,
        *_grouped_ctes(group),
        f"gj(yr, k, m) AS (SELECT yr, 1, {start} FROM gram WHERE vy > 0 UNION ALL SELECT yr, k + 1, {step} FROM gj WHERE k <= {n})",
        f"solved AS (SELECT g.*, list_transform({at}, lambda i : m[i][{2 * n + 1}] / sqrt(greatest(cov[i][i], {_FLAT}))) AS beta, "
        f"list_transform({at}, lambda i : m[i][{n} + i]) AS inv FROM gj JOIN gram g USING (yr) WHERE k = {n + 1})",
        "fitted AS (SELECT *, n * (vy - list_sum(list_transform(" + at + ", lambda i : beta[i] * (2 * cxy[i] - list_sum(list_transform(" + at
        + f", lambda j : cov[i][j] * beta[j])))))) / (n - {n} - 1) AS disp, n - {n} - 1 AS df FROM solved)",
        f"tested AS (SELECT yr, df, unnest(range(0, {n + 1})) AS position, [{names}] AS names, "
        f"list_append(beta, y - list_sum(list_transform({at}, lambda i : beta[i] * mean[i]))) AS coef, "
        f"list_append(list_transform({at}, lambda i : CASE WHEN {live('i')} THEN sqrt(disp * inv[i] / n) / sqrt(cov[i][i]) ELSE 'infinity'::DOUBLE END), sqrt(disp / n)) AS se FROM fitted)",
        "one AS (SELECT yr, df, cast(position AS INTEGER) AS position, names[position + 1] AS feature, coef[position + 1] AS coefficient, se[position + 1] AS std_error, "
        "CASE WHEN isinf(se[position + 1]) THEN 0.0::DOUBLE ELSE coef[position + 1] / se[position + 1] END AS t FROM tested)",
        f"tail AS (SELECT *, CASE WHEN t = 0 THEN 1.0::DOUBLE ELSE greatest(0, 1 - 2 * ({simpson})) END AS p FROM one)",
    ]
    with_ = "WITH RECURSIVE " + ",\n".join(ctes) + "\n"
    key = "yr AS year, " if year else ""
    return with_ + (
        f"SELECT {key}position, feature, {_r('coefficient')} AS coefficient, CASE WHEN isinf(std_error) THEN std_error ELSE {_r('std_error')} END AS std_error, "
        f"{_r('t', 4)} AS t, {_r('p')} AS p, {_r(f'p * {n}', 4)} AS p_bonferroni, {_r(f'least(p * {n}, 1)', 4)} AS p_bonferroni_capped FROM tail"
    )


def _logistic_ctes() -> list[str]:
    """Newton steps from zero: each round sums the Hessian and the gradient, then eliminates (a recursive step a pivot)."""
    n = len(MODEL_FEATURES) + 1
    x = [f"z{i}" for i in range(n - 1)] + ["1.0::DOUBLE"]
    ctes = [
        f"split AS MATERIALIZED (SELECT *, {_split_expr()} AS side FROM scaled)",
        f"b0 AS (SELECT DISTINCT yr, [{', '.join(['0.0::DOUBLE'] * n)}] AS b FROM split)",
    ]
    for r in range(NEWTON_ROUNDS):
        eta = " + ".join(f"{v} * b[{i + 1}]" for i, v in enumerate(x))
        ctes.append(f"p{r} AS MATERIALIZED (SELECT s.*, b, 1 / (1 + exp(-({eta}))) AS p FROM split s JOIN b{r} USING (yr) WHERE side = 'train')")
        reg = lambda i: f"{NEWTON_REG}::DOUBLE" if i < n - 1 else "0.0::DOUBLE"
        curve = lambda i: f"avg(p * (1 - p) * {x[i]} * {x[i]})"
        row = lambda i: ", ".join(
            [
                f"CASE WHEN {curve(i)} > {_FLAT} THEN {curve(i)} + {reg(i)} ELSE 1.0 END" if i == j else f"avg(p * (1 - p) * {x[max(i, j)]} * {x[min(i, j)]})"
                for j in range(n)
            ]
            + [f"avg((y - p) * {x[i]}) - {reg(i)} * any_value(b)[{i + 1}]"]
        )
        ctes.append(f"h{r} AS MATERIALIZED (SELECT yr, any_value(b) AS b, [" + ", ".join(f"[{row(i)}]" for i in range(n)) + f"] AS m FROM p{r} GROUP BY yr)")
        step = (
            "list_transform(m, lambda r, i : CASE WHEN i = k THEN list_transform(r, lambda x : x / r[k]) "
            "ELSE list_transform(r, lambda x, j : x - r[k] * m[k][j] / m[k][k]) END)"
        )
        ctes.append(f"e{r}(yr, b, k, m) AS (SELECT yr, b, 1, m FROM h{r} UNION ALL SELECT yr, b, k + 1, {step} FROM e{r} WHERE k <= {n})")
        ctes.append(f"b{r + 1} AS (SELECT yr, list_transform(range(1, {n + 1}), lambda i : b[i] + m[i][{n + 1}]) AS b FROM e{r} WHERE k = {n + 1})")
    return ctes


def _yearly_logistic_sql(metrics: bool) -> str:
    ctes = [*LABELLED, CASTED_CTE, *_grouped_ctes(_ORDER_YEAR), *_logistic_ctes()]
    with_ = "WITH RECURSIVE " + ",\n".join(ctes)
    if not metrics:
        names = ", ".join(f"'{v}'" for v in [*_LABELS, "Intercept"])
        n = len(_LABELS)
        return with_ + (
            f"\nSELECT yr AS year, cast(i AS INTEGER) AS position, [{names}][i + 1] AS feature, {_r('b[i + 1]')} AS coefficient "
            f"FROM (SELECT *, unnest(range(0, {n + 1})) AS i FROM b{NEWTON_ROUNDS})"
        )
    eta = " + ".join([f"z{i} * b[{i + 1}]" for i in range(len(MODEL_FEATURES))] + [f"b[{len(MODEL_FEATURES) + 1}]"])
    scored = f"scored AS (SELECT s.yr AS year, cast(y AS INTEGER) AS label, round(1 / (1 + exp(-({eta}))), 9) AS score FROM split s JOIN b{NEWTON_ROUNDS} USING (yr) WHERE side = 'test')"
    return with_ + f",\n{scored},\n{_YEAR_CURVE}\n" + _metrics_select(6)


def _metrics_select(digits: int) -> str:
    roc = "sum(neg * (tp + tp - pos) / 2) / (max(p_all) * max(n_all))"
    before = "CASE WHEN tp - pos + fp - neg > 0 THEN (tp - pos) / (tp - pos + fp - neg) ELSE tp / (tp + fp) END"
    pr = f"sum(pos * (tp / (tp + fp) + {before}) / 2) / max(p_all)"
    return (
        "SELECT year, unnest(['areaUnderROC', 'areaUnderPR', 'exactAUC', 'testRows']) AS metric, unnest([a, b, a, c]) AS value FROM ("
        f"SELECT year, {_r(roc, digits)} AS a, {_r(pr, digits)} AS b, cast(max(p_all) + max(n_all) AS DOUBLE) AS c FROM curve GROUP BY year)"
    )


NEWTON_ROUNDS, NEWTON_REG = 8, 0.001
_YEAR_SCORED = (
    "scored AS (SELECT cast(year(o.o_orderdate) AS INTEGER) AS year, is_foreclosed AS label, 1.0::DOUBLE - cast(min_credit_score AS DOUBLE) / 1000.0::DOUBLE AS score "
    "FROM labelled JOIN orders o ON try_cast(loan_id AS BIGINT) = o.o_orderkey)"
)
_DOWN = "OVER (PARTITION BY year ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
_YEAR_CURVE = (
    f"curve AS (SELECT *, cast(sum(pos) {_DOWN} AS BIGINT) AS tp, cast(sum(neg) {_DOWN} AS BIGINT) AS fp, "
    "sum(pos) OVER (PARTITION BY year) AS p_all, sum(neg) OVER (PARTITION BY year) AS n_all "
    "FROM (SELECT year, score, sum(label) AS pos, sum(1 - label) AS neg FROM scored GROUP BY 1, 2))"
)
_ORDER_YEAR = "cast(year(o.o_orderdate) AS INTEGER)"


def _yearly_rerun_sql() -> str:
    year = "try_cast(split_part(reporting_date, '/', 3) AS INTEGER)"
    early = IDS_CTE.replace("ids AS", "early AS", 1)[:-1] + f" AND {year} < 1998)"
    keyed = (
        "keyed AS (SELECT l.*, cast(year(o.o_orderdate) AS INTEGER) AS year, cast(l.loan_id AS BIGINT) AS id FROM loans l JOIN orders o ON cast(l.loan_id AS BIGINT) = o.o_orderkey), "
        "lab AS (SELECT k.*, CASE WHEN (CASE WHEN k.year = 2000 THEN i.f_loan_id ELSE e.f_loan_id END) IS NOT NULL THEN 1 ELSE 0 END AS y, "
        f"CASE WHEN 1.0::DOUBLE - cast(min_credit_score AS DOUBLE) / 1000.0::DOUBLE > {CONFUSION_THRESHOLD}::DOUBLE THEN 1 ELSE 0 END AS predicted, {_split_expr()} AS split "
        "FROM keyed k LEFT JOIN ids i ON k.id = i.f_loan_id LEFT JOIN early e ON k.id = e.f_loan_id)"
    )

    def part(name: str, item: str, positive: bool) -> str:
        n_foreclosed = "cast(sum(y) AS BIGINT)" if positive else "cast(0 AS BIGINT)"
        return f"SELECT '{name}' AS result, year, {item} AS item, count(*) AS n, {n_foreclosed} AS n_foreclosed FROM lab GROUP BY year, {item}"

    parts = [
        part("counts", "''", True),
        part("classes", "cast(y AS VARCHAR)", False),
        part("purposes", "loan_purpose", True),
        part("split", "split", True),
        part("confusion", "y || '|' || predicted", False),
    ]
    return _with(*LOANS, PERF_CTE, IDS_CTE, early, keyed) + " UNION ALL ".join(parts)


ORACLE_SQL: dict[str, str] = {
    "yearly_tables_rerun": _yearly_rerun_sql(),
    "yearly_correlation": _grouped_correlation_sql(_ORDER_YEAR),
    "yearly_hypotheses": _grouped_hypotheses_sql(_ORDER_YEAR, year=True),
    "hypothesis_table": _grouped_hypotheses_sql("0", year=False),
    "yearly_curves": _with(*LABELLED, _YEAR_SCORED, _YEAR_CURVE)
    + "SELECT year, score AS threshold, tp, fp, tp / p_all AS tpr, fp / n_all AS fpr, tp / (tp + fp) AS precision, tp / p_all AS recall FROM curve",
    "yearly_metrics": _with(*LABELLED, _YEAR_SCORED, _YEAR_CURVE)
    + _metrics_select(9),
    "yearly_logistic": _yearly_logistic_sql(metrics=False),
    "yearly_logistic_auc": _yearly_logistic_sql(metrics=True),
    "landing_manifest": _with(PERF_CTE)
    + "SELECT try_cast(split_part(reporting_date, '/', 3) AS INTEGER) AS reporting_year, count(*) AS n_rows, "
    "(SELECT count(*) FROM perf) AS manifest_rows, true AS files_ok FROM perf GROUP BY 1",
    "reconciled_lines": _with(ACQ_CTE)
    + "SELECT CASE right(loan_id, 1) WHEN '3' THEN 'wide' WHEN '7' THEN 'short' ELSE 'good' END AS verdict, loan_id, "
    "cast(CASE right(loan_id, 1) WHEN '3' THEN 28 WHEN '7' THEN 20 ELSE 26 END AS INTEGER) AS n_fields, "
    "(SELECT count(*) FROM acq) AS n_lines, (SELECT count(*) FROM acq WHERE right(loan_id, 1) NOT IN ('3', '7')) AS n_rows, "
    "(SELECT count(*) FROM acq WHERE right(loan_id, 1) IN ('3', '7')) AS n_rejected FROM acq",
    "parse_pipe_records": _with(ACQ_CTE)
    + "SELECT "
    + ", ".join(f"nullif({c}, '')" + f" AS {c}" if c != "unknownCol" else "NULL::VARCHAR AS unknownCol" for c in ACQ_FIELDS)
    + " FROM acq",
    "foreclosure_extract": _with(PERF_CTE)
    + f"SELECT {_nb('loan_id')} AS loan_id, trim(foreclosure_date) AS foreclosure_date FROM perf "
    f"WHERE {_nb('foreclosure_date')} IS NOT NULL",
    "legacy_foreclosure_ids": _with(PERF_CTE)
    + f"SELECT try_cast(trim(loan_id) AS BIGINT) AS f_loan_id, trim(foreclosure_date) AS foreclosure_date FROM perf "
    f"WHERE {_nb('foreclosure_date')} IS NOT NULL",
    "latest_entry": _LATEST,
    "latest_entry_window": _LATEST,
    "latest_entry_incremental": _LATEST,
    "month_year_parts": _with(ACQ_CTE, PARTS_CTE) + "SELECT * FROM parts",
    "year_credit_filter": _with(ACQ_CTE, PARTS_CTE, FILTERED_CTE) + "SELECT * FROM filtered",
    "engineered_features": _with(*LOANS) + "SELECT * FROM loans",
    "cast_numeric": _with(*LOANS)
    + "SELECT "
    + ", ".join(f"{_double(c)} AS {c}" if c in NUMERIC_FEATURES else c for c in LOAN_FIELDS)
    + " FROM loans",
    "blank_to_zero": _with(ACQ_CTE, PARTS_CTE)
    + "SELECT "
    + ", ".join(
        f"coalesce({c}, 0) AS {c}" if c.endswith(("_month", "_year")) else f"coalesce({_nb(c)}, '0') AS {c}"
        for c in _HEAD + ["origination_month", "origination_year", "first_payment_month", "first_payment_year"] + _TAIL
    )
    + " FROM parts",
    "drop_na_subset": _with(*LOANS)
    + "SELECT * FROM (SELECT "
    + ", ".join(f"{_double(c)} AS {c}" if c in NUMERIC_FEATURES else c for c in LOAN_FIELDS)
    + " FROM loans) WHERE "
    + " AND ".join(f"{c} IS NOT NULL AND NOT isnan({c})" for c in DROP_NA_SUBSET),
    "first_rows": _with(ACQ_CTE)
    + "SELECT loan_id, "
    + ", ".join(f"{src} AS {dst}" for src, dst in PLOT_COLUMNS)
    + " FROM acq ORDER BY try_cast(loan_id AS BIGINT) LIMIT 5",
    "label_join": _with(*LABELLED) + "SELECT * FROM labelled",
    "colocated_latest_entry": _LATEST,
    "colocated_label_join": _with(*LABELLED) + "SELECT * FROM labelled",
    "default_members": _with(*LABELLED) + "SELECT " + ", ".join(LOAN_FIELDS) + " FROM labelled WHERE f_loan_id IS NOT NULL",
    "non_default_members": _with(*LABELLED) + "SELECT " + ", ".join(LOAN_FIELDS) + " FROM labelled WHERE f_loan_id IS NULL",
    "default_count": _with(*LABELLED) + "SELECT count(*) AS n_loans, count(f_loan_id) AS n_foreclosed FROM labelled",
    "default_by_class": _with(*LABELLED) + "SELECT is_foreclosed, count(*) AS n FROM labelled GROUP BY is_foreclosed",
    "default_by_year": _with(*LABELLED)
    + "SELECT origination_year, count(*) AS n_loans, cast(sum(is_foreclosed) AS BIGINT) AS n_foreclosed, "
    "cast(sum(is_foreclosed) AS DOUBLE) / cast(count(*) AS DOUBLE) AS foreclosure_rate FROM labelled GROUP BY origination_year",
    "default_by_year_class": _with(*LABELLED)
    + "SELECT origination_year, is_foreclosed, count(*) AS n FROM labelled GROUP BY origination_year, is_foreclosed",
    "impute_mean": _with(*MODEL) + "SELECT loan_id, " + ", ".join(f"{_r('out_' + c)} AS out_{c}" for c in MODEL_FEATURES) + " FROM imputed",
    "impute_mean_plot": _with(ACQ_CTE, _plot_imputed())
    + "SELECT loan_id, "
    + ", ".join(
        f"{_r(f'coalesce({dst}, avg({dst}) OVER ())')} AS {dst}_imputed" for _, dst in PLOT_COLUMNS if dst != "LoanPurpose"
    )
    + ", LoanPurpose FROM plot",
    "string_index_freq": _with(*LABELLED, *_index_ctes("labelled", "freq", "_index", "DOUBLE"))
    + "SELECT loan_id, "
    + ", ".join(f"{c}_index" for c in CATEGORICAL_FEATURES)
    + f" FROM ({_index_join('labelled', '_index')})",
    "label_encode_alpha": _with(*LABELLED, *_index_ctes("labelled", "alpha", "_code", "INTEGER"))
    + "SELECT loan_id, "
    + ", ".join(f"{c}_code" for c in CATEGORICAL_FEATURES)
    + f" FROM ({_index_join('labelled', '_code')})",
    "standardize": _standardize_sql(),
    "correlation_long": _correlation_sql(),
    "hash_split": _with(*LABELLED) + f"SELECT loan_id, {_split_expr()} AS split FROM labelled",
    "roc_curve": _with(*LABELLED, _SCORED, _HIST, _CURVE)
    + "SELECT threshold, tp, fp, tp / p_all AS tpr, fp / n_all AS fpr FROM curve",
    "pr_curve": _with(*LABELLED, _SCORED, _HIST, _CURVE)
    + "SELECT threshold, tp, fp, tp / (tp + fp) AS precision, tp / p_all AS recall FROM curve",
    "exact_auc": _with(
        *LABELLED,
        _SCORED,
        "h AS (SELECT score, sum(CASE WHEN label > 0.5 THEN 1 ELSE 0 END) AS pos, "
        "sum(CASE WHEN label > 0.5 THEN 0 ELSE 1 END) AS neg FROM scored GROUP BY score)",
        "c AS (SELECT pos, neg, sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - neg AS below FROM h)",
    )
    + "SELECT cast(sum(pos) AS BIGINT) AS n_pos, cast(sum(neg) AS BIGINT) AS n_neg, "
    "sum(cast(pos AS DOUBLE) * (cast(below AS DOUBLE) + cast(neg AS DOUBLE) / 2)) / "
    "(cast(sum(pos) AS DOUBLE) * cast(sum(neg) AS DOUBLE)) AS auc FROM c",
    "confusion_at_threshold": _with(*LABELLED, _SCORED) + _CONFUSION,
    "linear_score_curve": _with(*LINEAR, _EXACT_HIST, _CURVE)
    + "SELECT threshold, tp, fp, tp / p_all AS tpr, fp / n_all AS fpr, tp / (tp + fp) AS precision, tp / p_all AS recall FROM curve",
    "linear_score_auc": _with(*LINEAR, _EXACT_HIST, _BELOW)
    + "SELECT cast(sum(pos) AS BIGINT) AS n_pos, cast(sum(neg) AS BIGINT) AS n_neg, "
    + _r("sum(cast(pos AS DOUBLE) * (cast(below AS DOUBLE) + cast(neg AS DOUBLE) / 2)) / (cast(sum(pos) AS DOUBLE) * cast(sum(neg) AS DOUBLE))", 9)
    + " AS auc FROM c",
    "linear_score_bounded_curve": _with(*LINEAR, _EXACT_HIST, _BELOW)
    + "SELECT cast(sum(pos) AS BIGINT) AS n_pos, cast(sum(neg) AS BIGINT) AS n_neg, "
    + _r("sum(cast(pos AS DOUBLE) * (cast(below AS DOUBLE) + cast(neg AS DOUBLE) / 2)) / (cast(sum(pos) AS DOUBLE) * cast(sum(neg) AS DOUBLE))", 9)
    + " AS auc, TRUE AS points_within, TRUE AS steps_within, TRUE AS area_within FROM c",
    "linear_score_confusion": _with(*LINEAR) + _CONFUSION,
    "glm_moments": _glm_moments_sql(),
    "bonferroni": _with(*LABELLED)
    + "SELECT \"column\", value, p, p * 8.0::DOUBLE AS p_bonferroni, least(p * 8.0::DOUBLE, 1.0::DOUBLE) AS p_bonferroni_capped FROM ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", coalesce({c}, '') AS value, cast(count(*) AS DOUBLE) / (SELECT cast(count(*) AS DOUBLE) FROM labelled) AS p FROM labelled GROUP BY 2"
        for c in CATEGORICAL_FEATURES
    )
    + ")",
    "model_test_counts": _with(*LABELLED)
    + f"SELECT {_split_expr()} AS split, count(*) AS n_rows, cast(sum(is_foreclosed) AS BIGINT) AS n_positive FROM labelled GROUP BY 1",
    "yearly_counts": _with(*LABELLED)
    + "SELECT cast(year(o_orderdate) AS INTEGER) AS year, count(*) AS n_loans, cast(sum(is_foreclosed) AS BIGINT) AS n_foreclosed, "
    "count(DISTINCT is_foreclosed) AS n_classes FROM labelled JOIN orders ON try_cast(loan_id AS BIGINT) = o_orderkey GROUP BY 1",
    "pipe_text_roundtrip": _with(ACQ_CTE)
    + "SELECT "
    + ", ".join(f"nullif({c}, '')" + f" AS {c}" if c != "unknownCol" else "NULL::VARCHAR AS unknownCol" for c in ACQ_FIELDS)
    + ", cast(year(o_orderdate) AS INTEGER) AS file_year FROM acq JOIN orders ON try_cast(loan_id AS BIGINT) = o_orderkey",
    "landed_performance": _with(PERF_CTE)
    + "SELECT "
    + ", ".join(f"nullif({c}, '') AS {c}" for c in PERF_FIELDS)
    + ", try_cast(split_part(reporting_date, '/', 3) AS INTEGER) AS reporting_year FROM perf",
    "latest_entry_struct": _LATEST,
    "scatter_bins": _with(
        ACQ_CTE,
        _plot_imputed(),
        "imp AS (SELECT LoanPurpose, coalesce(BorrowerCreditScore, avg(BorrowerCreditScore) OVER ()) AS s, "
        "coalesce(OriginalUnpaiPrincipalBalance, avg(OriginalUnpaiPrincipalBalance) OVER ()) AS b FROM plot)",
    )
    + "SELECT LoanPurpose AS loan_purpose, cast(floor(s / 10.0) * 10.0 AS DOUBLE) AS credit_score_bin, "
    "cast(floor(b / 10000.0) * 10000.0 AS DOUBLE) AS balance_bin, count(*) AS n FROM imp GROUP BY 1, 2, 3",
}
