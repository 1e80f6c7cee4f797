import math

import numpy as np

from loanlens.operators import features
from loanlens.operators.cleaning import cast_numeric
from loanlens.plans.jobs import labelled
from loanlens.schemas import CATEGORICAL_FEATURES, MODEL_FEATURES
from loanlens.sources import acquisition_records, performance_records


def _lab(spark, sf):
    return labelled(acquisition_records(spark, sf), performance_records(spark, sf))


def test_sql_forms_equal_ml_pipeline(spark, sf_small):
    lab = cast_numeric(_lab(spark, sf_small)).na.fill("", CATEGORICAL_FEATURES)
    mf = features.prepare_model_frame(_lab(spark, sf_small))
    assert mf.features == MODEL_FEATURES
    ml = features.ml_feature_pipeline().fit(lab).transform(lab)
    a = {r["loan_id"]: r for r in mf.df.select("loan_id", *[f"{c}_index" for c in CATEGORICAL_FEATURES],
                                                  *[f"out_{c}" for c in MODEL_FEATURES], "scaledFeatures").collect()}
    b = {r["loan_id"]: r for r in ml.select("loan_id", *[f"{c}_index" for c in CATEGORICAL_FEATURES],
                                              *[f"out_{c}" for c in MODEL_FEATURES], "scaledFeatures").collect()}
    assert a.keys() == b.keys()
    for k in a:
        for c in CATEGORICAL_FEATURES:
            assert a[k][f"{c}_index"] == b[k][f"{c}_index"], c
        for c in MODEL_FEATURES:
            assert math.isclose(a[k][f"out_{c}"], b[k][f"out_{c}"], rel_tol=1e-9, abs_tol=1e-9), c
        assert np.allclose(a[k]["scaledFeatures"].toArray(), b[k]["scaledFeatures"].toArray(), atol=1e-9)


def test_standardized_columns(spark, sf_small):
    mf = features.prepare_model_frame(_lab(spark, sf_small))
    pdf = mf.df.select(*[f"z_{c}" for c in mf.features]).toPandas()
    for c in mf.features:
        col = pdf[f"z_{c}"]
        if c == "product_type_index":  # constant in the fixture
            assert (col == 0).all()
        else:
            assert abs(col.mean()) < 1e-9 and abs(col.std(ddof=1) - 1) < 1e-9


def test_inline_and_join_index_paths_agree(spark, sf_small):
    lab = _lab(spark, sf_small)
    a = features.string_index(lab, CATEGORICAL_FEATURES)
    b = features.string_index(lab, CATEGORICAL_FEATURES, max_inline=0)
    cols = ["loan_id"] + [f"{c}_index" for c in CATEGORICAL_FEATURES]
    assert sorted(map(tuple, a.select(cols).collect())) == sorted(map(tuple, b.select(cols).collect()))


def test_frequency_ties_are_alphabetical_and_unseen_kept(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,)], "x string")
    got = {r["value"]: r["idx"] for r in features.category_index_table(df, ["x"]).collect()}
    assert got == {"c": 0, "": 1, "a": 2, "b": 3}
    other = spark.createDataFrame([("zz",)], "x string")
    for max_inline in (1000, 0):
        table = features.fit_index_table(df, ["x"], max_inline=max_inline)
        assert features.apply_index_table(other, table, ["x"]).first()["x_index"] == 4.0
    enc = {r["x"]: r["x_code"] for r in features.label_encode(df, ["x"]).collect()}
    assert enc == {None: 0, "a": 1, "b": 2, "c": 3}


def test_all_missing_column_is_dropped(spark):
    df = spark.createDataFrame([(1.0, None), (float("nan"), None), (3.0, None)], "a double, b double")
    moments = features.fit_moments(df, ["a", "b"])
    assert moments.usable(["a", "b"]) == ["a"]
    out = features.impute_mean(df, ["a", "b"]).collect()
    assert [r["out_a"] for r in out] == [1.0, 2.0, 3.0]
    assert "out_b" not in out[0].asDict()


def test_fit_index_table_paths_agree_with_window_form(spark, sf_small):
    lab = _lab(spark, sf_small)
    cols = CATEGORICAL_FEATURES + ["property_state", "loan_id"]  # loan_id: one value per row
    for order in (features.FREQUENCY_DESC, features.ALPHABET_ASC):
        ref = sorted(tuple(r) for r in features.category_index_table(lab, cols, order).select("column", "value", "n", "idx").collect())
        every = {}
        for max_inline in (100_000, 200, 0):  # 200: only loan_id is a table
            table = features.fit_index_table(lab, cols, order, max_inline=max_inline)
            every[max_inline] = sorted(tuple(r) for r in table.frame(spark).collect())
            assert set(table.large) == {100_000: set(), 200: {"loan_id"}, 0: set(cols)}[max_inline]
        assert ref == every[100_000] == every[200] == every[0]


def test_categories_are_not_trimmed(spark):
    df = spark.createDataFrame([("R",), ("R ",), ("R",)], "x string")
    assert {r["x"]: r["x_index"] for r in features.string_index(df, ["x"]).collect()} == {"R": 0.0, "R ": 1.0}


def test_a_hot_category_spreads_over_salts(spark):
    rows = [("hot", i) for i in range(400)] + [(f"v{i}", i) for i in range(100)]
    df = spark.createDataFrame(rows, "x string, i int")
    out = features.string_index(df, ["x"], max_inline=10).collect()
    assert len(out) == 500 and {r["x_index"] for r in out if r["x"] == "hot"} == {0.0}
    assert len({r["x_index"] for r in out}) == 101


def test_standardize_operator(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (None, 5.0), (5.0, 5.0)], "a double, b double")
    out = features.standardize(df, ["a", "b"]).collect()
    za = [r["z_a"] for r in out]
    assert all(r["z_b"] == 0.0 for r in out)  # constant column
    mean = sum(za) / len(za)
    std = (sum((z - mean) ** 2 for z in za) / (len(za) - 1)) ** 0.5
    assert abs(mean) < 1e-12 and abs(std - 1.0) < 1e-12
    assert abs(out[2]["z_a"]) < 1e-12  # the missing cell is imputed with the mean
