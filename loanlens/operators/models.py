"""Train/test split and the three classifiers.

The split is a per-row hash of the loan id and the seed, so a row's side
does not depend on partitioning or on retries (``randomSplit`` does).
The random forest is fitted on a frame with a fixed partition count and a
fixed order inside partitions, because its bootstrap sampling is seeded per
partition.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier, LogisticRegression, LogisticRegressionModel, RandomForestClassifier
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanlens.schemas import GBT_MAX_ITER, LR_MAX_ITER, SPLIT_SEED, SPLIT_WEIGHTS
from loanlens.session import scratch_folder

HASH_SPACE = 2**32
DEFAULT_SEED = 11


def split_fraction(key: Column | str, seed: int = SPLIT_SEED) -> Column:
    """Uniform value in [0, 1) from the first 32 bits of ``md5(key || ':' || seed)``."""
    k = F.col(key) if isinstance(key, str) else key
    digest = F.md5(F.concat(k.cast("string"), F.lit(f":{seed}")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") / F.lit(float(HASH_SPACE))


def hash_split_column(
    key: Column | str = "loan_id",
    weights: tuple[float, ...] = SPLIT_WEIGHTS,
    names: tuple[str, ...] = ("train", "test"),
    seed: int = SPLIT_SEED,
) -> Column:
    """Name of the split each row falls into, by cumulative normalized weight."""
    if len(names) < len(weights) or any(w < 0 for w in weights) or sum(weights) <= 0:
        raise ValueError("need one name per weight and non-negative weights with a positive sum")
    total = float(sum(weights))
    u = split_fraction(key, seed)
    edge = 0.0
    expr = None
    for w, name in list(zip(weights, names))[:-1]:
        edge += w / total
        expr = F.when(u < F.lit(edge), F.lit(name)) if expr is None else expr.when(u < F.lit(edge), F.lit(name))
    last = F.lit(names[len(weights) - 1])
    return last if expr is None else expr.otherwise(last)


def hash_split(
    df: DataFrame,
    key: str = "loan_id",
    weights: tuple[float, ...] = SPLIT_WEIGHTS,
    seed: int = SPLIT_SEED,
) -> tuple[DataFrame, DataFrame]:
    """Deterministic (train, test) frames: disjoint, complete, independent of partitioning."""
    tagged = df.withColumn("_split", hash_split_column(key, weights, seed=seed))
    return (
        tagged.where(F.col("_split") == "train").drop("_split"),
        tagged.where(F.col("_split") == "test").drop("_split"),
    )


def fit_logistic(train: DataFrame, features_col: str = "features", label_col: str = "label"):
    """Logistic regression, saved and read back: a fitted one holds its training summary, and that the session, which
    is sent to every task that scores and can't be once anything in the session has used an ``Observation``."""
    spark = train.sparkSession
    folder = scratch_folder(spark, "model")
    LogisticRegression(featuresCol=features_col, labelCol=label_col, maxIter=LR_MAX_ITER).fit(train).write().save(folder)
    return LogisticRegressionModel.read().session(spark).load(folder)


FOREST_PARTITIONS = 32  # of the forest's layout; raise it (for all runs alike) where a partition gets too large


def fit_forest(
    train: DataFrame,
    features_col: str = "features",
    label_col: str = "label",
    seed: int = DEFAULT_SEED,
    key: str | None = "loan_id",
    partitions: int = FOREST_PARTITIONS,
):
    """Random forest with default parameters and a fixed seed on a fixed layout.

    Rows are hash-partitioned by ``key`` into a fixed number of
    ``partitions`` and sorted inside each. The bootstrap samples, and the
    forest, are then a function of the training rows and that number alone,
    not of how many rows there are or how the input was split or configured.
    """
    data = train
    if key and key in train.columns:
        data = train.repartition(partitions, key).sortWithinPartitions(key)
    rf = RandomForestClassifier(featuresCol=features_col, labelCol=label_col, seed=seed)
    return rf.fit(data)


def fit_gbt(
    train: DataFrame,
    features_col: str = "features",
    label_col: str = "label",
    seed: int = DEFAULT_SEED,
):
    gbt = GBTClassifier(featuresCol=features_col, labelCol=label_col, maxIter=GBT_MAX_ITER, seed=seed)
    return gbt.fit(train)


MODEL_FITTERS = {
    "logistic_regression": fit_logistic,
    "random_forest": fit_forest,
    "gradient_boosted_trees": fit_gbt,
}
