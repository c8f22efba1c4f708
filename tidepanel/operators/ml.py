"""Walk-forward modelling: time splits with an embargo, training-only statistics, forests, scores and their evaluation."""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import stored
from .medians import exact_medians
from .simulation import auc


def split(date: Column, train_end: str, valid_end: str, embargo_days: int) -> Column:
    """train, valid or test by date; null inside the embargo that follows each border, whose labels overlap it."""
    day = lambda text, extra=0: F.date_add(F.lit(text).cast("date"), extra).cast("timestamp_ntz")
    return (
        F.when(date < day(train_end), "train")
        .when((date >= day(train_end, embargo_days)) & (date < day(valid_end)), "valid")
        .when(date >= day(valid_end, embargo_days), "test")
    )


def fit_statistics(train: DataFrame, columns: list[str]) -> dict[str, tuple[float, float, float]]:
    """Exact median, mean and deviation of each column over the training rows; a deviation of 0 or null counts as 1."""
    one = train.agg(*[x for c in columns for x in (F.avg(c).alias(f"{c}_mean"), F.stddev_samp(c).alias(f"{c}_sd"))]).first()
    each = train.select(F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("double").alias("v")) for c in columns])).alias("x")).select("x.c", "x.v")
    middle = {r["c"]: r["median"] for r in exact_medians(each, "v", ("c",)).collect()}  # a row per column; no task gets all values
    return {c: (middle.get(c) or 0.0, one[f"{c}_mean"] or 0.0, one[f"{c}_sd"] or 1.0) for c in columns}


def apply_statistics(df: DataFrame, statistics: dict[str, tuple[float, float, float]], limit: float = 10.0) -> DataFrame:
    """Nulls become the median; values are standardised and winsorised."""
    z = {c: F.least(F.greatest((F.coalesce(F.col(c).cast("double"), F.lit(med)) - mean) / sd, F.lit(-limit)), F.lit(limit)) for c, (med, mean, sd) in statistics.items()}
    return df.withColumns(z)


def fit_forest(train: DataFrame, columns: list[str], label: str, trees: int = 30, depth: int = 6, leaf: int = 50, seed: int = 1) -> RandomForestClassificationModel:
    forest = RandomForestClassifier(featuresCol="features", labelCol=label, numTrees=trees, maxDepth=depth, minInstancesPerNode=leaf, seed=seed)
    return forest.fit(VectorAssembler(inputCols=columns, outputCol="features").transform(train))


def score_forest(model: RandomForestClassificationModel, df: DataFrame, columns: list[str]) -> DataFrame:
    """df with the probability of label 1 as score."""
    scored = model.transform(VectorAssembler(inputCols=columns, outputCol="features").transform(df))
    return scored.withColumn("score", vector_to_array("probability")[1]).drop("features", "rawPrediction", "probability", "prediction")


def evaluate(scored: DataFrame, label: str, parts: list[str]) -> DataFrame:
    """Per split: rows, positives, base rate and AUC. Scores are made once."""
    scored, _ = stored(scored.select("split", "score", label), "scored")
    tables = [auc(scored.where(F.col("split") == p), "score", label).select(F.lit(p).alias("split"), "*") for p in parts]
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out.withColumn("base_rate", F.try_divide(F.col("n_positive").cast("double"), F.col("n")))
