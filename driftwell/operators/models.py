"""A calibrated classifier: imputation, scaling and L2 logistic regression, split by time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import Imputer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .windows import ordered_cut


def with_indicators(df: DataFrame, numeric: Sequence[str], categories: dict[str, Sequence[str]] | None = None) -> DataFrame:
    """Columns as doubles with missing_<c>, and is_<c>_<value> for named category values."""
    out = df.withColumns({c: F.col(c).cast("double") for c in numeric}).withColumns({f"missing_{c}": F.col(c).isNull().cast("double") for c in numeric})
    for c, values in (categories or {}).items():
        out = out.withColumns({f"is_{c}_{v}": F.coalesce((F.col(c) == v).cast("double"), F.lit(0.0)) for v in values})
    return out


def temporal_split(df: DataFrame, match: str, ts: str, holdout: float = 0.25) -> tuple[DataFrame, DataFrame]:
    """The earlier matches to train on, the later ones to test on; no match is split."""
    return ordered_cut(df, match, [ts], 1 - holdout)


def fit_classifier(train: DataFrame, numeric: Sequence[str], label: str, categories: dict[str, Sequence[str]] | None = None, c: float = 1.0, iterations: int = 1000, tol: float = 1e-9) -> PipelineModel:
    """Medians and scales come from the training rows alone; regParam = 1 / (C n) gives the penalty of that C."""
    rows = with_indicators(train, numeric, categories).withColumn("label", F.col(label).cast("double"))
    n = rows.count()
    extra = [f"missing_{x}" for x in numeric] + [f"is_{x}_{v}" for x, values in (categories or {}).items() for v in values]
    filled = [f"filled_{x}" for x in numeric]
    steps = [
        Imputer(strategy="median", inputCols=list(numeric), outputCols=filled), VectorAssembler(inputCols=[*filled, *extra], outputCol="raw", handleInvalid="keep"),
        StandardScaler(inputCol="raw", outputCol="features", withMean=True, withStd=True),
        LogisticRegression(regParam=1.0 / (c * max(n, 1)), elasticNetParam=0.0, standardization=False, maxIter=iterations, tol=tol, labelCol="label", featuresCol="features"),
    ]
    return Pipeline(stages=steps).fit(rows)


def predict(model: PipelineModel, df: DataFrame, numeric: Sequence[str], label: str, categories: dict[str, Sequence[str]] | None = None, keep_features: bool = False) -> DataFrame:
    """df with probability and label (and the scaled features)."""
    rows = model.transform(with_indicators(df, numeric, categories).withColumn("label", F.col(label).cast("double")))
    rows = rows.withColumn("probability", vector_to_array("probability")[1]).drop("raw", "rawPrediction", "prediction")
    return rows if keep_features else rows.drop("features")


def base_rate(train: DataFrame, test: DataFrame, label: str) -> DataFrame:
    """test with the training rows' rate as everyone's probability."""
    p = train.agg(F.avg(F.col(label).cast("double")).alias("probability"))
    return test.crossJoin(F.broadcast(p)).withColumn("label", F.col(label).cast("double"))


def largest_gradient(model: PipelineModel, train: DataFrame, numeric: Sequence[str], label: str, categories: dict[str, Sequence[str]] | None = None) -> DataFrame:
    """The largest component of the penalised loss's gradient at the fitted weights, from one aggregate: largest, n.

    Near zero, no other weights fit the training rows better: the loss is convex.
    """
    fitted = model.stages[-1]
    rows = predict(model, train, numeric, label, categories, keep_features=True).select(vector_to_array("features").alias("x"), (F.col("probability") - F.col("label")).alias("e"))
    slopes = [F.avg(F.col("x")[j] * F.col("e")).alias(f"g{j}") for j in range(fitted.numFeatures)]
    sums = rows.agg(F.avg("e").alias("g"), F.count(F.lit(1)).alias("n"), *slopes)
    penalty = fitted.getRegParam()
    parts = [F.abs("g"), *(F.abs(F.col(f"g{j}") + F.lit(penalty * float(w))) for j, w in enumerate(fitted.coefficients))]
    return sums.select(F.greatest(*parts).alias("largest"), "n")
