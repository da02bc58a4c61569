"""Comparisons and choice models."""
from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NORMAL_975 = 1.959963984540054
_Z = NORMAL_975
# Terms of the expansion of a Student quantile in inverse powers of its freedom.
STUDENT_TERMS = (
    _Z,
    (_Z**3 + _Z) / 4,
    (5 * _Z**5 + 16 * _Z**3 + 3 * _Z) / 96,
    (3 * _Z**7 + 19 * _Z**5 + 17 * _Z**3 - 15 * _Z) / 384,
    (79 * _Z**9 + 776 * _Z**7 + 1482 * _Z**5 - 1920 * _Z**3 - 945 * _Z) / 92160,
)


def student_975(freedom: Column) -> Column:
    """The 0.975 quantile of Student's distribution: right to three digits from 4 degrees of freedom, to six from 20."""
    terms = [F.lit(t) * F.pow(freedom, F.lit(-float(i))) for i, t in enumerate(STUDENT_TERMS)]
    return reduce(lambda a, b: a + b, terms)


def difference_in_means(df: DataFrame, value: str, flag: Column) -> DataFrame:
    """Mean where the flag holds minus mean where it does not, with unequal-variance interval.

    One pass. Missing flags and values take no part. The interval uses Student's quantile at Welch's freedom; where neither group varies
    there is no freedom and the interval is the difference itself. A group of fewer than two values has no variance and no interval.
    """
    yes, no = F.when(flag, F.col(value)), F.when(~flag, F.col(value))
    stats = df.agg(
        F.count(yes).alias("n_yes"),
        F.count(no).alias("n_no"),
        F.avg(yes).alias("mean_yes"),
        F.avg(no).alias("mean_no"),
        F.var_samp(yes).alias("_vy"),
        F.var_samp(no).alias("_vn"),
    )
    vy, vn = F.try_divide("_vy", "n_yes"), F.try_divide("_vn", "n_no")
    difference, error = F.col("mean_yes") - F.col("mean_no"), F.sqrt(vy + vn)
    freedom = F.try_divide(
        (vy + vn) * (vy + vn), F.try_divide(vy * vy, F.col("n_yes") - 1) + F.try_divide(vn * vn, F.col("n_no") - 1)
    )
    half = F.when(error == 0, F.lit(0.0)).otherwise(error * student_975(freedom))
    return stats.select(
        "n_yes",
        "n_no",
        "mean_yes",
        "mean_no",
        difference.alias("difference"),
        error.alias("std_error"),
        freedom.alias("freedom"),
        (difference - half).alias("lower_ci"),
        (difference + half).alias("upper_ci"),
    )


def fit_logit(df: DataFrame, label: str, features: Sequence[str], max_iterations: int = 100):
    """Unregularised logistic regression of a flag; rows with a missing value take no part.

    Equal rows are merged into one with a weight, and kept while the optimiser passes over them. A fit that has not converged when its
    iterations run out raises.
    """
    rows = df.select(F.col(label).cast("double").alias("label"), *[F.col(c).cast("double").alias(c) for c in features])
    merged = rows.dropna().groupBy("label", *features).agg(F.count(F.lit(1)).cast("double").alias("weight"))
    table = VectorAssembler(inputCols=list(features), outputCol="features").transform(merged).persist()
    try:
        model = LogisticRegression(weightCol="weight", maxIter=max_iterations, tol=1e-7, regParam=0.0).fit(table)
        if model.summary.totalIterations >= max_iterations:
            raise RuntimeError(f"the fit did not converge in {max_iterations} iterations")
        return model
    finally:
        table.unpersist()


def logit_table(spark, model, features: Sequence[str]) -> DataFrame:
    rows = [("intercept", float(model.intercept))]
    rows += [(name, float(value)) for name, value in zip(features, model.coefficients)]
    return spark.createDataFrame(rows, "term string, coefficient double")
