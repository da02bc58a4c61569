"""Bootstrap weights, refits and percentile intervals."""
from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayloom.fixed_values import BOOTSTRAP_REPLICATES, INTERVAL_ALPHA
from dayloom.functions.arrow_math import interval_scorer
from dayloom.functions.scalars import hash_text, hash_word
from dayloom.operators.ranking import hash_numbering
from dayloom.operators.regression import Design, encode, model_rows, solve_replicates

# Poisson(1) distribution function at 0, 1, 2, … in 2**-32 steps; beyond it the uniform has no step left.
POISSON_STEPS: list[int] = []
_mass = float(np.exp(-1.0))
_cumulative, _k = 0.0, 0
while True:
    _cumulative += _mass
    _step = int(_cumulative * 2**32)
    if _step >= 2**32 - 1:
        break
    POISSON_STEPS.append(_step)
    _k += 1
    _mass /= _k


def poisson_codes(key: Sequence[str], seed: int, replicates: int) -> Column:
    """Weight codes of one row for all replicates, from its key alone: no join, no shuffle.

    One md5 serves four replicates. Codes are ``replicate * 2**32 + weight``.
    """
    blocks = F.sequence(F.lit(0), F.lit((replicates - 1) // 4))
    texts = F.transform(blocks, lambda b: hash_text(seed, b, *[F.col(k) for k in key]))
    words = F.flatten(F.transform(texts, lambda t: F.array(*[hash_word(t, w) for w in range(4)])))

    def weight(u: Column) -> Column:
        return reduce(lambda a, b: a + b, [(u >= step).cast("bigint") for step in POISSON_STEPS])

    coded = F.transform(words, lambda u, i: i.cast("bigint") * F.lit(2**32) + weight(u))
    # A weight of 0 says nothing; more than a third of them are.
    return F.filter(F.slice(coded, 1, replicates), lambda c: c.bitwiseAND(F.lit(2**32 - 1)) > 0)


def multinomial_codes(rows: DataFrame, key: Sequence[str], seed: int, replicates: int) -> DataFrame:
    """Add ``_codes``: how often each row is drawn in each replicate of n draws with replacement.

    Every row makes one draw per replicate, addressed by position. Draws are counted per (position,
    replicate) before a row collects its own, so a row holds at most one code per replicate.
    """
    numbered = hash_numbering(rows, key, seed)
    # 60 bits of hash, so the remainder is even to 1 in 2**60 / n.
    draws = numbered.select(
        "total", F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(replicates - 1)),
                                          lambda r: hash_text(seed, r, *[F.col(k) for k in key]))).alias("replicate", "_h")
    ).select(
        (F.conv(F.substring("_h", 1, 15), 16, 10).cast("bigint") % F.col("total")).alias("position"), "replicate"
    )
    counts = draws.groupBy("position", "replicate").agg(F.count(F.lit(1)).alias("_n"))
    codes = counts.groupBy("position").agg(
        F.collect_list(F.col("replicate").cast("bigint") * F.lit(2**32) + F.col("_n")).alias("_codes")
    )
    return numbered.join(codes, "position", "left").drop("position", "total")


def with_weights(
    rows: DataFrame, key: Sequence[str], seed: int, replicates: int, method: str
) -> DataFrame:
    """``poisson``: independent weights from the row's key alone. ``multinomial``: n draws with replacement, which shuffles rows x
    replicates and suits small tables."""
    if method == "multinomial":
        return multinomial_codes(rows, key, seed, replicates)
    if method == "poisson":
        return rows.withColumn("_codes", poisson_codes(key, seed, replicates))
    raise ValueError("method must be 'multinomial' or 'poisson'")


def exploded(coded: DataFrame, *columns: str) -> DataFrame:
    """``columns`` and one code ``_c`` a row.

    An inner explode would have Spark filter on the size of the codes, and as they follow from the key alone, push that filter through
    joins and groups down to the raw rows, which would draw the codes of each key once for every raw row.
    """
    return coded.select(*columns, F.explode_outer("_codes").alias("_c")).where(F.col("_c").isNotNull())


def weight_table(df: DataFrame, key: Sequence[str], seed: int, replicates: int, method: str) -> DataFrame:
    """Replicate weights in long form, zeros left out."""
    coded = exploded(with_weights(df, key, seed, replicates, method), *key)
    return coded.select(
        *key,
        F.shiftright("_c", 32).cast("int").alias("replicate"),
        F.col("_c").bitwiseAND(F.lit(2**32 - 1)).alias("weight"),
    ).where(F.col("weight") > 0)


def bootstrap_means(
    df: DataFrame, value: str, key: Sequence[str], seed: int, replicates: int, method: str = "poisson"
) -> DataFrame:
    """Mean of ``value`` in each replicate."""
    rows = df.where(F.col(value).isNotNull())
    coded = exploded(with_weights(rows, key, seed, replicates, method), value)
    weight = F.col("_c").bitwiseAND(F.lit(2**32 - 1))
    return coded.groupBy(F.shiftright("_c", 32).cast("int").alias("replicate")).agg(
        (F.sum(F.col(value) * weight) / F.sum(weight)).alias("mean")
    )


def percentile_interval(means: DataFrame, value: str, alpha: float = INTERVAL_ALPHA) -> DataFrame:
    """Interval over replicate results; there are only as many of them as replicates."""
    ends = F.percentile(value, F.array(F.lit(alpha / 2), F.lit(1 - alpha / 2)))
    return means.agg(F.count(value).alias("replicates"), ends.alias("_e")).select(
        "replicates", F.element_at("_e", 1).alias("lower_ci"), F.element_at("_e", 2).alias("upper_ci")
    )


def prediction_intervals(
    df: DataFrame,
    key: Sequence[str],
    design: Design = Design(),
    replicates: int = BOOTSTRAP_REPLICATES,
    alpha: float = INTERVAL_ALPHA,
    seed: int = 123,
    method: str = "poisson",
    on_null: str = "error",
    keep: Sequence[str] = (),
    score: DataFrame | None = None,
) -> DataFrame:
    """Point prediction of the full fit and a percentile interval over refits, for every row fitted or, if given, of ``score``.

    A scored row without a feature has neither prediction nor interval; its target may be missing.

    Fitting needs one pass: each partition adds up products for all replicates at once, and the full
    fit is one more replicate in which every row has weight 1. Scoring is a second, shuffle-free pass
    that carries replicates x features coefficients.
    """
    rows = model_rows(df, design, on_null)
    once = F.array(F.lit(replicates * 2**32 + 1).cast("bigint"))
    weighted = with_weights(rows, key, seed, replicates, method).withColumn(
        "_codes", F.when(F.col("_codes").isNull(), once).otherwise(F.concat("_codes", once))
    )
    *refits, point = solve_replicates(weighted, design, replicates + 1, "_codes")
    names = list(design.columns())
    intercepts = np.array([m.intercept for m in refits])
    slopes = np.array([[m.slopes[name] for name in names] for m in refits])
    scored = encode(point.predict(rows if score is None else score), design).select(
        *key, *keep, design.target, "prediction", *[f"x_{name}" for name in names]
    )
    out = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in scored.schema.fields[: -len(names)])
    return scored.mapInPandas(
        interval_scorer([f"x_{name}" for name in names], intercepts, slopes, alpha),
        f"{out}, lower_ci double, upper_ci double",
    )


def recent_days(df: DataFrame, days: int = 7) -> DataFrame:
    """The last days of a table of one row a day, newest first."""
    return df.orderBy(F.col("date").desc()).limit(days)
