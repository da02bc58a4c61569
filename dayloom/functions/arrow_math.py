"""Numpy steps that run inside Spark tasks, on batches Spark hands over.

The module is pickled by value, so executors need numpy and pandas but not this package.
"""
from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

ROWS_AT_ONCE = 2048


def moment_partials(replicates: int, columns: list[str], weights: str | None):
    """Per partition: weighted sums of products of ``[1, columns…]`` for every replicate.

    Weight codes are ``replicate * 2**32 + count``. Output is one row per replicate and slot of the
    upper triangle, whatever the number of input rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = len(columns) + 1
        rows, cols = np.triu_indices(width)
        total = None
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(start, ROWS_AT_ONCE)
                features = [batch.column(c).to_numpy(zero_copy_only=False).astype(np.float64) for c in columns]
                values = np.column_stack([np.ones(batch.num_rows), *features])
                products = values[:, rows] * values[:, cols]
                if weights is None:
                    part = products.sum(axis=0, keepdims=True)
                else:
                    part = _weight_matrix(batch.column(weights), replicates).T @ products
                total = part if total is None else total + part
        if total is not None:
            slots = total.shape[1]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(np.arange(replicates, dtype="int32"), slots)),
                    pa.array(np.tile(np.arange(slots, dtype="int32"), replicates)),
                    pa.array(total.reshape(-1)),
                ],
                names=["replicate", "slot", "value"],
            )

    return run


def _weight_matrix(codes: pa.Array, replicates: int) -> np.ndarray:
    lengths = np.nan_to_num(pc.list_value_length(codes).to_numpy(zero_copy_only=False)).astype(np.int64)
    flat = codes.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    at = np.repeat(np.arange(len(codes)), lengths) * replicates + (flat >> 32)
    summed = np.bincount(at, weights=(flat & 0xFFFFFFFF).astype(np.float64), minlength=len(codes) * replicates)
    return summed.reshape(len(codes), replicates)


def solve_moments(columns: list[str], scaled: list[bool], rcond: float = 1e-10):
    """Least squares from one replicate's moment sums; the last column is the target.

    Columns are centred, and the marked ones divided by their population deviation (1 if constant).
    The pseudo-inverse gives the minimum-norm solution when the design is rank-deficient, so the
    coefficient of a weekday absent from a replicate is 0.
    """

    def run(sums: pd.DataFrame) -> pd.DataFrame:
        width = len(columns) + 1
        upper = np.zeros((width, width))
        rows, cols = np.triu_indices(width)
        order = sums["slot"].to_numpy()
        upper[rows[order], cols[order]] = sums["value"].to_numpy()
        full = upper + np.triu(upper, 1).T
        n = full[0, 0]
        means = full[0, 1:] / n
        centred = full[1:, 1:] / n - np.outer(means, means)
        features = len(columns) - 1
        spread = np.sqrt(np.clip(np.diag(centred)[:features], 0.0, None))
        spread = np.where(np.asarray(scaled) & (spread > 1e-12), spread, 1.0)
        gram = centred[:features, :features] / np.outer(spread, spread)
        cross = centred[:features, features] / spread
        inverse = np.linalg.pinv(gram, rcond=rcond, hermitian=True)
        solution = inverse @ cross
        slopes = solution / spread
        intercept = means[features] - means[:features] @ slopes
        left = centred[features, features] - cross @ solution
        return pd.DataFrame(
            {
                "replicate": [int(sums["replicate"].iloc[0])],
                "n": [float(n)],
                "intercept": [float(intercept)],
                "slopes": [slopes.tolist()],
                "residual_sum": [float(max(left, 0.0) * n)],
                "inverse_diagonal": [(np.diag(inverse) / spread**2 / n).tolist()],
            }
        )

    return run


def interval_scorer(columns: list[str], intercepts: np.ndarray, slopes: np.ndarray, alpha: float):
    """Per row: percentile interval of the replicate predictions, linearly interpolated."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            values = batch[columns].to_numpy(dtype="float64")
            predictions = values @ slopes.T + intercepts
            low, high = np.percentile(predictions, [50 * alpha, 100 - 50 * alpha], axis=1)
            yield batch.drop(columns=columns).assign(lower_ci=low, upper_ci=high)

    return run
