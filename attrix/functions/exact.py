"""Exact p-values of two-sample tests, evaluated on the few rows that hold
their statistics (``mapInArrow`` over aggregated rows, never raw ones)."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ..session import ship

KS_LARGEST = 10_000  # sizes up to which the two-sample KS p-value is exact
U_SMALLEST = 8  # a group of at most this size makes the p-value of U exact


def ks_two_sided(n1: int, n0: int, d: float) -> float:
    """P(D >= d) for samples of n1 and n0 without ties: one minus the share
    of the lattice paths from (0, 0) to (n1, n0) that stay where
    |i / n1 - j / n0| < d. Rows of path counts are scaled as they grow."""
    g = math.gcd(n1, n0)
    a, b = n0 // g, n1 // g  # |i * a - j * b| in units of 1 / lcm
    h = round(d * a * b * g)  # d * lcm
    if h <= 0:
        return 1.0
    j = np.arange(n0 + 1, dtype=np.int64)
    paths = np.where(j * b < h, 1.0, 0.0)
    log = 0.0
    for i in range(1, n1 + 1):
        inside = np.abs(i * a - j * b) < h
        paths = np.cumsum(paths * inside) * inside
        top = paths.max()
        if top == 0:
            return 1.0
        if top > 1e200:
            paths /= top
            log += math.log(top)
    whole = math.lgamma(n1 + n0 + 1) - math.lgamma(n1 + 1) - math.lgamma(n0 + 1)
    if paths[-1] <= 0:
        return 1.0
    return float(min(1.0, max(0.0, -math.expm1(math.log(paths[-1]) + log - whole))))


def u_two_sided(n1: int, n0: int, u: float) -> float:
    """Twice P(U >= the larger of u and n1 * n0 - u), at most 1, without
    ties: the numbers of ways to reach each value of U are the coefficients
    of a Gaussian binomial, built a factor at a time, scaled by their sum."""
    small, large = min(n1, n0), max(n1, n0)
    ways = np.zeros(small * large + 1)
    ways[0] = 1.0
    for i in range(1, small + 1):
        up = large + i
        ways[up:] = ways[up:] - ways[: len(ways) - up] if up < len(ways) else ways[up:]  # times 1 - q^(large + i)
        for r in range(i):  # over 1 - q^i
            ways[r::i] = np.cumsum(ways[r::i])
    k = math.ceil(max(u, n1 * n0 - u))
    return float(min(1.0, 2 * ways[k:].sum() / ways.sum()))


def with_exact_p(tests: DataFrame) -> DataFrame:
    """Rows of rank tests (n1, n0, KS_Statistic, KS_PValue, MannWhitney_U,
    MannWhitney_PValue, ties) with exact p-values where sizes allow them:
    KS up to ``KS_LARGEST`` rows a group, U with a group of at most
    ``U_SMALLEST`` and no ties."""
    ship(tests.sparkSession)
    schema = T.StructType(tests.schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            for r in rows:
                n1, n0 = int(r["n1"] or 0), int(r["n0"] or 0)
                if not n1 or not n0:
                    continue
                if max(n1, n0) <= KS_LARGEST and r["KS_Statistic"] is not None:
                    r["KS_PValue"] = ks_two_sided(n1, n0, r["KS_Statistic"])
                if min(n1, n0) <= U_SMALLEST and not r["ties"] and r["MannWhitney_U"] is not None:
                    r["MannWhitney_PValue"] = u_two_sided(n1, n0, r["MannWhitney_U"])
            yield pa.RecordBatch.from_pylist(rows, schema=batch.schema)

    return tests.mapInArrow(run, schema)
