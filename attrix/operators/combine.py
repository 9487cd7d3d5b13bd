"""Combining one-row results without a join (a join on a constant key is
planned as a cartesian product)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def one_row(*parts: DataFrame) -> DataFrame:
    """Side-by-side concatenation of one-row DataFrames: union them with
    the other parts' columns as NULL, then keep each column's value."""
    cols: list[str] = []
    types = {}
    for p in parts:
        for f in p.schema.fields:
            if f.name not in types:
                cols.append(f.name)
                types[f.name] = f.dataType
    padded = [
        p.select(*[F.col(c) if c in p.columns else F.lit(None).cast(types[c]).alias(c) for c in cols]) for p in parts
    ]
    u = padded[0]
    for p in padded[1:]:
        u = u.unionByName(p)
    return u.agg(*[F.first(c, ignorenulls=True).alias(c) for c in cols])
