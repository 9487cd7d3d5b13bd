"""Cleaning: identifier drop, blank-tolerant numeric casts, and the
three-step imputation of the total-charges column."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import to_number
from .ranking import scalar_quantiles


def drop_id(df: DataFrame, id_col: str = "customerID") -> DataFrame:
    return df.drop(id_col) if id_col in df.columns else df


def cast_numeric(df: DataFrame, cols) -> DataFrame:
    """Blank strings -> NULL -> double; non-numbers -> NULL. Columns that
    are already numeric keep their type."""
    out = []
    for f in df.schema.fields:
        if f.name in cols and isinstance(f.dataType, T.StringType):
            out.append(to_number(f.name).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def impute_totals(
    df: DataFrame,
    total: str = "TotalCharges",
    tenure: str = "tenure",
    monthly: str = "MonthlyCharges",
) -> DataFrame:
    """Only if any total is NULL: (1) every tenure=0 row gets 0, (2) NULL
    totals with tenure>0 get monthly*tenure, (3) what is still NULL gets
    the median of the column after steps 1-2.

    The condition and the median are scalars: they are fitted with one
    aggregate each (as ``Imputer`` does) and applied as literals, so the
    plan carries no cartesian product."""
    t, ten, mon = F.col(total), F.col(tenure), F.col(monthly)
    step1 = F.when(ten == 0, F.lit(0.0)).otherwise(t)
    step2 = F.when(step1.isNull() & (ten > 0), mon * ten).otherwise(step1)
    facts = df.agg(
        F.count_if(t.isNull()).alias("n_null"),
        F.count_if(step2.isNull()).alias("n_left"),
    ).first()
    if not facts["n_null"]:
        return df
    filled = df.withColumn(total, step2)
    if facts["n_left"]:
        (median,) = scalar_quantiles(filled, total, [0.5])
        filled = filled.withColumn(total, F.coalesce(F.col(total), F.lit(median)))
    return filled


def clean_table(
    df: DataFrame,
    id_col: str | None = "customerID",
    numeric_cols=("tenure", "MonthlyCharges", "TotalCharges"),
    total: str = "TotalCharges",
    tenure: str = "tenure",
    monthly: str = "MonthlyCharges",
) -> DataFrame:
    """The whole cleaner: drop the identifier (pass ``id_col=None`` to keep
    it as the scoring key), cast numerics, impute totals."""
    if id_col:
        df = drop_id(df, id_col)
    df = cast_numeric(df, [c for c in numeric_cols if c in df.columns])
    return impute_totals(df, total, tenure, monthly)
