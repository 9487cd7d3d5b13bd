"""Feature encoding as persistable Spark ML stages.

* one-hot with the first category dropped and unknown categories as all
  zeros (not ``StringIndexer(keep)`` + ``OneHotEncoder(dropLast)``, which
  drops the *unknown* slot instead), and
* standardisation with the *population* standard deviation (Spark's
  ``StandardScaler`` divides by the sample one),

both fitted with one aggregate each and applied as a ``SQLTransformer``
statement, so the fitted preprocessor is an ordinary ``PipelineModel``
(saved, loaded, streamed) whose work is codegen'd column expressions.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_CATEGORIES = 1000  # a column with more distinct values is not categorical


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _lit(v) -> str:
    if isinstance(v, str):
        return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return repr(v)


@dataclass
class Roles:
    numeric: list[str]
    categorical: list[str]
    key: str | None = "customerID"
    label: str = "Churn"


@dataclass
class FittedEncoding:
    roles: Roles
    categories: dict[str, list] = field(default_factory=dict)
    means: dict[str, float] = field(default_factory=dict)
    stds: dict[str, float] = field(default_factory=dict)
    scaled: bool = False

    def feature_names(self) -> list[str]:
        names = list(self.roles.numeric)
        for c in self.roles.categorical:
            names += [f"{c}_{v}" for v in self.categories[c][1:]]
        return names

    def statement(self) -> str:
        cols = []
        for c in self.roles.numeric:
            x = f"CAST({_q(c)} AS DOUBLE)"
            if self.scaled:
                sd = self.stds[c] or 1.0  # a constant column scales to 0, as sklearn does
                x = f"({x} - {self.means[c]!r}) / {sd!r}"
            cols.append(f"{x} AS {_q('f__' + c)}")
        for c in self.roles.categorical:
            for v in self.categories[c][1:]:
                cols.append(
                    f"CAST(coalesce(CAST({_q(c)} AS STRING) = {_lit(str(v))}, false) AS DOUBLE) AS {_q('f__' + c + '_' + str(v))}"
                )
        return "SELECT *, " + ", ".join(cols) + " FROM __THIS__"


def feature_roles(df: DataFrame, key: str | None, label: str, numeric_extra: Sequence[str] = ()) -> Roles:
    """Typed roles: numeric columns stay numeric (the reference one-hot
    encodes every engineered numeric); text columns are categorical."""
    from pyspark.sql import types as T

    num, cat = [], []
    for f in df.schema.fields:
        if f.name in (key, label, "split"):
            continue
        if isinstance(f.dataType, T.StringType):
            cat.append(f.name)
        elif isinstance(f.dataType, T.NumericType):
            num.append(f.name)
    for c in numeric_extra:
        if c not in num:
            num.append(c)
    return Roles(num, cat, key, label)


def fit_encoding(train: DataFrame, roles: Roles, scale: bool) -> FittedEncoding:
    """Sorted category lists (distinct values per column, one unpivoted
    aggregate; the domain size is checked) and population mean/std."""
    enc = FittedEncoding(roles=roles, scaled=scale)
    if roles.categorical:
        arr = F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in roles.categorical])
        pairs = train.select(F.inline(arr)).where(F.col("v").isNotNull()).distinct()
        # the domains come to the driver only after their size is checked
        sizes = {r["c"]: r["k"] for r in pairs.groupBy("c").agg(F.count(F.lit(1)).alias("k")).collect()}
        too_big = [c for c, k in sizes.items() if k > MAX_CATEGORIES]
        if too_big:
            raise ValueError(f"not categorical (>{MAX_CATEGORIES} values): {too_big}")
        cats: dict[str, list] = {c: [] for c in roles.categorical}
        for r in pairs.collect():
            cats[r["c"]].append(r["v"])
        enc.categories = {c: sorted(v) for c, v in cats.items()}
    if scale and roles.numeric:
        row = train.agg(
            *[F.avg(c).alias(f"m_{i}") for i, c in enumerate(roles.numeric)],
            *[F.stddev_pop(c).alias(f"s_{i}") for i, c in enumerate(roles.numeric)],
        ).first()
        enc.means = {c: float(row[f"m_{i}"] or 0.0) for i, c in enumerate(roles.numeric)}
        enc.stds = {c: float(row[f"s_{i}"] or 0.0) for i, c in enumerate(roles.numeric)}
    return enc


def preprocessor(enc: FittedEncoding, features_col: str = "features") -> PipelineModel:
    """The fitted encoding as a PipelineModel: SQL projection + assembler.
    (Both stages are stateless transformers, so ``fit`` only binds them.)"""
    cols = ["f__" + n for n in enc.feature_names()]
    sql = SQLTransformer(statement=enc.statement())
    asm = VectorAssembler(inputCols=cols, outputCol=features_col, handleInvalid="keep")
    return Pipeline(stages=[sql, asm]).fit(_empty_like(enc))


def _empty_like(enc: FittedEncoding):
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    fields = ", ".join([f"`{c}` double" for c in enc.roles.numeric] + [f"`{c}` string" for c in enc.roles.categorical])
    return spark.createDataFrame([], fields)


def encode(df: DataFrame, enc: FittedEncoding, features_col: str = "features") -> DataFrame:
    out = preprocessor(enc, features_col).transform(df)
    return out.drop(*["f__" + n for n in enc.feature_names()])
