"""Feature construction and user hooks.

Hooks are plain Python callables over DataFrames. Anything that must see a
statistic of the data is fitted (a pyspark.ml Estimator in the chain), never
computed per Arrow batch, because batch statistics differ between batches.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def select_features(df: DataFrame, wanted: list[str]) -> tuple[DataFrame, list[str]]:
    """Keep the wanted columns that exist; return the missing ones instead of printing them."""
    have = [c for c in wanted if c in df.columns]
    return df.select(*have), [c for c in wanted if c not in df.columns]


def drop_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    """Drop the target or id-like columns."""
    return df.drop(*cols)


def as_float(df: DataFrame, cols: list[str]) -> DataFrame:
    """Features as FLOAT, labels stay INT."""
    return df.withColumns({c: F.col(c).cast("float") for c in cols})


def ratio(df: DataFrame, a: str, b: str, out: str, eps: float = 1e-9) -> DataFrame:
    """P5: ``a / (b + eps)`` (same expression on every split)."""
    return df.withColumn(out, F.col(a) / (F.col(b) + F.lit(eps)))


def polynomial(df: DataFrame, cols: list[str], suffix: str = "_sq") -> DataFrame:
    """Append squares of the given columns."""
    return df.withColumns({f"{c}{suffix}": F.col(c) * F.col(c) for c in cols})


def apply_hook(df: DataFrame, hook: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """H1: one ``DataFrame -> DataFrame`` callable run once on the split-tagged union."""
    out = hook(df)
    if not isinstance(out, DataFrame):
        raise TypeError("build_features must return a DataFrame")
    return out


def rowwise_hook(df: DataFrame, fn: Callable, in_cols: list[str], out_schema: T.StructType | str,
                 keep: list[str] | None = None) -> DataFrame:
    """H2: a row-wise numpy/pandas function over Arrow batches (``mapInPandas``).

    ``fn(pandas.DataFrame[in_cols]) -> pandas.DataFrame`` must not use batch
    statistics; the ``keep`` columns (keys, split, target) ride along unchanged.
    """
    keep = keep or []

    def run(batches):
        for pdf in batches:
            res = fn(pdf[in_cols])
            for k in keep:
                res[k] = pdf[k].values
            yield res

    schema = out_schema if isinstance(out_schema, T.StructType) else T._parse_datatype_string(out_schema)
    fields = list(schema.fields) + [df.schema[k] for k in keep]
    return df.select(*in_cols, *keep).mapInPandas(run, T.StructType(fields))
