"""Small column-expression helpers (F2-F12). All built-in functions, no UDFs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The substrings that mark an id-like column name.
ID_NAME_KEYWORDS = ["id", "_id", "index", "idx"]

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def is_numeric_type(dt: T.DataType) -> bool:
    return isinstance(dt, NUMERIC_TYPES)


def looks_like_id(name: str) -> bool:
    """lower-cased name contains any id keyword (a substring test: ``width`` matches)."""
    low = name.lower()
    return any(kw in low for kw in ID_NAME_KEYWORDS)


def qcol(name: str) -> Column:
    """A column by its exact name (dots and spaces are part of the name, not struct access)."""
    return F.col("`" + name.replace("`", "``") + "`")


def fresh(df: DataFrame, name: str) -> str:
    """A column name starting with ``name`` that ``df`` does not have (names compare without case)."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name = "_" + name
    return name


def finite(c: Column) -> Column:
    """NaN and +/-Inf become null."""
    return F.when(F.isnan(c) | (F.abs(c) == F.lit(float("inf"))), F.lit(None).cast("double")).otherwise(c)


def to_double(c: Column) -> Column:
    """numeric coercion, bad text becomes null."""
    return c.try_cast("double")


def strip(c: Column) -> Column:
    """Python-style ``str.strip()``: drop leading and trailing whitespace, newlines included."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def run_id(ts: Column, agent_id: Column) -> Column:
    """``run_<yyyyMMdd_HHmmss>_a<agent>``."""
    return F.concat(F.lit("run_"), F.date_format(ts, "yyyyMMdd_HHmmss"), F.lit("_a"), agent_id.cast("string"))


def run_id_ts(run: Column) -> Column:
    """F10 parsed back: the timestamp inside a run id."""
    return F.to_timestamp(F.regexp_extract(run, r"^run_(\d{8}_\d{6})_a\d+$", 1), "yyyyMMdd_HHmmss")


def day_string(ts: Column) -> Column:
    """calendar day of a timestamp as ``yyyy-MM-dd`` (session time zone, UTC)."""
    return F.date_format(F.to_date(ts), "yyyy-MM-dd")
