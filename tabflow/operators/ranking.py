"""Distributed ordered prefixes: running sums / maxima, global ranks and row indexes.

A Spark window with ``orderBy`` but no (or a skewed) ``partitionBy`` runs in
one task. Everything ordered in this package goes through the two-level form
below instead:

1. cut the order column into value-range buckets: numbers by approximate quantiles
   (``approxQuantile``: a small sketch per task), any other ordered type (text, dates, decimals)
   by the quantiles of a bounded, hash-chosen sample of its distinct values;
2. run the window inside ``(group, bucket)`` only, so a group holding a third
   of all rows is still spread over many tasks;
3. aggregate each bucket to one row, take the running value over the small
   bucket table, and join that offset back on ``(group, bucket)`` (null groups match).

Buckets are a pure function of the value, so every evaluation (retries,
re-planned stages, lost executors) assigns the same rows to the same bucket.
Their number is a parameter (``N_BUCKETS``), not a function of the shuffle partitions:
the sketch, the bucket lookup and the offsets table stay small on any cluster.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions.scalar import qcol

N_BUCKETS = 256
BUCKET_REL_ERR = 0.001
SAMPLE_PER_BUCKET = 16


def default_buckets(df: DataFrame) -> int:
    """The number of value ranges an ordered step is cut into."""
    return N_BUCKETS


def quantile_splits(df: DataFrame, cols: list[str], n_buckets: int) -> list[list[float]]:
    """Strictly increasing split points per numeric column, -inf and +inf at the ends (one pass)."""
    probs = [i / n_buckets for i in range(1, n_buckets)]
    rel = min(BUCKET_REL_ERR, 0.25 / n_buckets)
    qs = df.select(*[qcol(c).cast("double").alias(f"q{i}") for i, c in enumerate(cols)]).approxQuantile(
        [f"q{i}" for i in range(len(cols))], probs, rel)
    out = []
    for q in qs:
        inner = sorted({float(x) for x in (q or []) if x == x and abs(x) != float("inf")})
        out.append([float("-inf")] + (inner or [0.0]) + [float("inf")])  # Bucketizer needs 3+ points
    return out


def value_splits(df: DataFrame, col: str, n_buckets: int) -> list:
    """At most ``n_buckets - 1`` increasing values of any ordered type, from a bounded sample of distinct values."""
    rows = (df.select(qcol(col).alias("v")).where(F.col("v").isNotNull()).distinct()
            .orderBy(F.xxhash64("v"), "v").limit(n_buckets * SAMPLE_PER_BUCKET).orderBy("v").collect())
    step = max(1, len(rows) // n_buckets)
    return [r["v"] for r in rows[step::step]][:n_buckets - 1]


def _range_number(v: Column, splits: list, kind: T.DataType, base: int = 0) -> Column:
    """How many split points are at most ``v``: a balanced CASE tree (log2 comparisons a row)."""
    if not splits:
        return F.lit(base)
    mid = len(splits) // 2
    return F.when(v < F.lit(splits[mid]).cast(kind), _range_number(v, splits[:mid], kind, base)).otherwise(
        _range_number(v, splits[mid + 1:], kind, base + mid + 1))


def with_buckets(df: DataFrame, cols: list[str], out_cols: list[str], n_buckets: int | None = None) -> DataFrame:
    """Add an integer range-bucket column per order column (null and NaN go to bucket -1)."""
    n_buckets = n_buckets or default_buckets(df)
    # exact integers beyond 2^53 lose order neighbours as doubles only inside a bucket, never across buckets
    numeric = [isinstance(df.schema[c].dataType, T.NumericType) and not isinstance(df.schema[c].dataType, T.DecimalType)
               for c in cols]
    num = [(c, o) for c, o, y in zip(cols, out_cols, numeric) if y]
    res = df
    if num:
        splits = quantile_splits(df, [c for c, _ in num], n_buckets)
        tmp, tmpb = [f"__vd{i}" for i in range(len(num))], [f"__vb{i}" for i in range(len(num))]
        staged = df.select("*", *[qcol(c).cast("double").alias(t) for (c, _), t in zip(num, tmp)])
        res = Bucketizer(splitsArray=splits, inputCols=tmp, outputCols=tmpb, handleInvalid="keep").transform(staged)
        for (c, o), tb, sp in zip(num, tmpb, splits):
            res = res.withColumn(o, F.when(qcol(c).isNull() | (F.col(tb) >= len(sp) - 1), F.lit(-1))
                                 .otherwise(F.col(tb).cast("int")))
        res = res.drop(*tmp, *tmpb)
    for c, o, y in zip(cols, out_cols, numeric):
        if not y:
            n = min(n_buckets, 64)  # the CASE tree stays inside one generated method
            number = _range_number(qcol(c), value_splits(df, c, n), df.schema[c].dataType)
            res = res.withColumn(o, F.when(qcol(c).isNull(), F.lit(-1)).otherwise(number))
    return res


def running(
    df: DataFrame,
    order_col: str,
    value: Column | str,
    how: str = "sum",
    partition_cols: tuple[str, ...] | list[str] = (),
    exclusive: bool = True,
    out: str = "running",
    n_buckets: int | None = None,
    bucket_col: str | None = None,
) -> DataFrame:
    """Running ``sum`` or ``max`` of ``value`` in ``order_col`` order within ``partition_cols``.

    ``order_col`` must be unique inside each partition group (sequence numbers,
    or a table already grouped by the order value). With ``exclusive`` the
    current row is not included (null before the first row for ``max``,
    0 for ``sum``).
    """
    part = list(partition_cols)
    v = F.col(value) if isinstance(value, str) else value
    agg = {"sum": F.sum, "max": F.max}[how]
    b = bucket_col or "__bucket"
    staged = df.withColumn("__v", v)
    if bucket_col is None:
        staged = with_buckets(staged, [order_col], [b], n_buckets)

    frame = (Window.partitionBy(*part, b).orderBy(order_col)
             .rowsBetween(Window.unboundedPreceding, -1 if exclusive else 0))
    inner = staged.withColumn("__in", agg("__v").over(frame))

    # bucket totals: a second, column-pruned read with a map-side partial
    # aggregate (its shuffle is groups x buckets rows, not the input); the
    # big side is shuffled once, by (group, bucket), for the window and the join
    totals = staged.groupBy(*part, b).agg(agg("__v").alias("__bt"))
    before = Window.partitionBy(*part).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*part, b, agg("__bt").over(before).alias("__off"))

    keys = [*part, b]
    offsets = offsets.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], "__off")
    same = F.lit(True)
    for i, k in enumerate(keys):  # a null group has offsets like any other
        same = same & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    joined = inner.join(offsets, same, "left").drop(*[f"__k{i}" for i in range(len(keys))])
    if how == "sum":
        res = F.coalesce(F.col("__off"), F.lit(0)) + F.coalesce(F.col("__in"), F.lit(0))
    else:
        res = F.greatest(F.col("__off"), F.col("__in"))  # greatest skips nulls
    drop = ["__v", "__in", "__off"] + ([b] if bucket_col is None else [])
    return joined.withColumn(out, res).drop(*drop)


def row_index(df: DataFrame, order_col: str, out: str = "row_index", n_buckets: int | None = None) -> DataFrame:
    """0..n-1 in ``order_col`` order (unique key), without a single-task window."""
    return running(df, order_col, F.lit(1).cast("bigint"), "sum", (), True, out, n_buckets)


def value_ranks(df: DataFrame, col: str, n_buckets: int | None = None) -> DataFrame:
    """Per distinct non-null value: rows with a smaller value (``below``) and its count (``cnt``)."""
    # read three times below (quantiles, bucket totals, window), so settled once
    vc = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("cnt")).checkpoint()
    return running(vc, col, "cnt", "sum", (), True, "below", n_buckets)


def average_rank(df: DataFrame, col: str, out: str | None = None, pct: bool = True, n_buckets: int | None = None) -> DataFrame:
    """Average-tie rank (1-based), divided by the number of non-null rows when ``pct``.

    The per-value rank table is joined back on the value; a value holding a
    large share of rows is one row there, and AQE splits the skewed join side.
    """
    out = out or f"{col}_rank"
    ranks = value_ranks(df, col, n_buckets)
    r = F.col("below") + (F.col("cnt") + F.lit(1)) / F.lit(2.0)
    if pct:
        # scalar subquery: Spark runs it once and inlines the number (no cross join)
        n = df.where(F.col(col).isNotNull()).select(F.count(F.lit(1)).cast("double")).scalar()
        r = r / n
    table = ranks.select(F.lit(0).alias("__vn"), F.col(col).alias("__val"), r.alias(out))
    # null values match nothing: a salted non-zero flag spreads them over the join's partitions
    salt = F.when(F.col(col).isNull(), 1 + F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(1 << 20))).otherwise(F.lit(0))
    left = df.withColumn("__n", salt)
    return left.join(table, (F.col("__n") == F.col("__vn")) & (left[col] == table["__val"]), "left").drop("__val", "__vn", "__n")
