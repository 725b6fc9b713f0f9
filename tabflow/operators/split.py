"""Exact, reproducible stratified split by key.

Row order inside a class is ``md5("<seed>:<key>")`` (then the key), so the split
is a pure function of (seed, key, label): independent of partition count, file
order and cluster size. Finding each class's cut needs no global sort:

* the first ``HASH_HEX`` hex digits of the hash give ~1M buckets; rows are
  counted per (class, bucket) with map-side combine (a small table);
* running counts over that table locate, per class, the boundary bucket and
  how many of its rows still go to validation;
* only the rows of the boundary bucket (about n / 1M per class) are ordered; the
  last validation row among them is the class's cut (one row per class);
* the split itself is then a comparison with that cut: no join, window or
  shuffle, and one pass over the table for whoever reads the result.

Quotas follow the reference's library: ``n_val = ceil(test_size * n)``; each
class gets ``floor(n_c * n_train / n)`` training rows, left-over training rows
go to the largest remainders (ties: smaller label first); validation gets the
rest. A class with a single row cannot be stratified and raises.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.tables import literal_table
from pyspark.sql.window import Window

HASH_HEX = 5


def _key_text(df: DataFrame, k: str) -> Column:
    # floating keys get a fixed decimal text so every engine hashes the same characters
    if isinstance(df.schema[k].dataType, (T.FloatType, T.DoubleType)):
        return F.col(k).cast("decimal(38,10)").cast("string")
    return F.col(k).cast("string")


def split_hash(df: DataFrame, key: list[str], seed: int) -> Column:
    """``md5("<seed>:<k1>:<k2>...")`` over the key columns."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[_key_text(df, k) for k in key]))


def quotas(class_counts: dict, test_size: float) -> dict:
    """Validation rows per class (exact integer arithmetic)."""
    n = sum(class_counts.values())
    if n == 0:
        return {}
    small = [c for c, k in class_counts.items() if k < 2]
    if small:
        raise ValueError(f"the least populated class {small} has only 1 member; cannot stratify")
    ts = Fraction(str(test_size))
    n_val = -((-ts.numerator * n) // ts.denominator)  # ceil
    n_train = n - n_val
    if n_train < len(class_counts) or n_val < len(class_counts):
        raise ValueError("split sizes are smaller than the number of classes")
    labels = sorted(class_counts)
    floors = {c: class_counts[c] * n_train // n for c in labels}
    rems = {c: class_counts[c] * n_train % n for c in labels}
    left = n_train - sum(floors.values())
    for c in sorted(labels, key=lambda c: (-rems[c], c))[:left]:
        floors[c] += 1
    return {c: class_counts[c] - floors[c] for c in labels}


def stratified_split(
    df: DataFrame,
    key: str | list[str],
    target: str | None = "target",
    test_size: float = 0.2,
    seed: int = 42,
    out: str = "split",
    quota: dict | None = None,
) -> DataFrame:
    """``df`` plus a ``split`` column (``train``/``val``). Without a target the split is unstratified.

    ``quota`` gives the validation rows of every class (default: the exact share of ``test_size``).
    """
    key = [key] if isinstance(key, str) else list(key)
    spark = df.sparkSession
    cls = F.col(target) if target else F.lit(0)
    h = split_hash(df, key, seed)
    staged = df.withColumn("__cls", cls).withColumn("__h", h).withColumn(
        "__b", F.conv(F.substring("__h", 1, HASH_HEX), 16, 10).cast("long"))

    # (class, bucket) counts: at most ~1M rows per class; written once to the
    # shared checkpoint folder so the quota step and the final job reuse it
    bt = staged.groupBy("__cls", "__b").agg(F.count(F.lit(1)).alias("__bc")).checkpoint()
    counts = {r["__cls"]: r["n"] for r in bt.groupBy("__cls").agg(F.sum("__bc").alias("n")).collect()}
    if None in counts:
        raise ValueError("target has null labels")
    q = quotas(counts, test_size) if quota is None else quota
    cls_type = staged.schema["__cls"].dataType
    qdf = literal_table(spark, [(c, int(v)) for c, v in q.items()], ["__cls", "__q"]).select(
        F.col("__cls").cast(cls_type).alias("__cls"), F.col("__q").cast("long").alias("__q"))

    wb = Window.partitionBy("__cls").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    bound = (bt.withColumn("__start", F.coalesce(F.sum("__bc").over(wb), F.lit(0)))
               .join(F.broadcast(qdf), "__cls")
               .where((F.col("__start") < F.col("__q")) & (F.col("__q") <= F.col("__start") + F.col("__bc")))
               .select("__cls", F.col("__b").alias("__edge"), (F.col("__q") - F.col("__start")).alias("__need")))
    # ties on (hash, key) only happen for duplicate keys: the row's other orderable
    # columns break them, so even then the assignment is deterministic
    rest = [f.name for f in df.schema.fields
            if f.name not in key and not isinstance(f.dataType, (T.MapType, T.BinaryType))]
    order = ["__h", *key, *rest]
    # one row per class: broadcast is bounded by the number of labels
    near = staged.join(F.broadcast(bound), "__cls").where(F.col("__b") == F.col("__edge"))
    wr = Window.partitionBy("__cls").orderBy(*order)
    ties = Window.partitionBy("__cls", *order)  # identical rows (repeated rows) at the cut
    ranked = near.select("__cls", "__need", *order).withColumn("__rn", F.row_number().over(wr)).withColumns(
        {"__first": F.min("__rn").over(ties), "__last": F.max("__rn").over(ties)})
    cuts = ranked.where(F.col("__rn") == F.col("__need")).collect()  # one row per class
    types = {f.name: f.dataType for f in staged.schema.fields}

    def lit(row, c):
        return F.lit(row[c]).cast(types[c])

    is_val, same, keep = F.lit(False), F.lit(False), []
    for r in cuts:
        mine = F.col("__cls").eqNullSafe(lit(r, "__cls"))
        at = F.struct(*[F.col(c) for c in order])
        last = F.struct(*[lit(r, c).alias(c) for c in order])
        is_val = is_val | (mine & (at <= last))
        if r["__last"] > r["__rn"]:
            same = same | (mine & at.eqNullSafe(last))
            keep.append((r["__cls"], int(r["__rn"] - r["__first"] + 1)))
    res = staged.withColumn(out, F.when(is_val, "val").otherwise("train"))
    if keep:  # only then some of the identical rows are numbered to meet the quota exactly
        table = literal_table(spark, keep, ["__cls", "__keep"]).select(F.col("__cls").cast(cls_type).alias("__cls"), "__keep")
        extra = (res.where(same).join(F.broadcast(table), "__cls").withColumn("__rn", F.row_number().over(wr))
                 .withColumn(out, F.when(F.col("__rn") <= F.col("__keep"), "val").otherwise("train")))
        res = res.where(~same).unionByName(extra.select(*res.columns))
    return res.drop("__cls", "__h", "__b")


def split_counts(split_df: DataFrame, target: str = "target", by: str = "split") -> DataFrame:
    """Rows, feature columns, positives, negatives and positive rate per split."""
    t = F.col(target)
    n_columns = len([c for c in split_df.columns if c not in (target, by)])
    return split_df.groupBy(by).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(t == 1).alias("positives"),
        F.count_if(t == 0).alias("negatives"),
        F.avg(t.cast("double")).alias("positive_rate"),
    ).withColumn("n_columns", F.lit(n_columns))


def partition_check(full: DataFrame, split_df: DataFrame, key: str | list[str], by: str = "split") -> DataFrame:
    """Train and val partition the full table (by key): one row of counts, from one grouping by key."""
    key = [key] if isinstance(key, str) else list(key)
    tagged = full.select(*key, F.lit("full").alias("__in")).unionByName(split_df.select(*key, F.col(by).alias("__in")))
    n = {t: F.count_if(F.col("__in") == t) for t in ("full", "train", "val")}
    per_key = tagged.groupBy(*key).agg(*[c.alias(f"__{t}") for t, c in n.items()])
    both = F.col("__train") + F.col("__val")
    return per_key.agg(
        F.coalesce(F.sum("__full"), F.lit(0)).alias("n_full"), F.coalesce(F.sum("__train"), F.lit(0)).alias("n_train"),
        F.coalesce(F.sum("__val"), F.lit(0)).alias("n_val"),
        F.count_if((F.col("__train") > 0) & (F.col("__val") > 0)).alias("n_overlap"),
        F.coalesce(F.sum(F.greatest(F.col("__full") - both, F.lit(0))), F.lit(0)).alias("n_missing"),
        F.coalesce(F.sum(F.greatest(both - F.col("__full"), F.lit(0))), F.lit(0)).alias("n_extra"))


def rows_in_split(df: DataFrame, assignment: DataFrame, key: str | list[str], which: str = "val", by: str = "split") -> DataFrame:
    """Rows of ``df`` whose key is assigned to ``which`` (left semi join on a persisted assignment)."""
    key = [key] if isinstance(key, str) else list(key)
    return df.join(assignment.where(F.col(by) == which).select(*key), key, "left_semi")


def part(df: DataFrame, which: str, by: str = "split") -> DataFrame:
    """M8: the rows of one split of a (transformed) table, without the split column."""
    return df.where(F.col(by) == which).drop(by)


def save_assignment(split_df: DataFrame, key: str | list[str], path: str, by: str = "split") -> None:
    """Persist (key, split) once so every later job reads the same assignment."""
    key = [key] if isinstance(key, str) else list(key)
    split_df.select(*key, by).write.mode("ignore").partitionBy(by).parquet(path)
