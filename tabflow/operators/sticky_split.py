"""Sticky stratified split over a growing table.

``split.stratified_split`` is a pure function of the whole table: a new row moves its class's cut, so rows near it
change side. Here the assignment is a table of its own (a ``CommitLog`` of ``(key, class, split)``) and only ever
grows: an increment's keys that are not in it yet (a left anti join) are assigned, old keys keep their side.

Quotas are carried: after every increment each class holds as many validation rows as the exact quota of all its
rows so far, so the new rows of a class get the quota less what is already there (no more than there are new rows and no
fewer than none). Within a class the new rows are taken in hash order, through the same one-pass cut as the plain split.

An increment is one named batch: run again it changes nothing; rows that repeat inside an increment, or come back in
a later one, are assigned once. Null class labels are an error, as in the plain split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import qcol
from ..sources.commits import CommitLog
from .split import quotas, stratified_split


def assignment_log(spark, path: str, df: DataFrame, key: list[str], target: str) -> CommitLog:
    """The assignment table for rows like ``df``'s."""
    fields = [T.StructField(k, df.schema[k].dataType) for k in key]
    return CommitLog(spark, path, T.StructType([*fields, T.StructField("class", df.schema[target].dataType),
                                                T.StructField("split", T.StringType())]))


def _counts(log: DataFrame) -> tuple[dict, dict]:
    """Rows and validation rows per class (one row per class)."""
    rows = log.groupBy("class").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("split") == "val").alias("v")).collect()
    return {r["class"]: r["n"] for r in rows}, {r["class"]: r["v"] for r in rows}


def assign(log: CommitLog, df: DataFrame, key: list[str], batch: str, target: str = "target", test_size: float = 0.2, seed: int = 42) -> bool:
    """Add the new keys of ``df`` to the assignment; ``False`` if this batch was assigned before."""
    if batch in log.batches():
        return False
    known = log.read().select(*key)
    same = F.lit(True)
    old = known.select(*[qcol(k).alias(f"__o{i}") for i, k in enumerate(key)])
    for i, k in enumerate(key):  # a null part of a key is a value like any other
        same = same & qcol(k).eqNullSafe(F.col(f"__o{i}"))
    # one row per key, whatever its copies: the smallest label
    new = (df.select(*key, qcol(target).alias("class")).join(old, same, "left_anti")
           .groupBy(*key).agg(F.min("class").alias("class")).checkpoint())
    n_old, v_old = _counts(log.read())
    n_new = {r["class"]: r["n"] for r in new.groupBy("class").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not n_new:
        return log.append(new.withColumn("split", F.lit("train")), batch)
    if None in n_new:
        raise ValueError("target has null labels")
    total = {c: n_old.get(c, 0) + n_new.get(c, 0) for c in {*n_old, *n_new}}
    goal = quotas(total, test_size)
    share = {c: min(n, max(0, goal[c] - v_old.get(c, 0))) for c, n in n_new.items()}
    return log.append(stratified_split(new, key, "class", test_size, seed, quota=share), batch)


def with_split(df: DataFrame, log: CommitLog, key: list[str]) -> DataFrame:
    """``df`` with the split of its keys (null for keys that no increment held)."""
    table = log.read().select(*[qcol(k).alias(f"__k{i}") for i, k in enumerate(key)], "split")
    same = F.lit(True)
    for i, k in enumerate(key):
        same = same & qcol(k).eqNullSafe(F.col(f"__k{i}"))
    return df.join(table, same, "left").drop(*[f"__k{i}" for i in range(len(key))])
