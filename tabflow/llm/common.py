"""Helpers shared by the operators: table access, lineage cuts, text columns, ordering, components."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import checkpoint_dir, scratch_path

# The white space and the words of the text contracts (\x20 and \x09-\x0D).
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, read by Spark only (any path that Spark's readers can open)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the cluster's shared checkpoint folder and forget its lineage."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def fresh(df: DataFrame, name: str) -> str:
    """A column name starting with ``name`` that ``df`` does not have yet (names compare without case)."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name = "_" + name
    return name


def col(name: str) -> Column:
    """A column by its plain name (dots and spaces are part of the name)."""
    return F.col("`" + name.replace("`", "``") + "`")


def text_of(name: str = "text") -> Column:
    """The text column with null as the empty text."""
    return F.coalesce(col(name).cast("string"), F.lit(""))


def word_count(text: Column) -> Column:
    """Number of words (``WORD`` matches) of a text, as long."""
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def words_of(text: Column) -> Column:
    """The words of a text as an array (empty for a text without words)."""
    return F.filter(F.split(text, SPACE), lambda w: w != F.lit(""))


def dense_index(df: DataFrame, order: list[Column], out: str) -> DataFrame:
    """``df`` (materialised) with its 0-based position in ``order``; no single-task window.

    Rows are range-partitioned on the order columns and cut there, so the
    partition of a row is settled; each partition is numbered on its own and
    shifted by the rows before it (one number per partition on the driver).
    """
    pid = fresh(df, "pid")
    # nulls of an ordered column must sort the same way in both steps, hence the same expressions
    parts = cut(df.repartitionByRange(*order).withColumn(pid, F.spark_partition_id()))
    counts = sorted((r[0], r[1]) for r in parts.groupBy(pid).count().collect())
    before, rows = 0, []
    for p, n in counts:
        rows.append((p, before))
        before += n
    off = fresh(df, "off")
    offsets = df.sparkSession.createDataFrame(rows, f"`{pid}` int, `{off}` long")
    w = Window.partitionBy(pid).orderBy(*order)
    return (parts.withColumn(out, F.row_number().over(w).cast("long") - 1)
            .join(F.broadcast(offsets), pid)  # one row per range partition
            .withColumn(out, F.col(out) + F.col(off)).drop(pid, off))


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of ``links(a long, b long)``: ``(node, root)``, root the smallest reachable node.

    Alternating large-star and small-star rounds: every round replaces edges by
    edges to a smaller neighbour, so a hub of any degree is only ever reduced by
    ``min`` (combined map-side) and by equi-joins Spark can split. Each round is
    checkpointed; the loop ends when a round changes nothing. Empty links give an
    empty result.
    """
    edges = cut(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = _signature(edges)
    for _ in range(max_rounds):
        if seen[0] == 0:
            break
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low2 = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low2, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        edges = cut(small.unionByName(low2.select("a", F.col("m").alias("b"))).distinct())
        now = _signature(edges)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = edges.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def _signature(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")),
                  F.sum(F.xxhash64("b", "a").cast("decimal(38,0)"))).first()
    return tuple(r)


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def sum_or_zero(c: str) -> Column:
    return F.coalesce(F.sum(c), F.lit(0))


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a table in the cluster's shared folder and read back (a compact lineage cut)."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
