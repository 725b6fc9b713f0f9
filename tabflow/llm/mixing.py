"""Mixing sources to target weights by pivotal dependent rounding.

``mix`` decides how many copies of every document the mixture takes so that
each source's words come near its target share.

1. Sizes (words) are counted once per document and cut; sources get weights
   (5, 2, 1, repeating, in code point order, null last) and a water-filled
   target: ``min(cap * size, lambda * weight)`` with ``lambda`` found by
   re-sharing the excess until no source is above its cap.
2. A document's wanted copies are ``target / source size``; its integral part is
   settled, its fractional part is a copy probability.
3. Pivotal rounding: two fractional documents of a source exchange mass
   (measured in words, so the sum ``copies * size`` never changes) in a random
   direction, with probabilities that keep each document's expectation, until
   one of them is integral. Groups of about ``bucket_rows`` documents of one
   source run this in parallel and pass on at most one fractional document;
   those residuals are combined ``fan_in`` groups at a time in a reduction tree
   of Spark shuffles. The last residual of a source is rounded at random, so a
   source misses its target by less than one document.

A hot source only has more groups. Random numbers are hashes of (seed, level,
ids), so a rerun or a retried task gives the same mixture.

Defined results: null or empty text has size 0 and takes 0 words; a null source is
a source of its own (last); repeated rows are separate documents; an empty table
gives an empty result; other columns of the input are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import col, cut, dense_index, fresh, stored, text_of, union_all, word_count

WEIGHTS = (5.0, 2.0, 1.0)  # fixed values: source weights in order, repeating
EPS = 1e-9


def source_targets(sizes: DataFrame, share: float = 1.5, cap: float = 2.0,
                   weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """``(source, sid, source_size, n_rows, target)`` from ``sizes(source, size)``; one row per source, cut."""
    by = sizes.groupBy("source").agg(F.sum("size").alias("source_size"),
                                     F.count_if(F.col("size") > 0).alias("n_rows"))
    table = dense_index(by, [F.col("source").asc_nulls_last()], "sid")
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("sid") % len(weights) + 1).cast("int"))
    table = cut(table.withColumn("w", w).withColumn("cap", F.col("source_size") * F.lit(float(cap))))
    total = table.agg(F.sum("source_size")).first()[0] or 0
    budget, lam = float(total) * share, 0.0
    # each round the sources above their cap are settled there and the rest shares what is left;
    # lambda only grows, so the loop ends after at most one round per source (in practice a few)
    frozen = -1
    while True:
        over = F.col("cap") <= F.col("w") * F.lit(lam)
        n, held, free = table.agg(F.count_if(over), F.sum(F.when(over, F.col("cap"))), F.sum(F.when(~over, F.col("w")))).first()
        if n == frozen or not free:
            break
        frozen, lam = n, max(lam, (budget - (held or 0.0)) / free)
    return table.select("source", "sid", "source_size", "n_rows",
                        F.least(F.col("cap"), F.col("w") * F.lit(lam)).alias("target"))


def _uniform(seed: int, level: int, key: np.ndarray, turn: int) -> np.ndarray:
    """Uniform numbers in [0, 1) from ids (splitmix64 steps): the same on every run."""
    with np.errstate(over="ignore"):
        x = key.astype(np.uint64) + np.uint64((seed * 1_000_003 + level * 7919 + turn * 104_729 + 1) & 0xFFFFFFFF) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) / float(1 << 53)


def pivot(p: np.ndarray, size: np.ndarray, key: np.ndarray, seed: int, level: int) -> np.ndarray:
    """Pivotal rounding of probabilities ``p`` with word sizes ``size``: at most one entry stays fractional.

    Neighbours are paired; each pair moves words from one to the other until one of
    the two is 0 or 1; survivors are paired again. ``sum(p * size)`` is preserved.
    """
    p = p.copy()
    live = np.flatnonzero((p > EPS) & (p < 1 - EPS))
    p[p <= EPS], p[p >= 1 - EPS] = 0.0, 1.0
    turn = 0
    while len(live) > 1:
        m = len(live) // 2 * 2
        i, j = live[0:m:2], live[1:m:2]
        a, b, s, t = p[i], p[j], size[i].astype(float), size[j].astype(float)
        up, down = np.minimum((1 - a) * s, b * t), np.minimum(a * s, (1 - b) * t)  # words into i, words out of i
        go_up = _uniform(seed, level, key[i] * np.int64(31) + key[j], turn) * (up + down) < down
        move = np.where(go_up, up, -down)
        p[i], p[j] = a + move / s, b - move / t
        # the binding side is integral by construction; rounding only removes the float dust
        snap = np.round(p[live])
        p[live] = np.where(np.abs(p[live] - snap) < EPS, snap, p[live])
        live = live[(p[live] > 0) & (p[live] < 1)]
        turn += 1
    return p


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        share: float = 1.5, cap: float = 2.0, weights: tuple[float, ...] = WEIGHTS, seed: int = 42,
        bucket_rows: int = 4096, fan_in: int = 64) -> DataFrame:
    """``(doc_id, source, size, source_size, target, copies, taken)``, one row per input row."""
    sized = cut(docs.select(col(id_col).alias("doc_id"), col(source_col).alias("source"),
                            word_count(text_of(text_col)).alias("size")))
    # one row per source, written so that Spark knows its size and broadcasts it or not
    targets = stored(source_targets(sized, share, cap, weights), "mix-targets")
    # null-safe join; the source table is small or shuffled, Spark picks by its size
    t = targets.withColumnRenamed("source", "src")
    x = F.try_divide(F.col("target"), F.col("source_size").cast("double"))
    rows = (sized.join(t, sized["source"].eqNullSafe(t["src"]), "left").drop("src")
            .withColumn("x", F.when(F.col("size") > 0, x).otherwise(F.lit(0.0)))
            .withColumn("base", F.floor(F.col("x") + F.lit(EPS)))
            .withColumn("p", F.greatest(F.col("x") - F.col("base"), F.lit(0.0)))
            .withColumn("key", F.xxhash64("doc_id", "size"))
            .withColumn("n_groups", F.ceil(F.col("n_rows") / bucket_rows))
            .withColumn("grp", F.pmod(F.col("key"), F.greatest(F.col("n_groups"), F.lit(1))))
            .select("doc_id", "source", "sid", "size", "source_size", "target", "base", "p", "key", "grp"))
    schema = rows.schema.simpleString()[len("struct<"):-1]

    def step(level: int, last: bool):
        def run(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values(["key", "size"], kind="stable", ignore_index=True)
            p = pivot(pdf["p"].to_numpy(), np.maximum(pdf["size"].to_numpy(), 1), pdf["key"].to_numpy(), seed, level)
            if last:  # at most one fractional document of the source is left
                u = _uniform(seed, level, pdf["key"].to_numpy(), 1_000_003)
                p = np.where((p > 0) & (p < 1), (u < p).astype(float), p)
            pdf["p"] = p
            return pdf
        return run

    n_groups = targets.agg(F.max(F.ceil(F.col("n_rows") / bucket_rows))).first()[0] or 1
    # rows without a fraction (size 0, or whole copies) need no partner and stay out of the groups
    open_ = (F.col("p") > EPS) & (F.col("p") < 1 - EPS)
    settled, level, current = [rows.where(~open_)], 0, rows.where(open_)
    while True:
        last = n_groups <= 1
        done = cut(current.groupBy("sid", "grp").applyInPandas(step(level, last), schema))
        if last:
            settled.append(done)
            break
        frac = (F.col("p") > 0) & (F.col("p") < 1)
        settled.append(done.where(~frac))
        current = done.where(frac).withColumn("grp", F.floor(F.col("grp") / fan_in))
        n_groups, level = -(-n_groups // fan_in), level + 1
    out = union_all(settled)
    copies = F.col("base") + F.round("p").cast("long")
    return out.select("doc_id", "source", "size", F.coalesce(F.col("source_size"), F.lit(0)).alias("source_size"),
                      F.coalesce(F.col("target"), F.lit(0.0)).alias("target"),
                      copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def take(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The mixture itself: the rows it takes, with every column as it was, plus ``copies`` and ``taken``.

    Rows with 0 copies go; identical rows become one with their copies added up. Clashing
    column names of the input win: ``copies`` and ``taken`` are then prefixed with ``_``.
    """
    row = F.struct(col(id_col).alias("id"), F.xxhash64(*[
        col(f.name) for f in docs.schema.fields if "map<" not in f.dataType.simpleString()]).alias("h"))
    key, n, words = fresh(docs, "row_key"), fresh(docs, "copies"), fresh(docs, "taken")
    keyed = docs.withColumn(key, row)
    plan = (mix(keyed, key, text_col, source_col, **options).groupBy("doc_id")
            .agg(F.sum("copies").alias(n), F.sum("taken").alias(words)).where(F.col(n) > 0))
    # the key of a row never is null itself, its id may be
    hid, hh = fresh(keyed, "plan_id"), fresh(keyed, "plan_hash")
    p = plan.select(F.col("doc_id.id").alias(hid), F.col("doc_id.h").alias(hh), n, words)
    same = (col(key)["h"] == col(hh)) & col(key)["id"].eqNullSafe(col(hid))
    joined = keyed.join(p, same)
    once = F.row_number().over(Window.partitionBy(col(hh), col(hid)).orderBy(F.lit(1)))
    rn = fresh(joined, "rn")
    return joined.withColumn(rn, once).where(F.col(rn) == 1).select(*[col(c) for c in docs.columns], n, words)
