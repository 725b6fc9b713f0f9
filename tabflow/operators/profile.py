"""Column profile: roles, statistics, missingness, target balance.

Every statistic of every column comes from ONE aggregation over the table
(partial aggregates per task, a single tiny shuffle), and the one-row result is
unpivoted lazily into a long ``profile`` frame. The role rule is an expression
over that frame, so nothing but per-column summaries ever exists on the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions.scalar import finite, is_numeric_type, looks_like_id, qcol

# Role thresholds on the distinct count of a string column.
CATEGORICAL_MAX_DISTINCT = 50
ID_LIKE_MIN_DISTINCT = 1000

PROFILE_SCHEMA = (
    "column string, position int, role string, dtype string, n_unique bigint, mean double, "
    "std double, min double, max double, null_pct double, zeros_pct double"
)


def _kind(dt: T.DataType) -> str:
    if isinstance(dt, T.BooleanType) or is_numeric_type(dt):
        return "numeric"
    if isinstance(dt, T.StringType):
        return "string"
    if isinstance(dt, (T.ArrayType, T.MapType, T.StructType, T.BinaryType)):
        raise TypeError(f"cannot profile a column of type {dt.simpleString()}")
    return "other"  # dates, timestamps: high_cardinality (not castable to float)


def feature_columns(df: DataFrame, target: str | None = "target", exclude: tuple[str, ...] = ()) -> list[str]:
    return [c for c in df.columns if c != target and c not in exclude]


_RAW_SCHEMA = ("column string, position int, kind string, dtype string, n bigint, nn bigint, mean double, std double, "
               "min double, max double, zeros bigint, nd bigint")


def _distinct_counts(df: DataFrame, cols: list[str], idx: list[int]) -> dict[int, int]:
    """Exact distinct non-null values per column: (column, value) pairs are deduplicated map-side, then counted."""
    pairs = df.select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("i"), qcol(cols[i]).cast("string").alias("v")) for i in idx])))
    got = pairs.where(F.col("v").isNotNull()).distinct().groupBy("i").agg(F.count(F.lit(1)).alias("n")).collect()
    return {i: 0 for i in idx} | {r["i"]: r["n"] for r in got}  # one row per column


def _raw_stats(df: DataFrame, cols: list[str], fields: dict) -> list[tuple]:
    aggs: list[Column] = [F.count(F.lit(1)).alias("__n")]
    for i, c in enumerate(cols):
        x = qcol(c)
        aggs.append(F.count(x).alias(f"__nn{i}"))
        if _kind(fields[c]) == "numeric":
            v = x.cast("double")
            aggs += [F.avg(v).alias(f"__mean{i}"), F.stddev_samp(v).alias(f"__std{i}"),
                     F.min(v).alias(f"__min{i}"), F.max(v).alias(f"__max{i}"),
                     F.count_if(v == 0).alias(f"__z{i}")]
    row = df.agg(*aggs).first()  # one row of per-column summaries
    idx = [i for i, c in enumerate(cols) if _kind(fields[c]) != "numeric"]
    exact = _distinct_counts(df, cols, idx) if idx else {}
    out = []
    for i, c in enumerate(cols):
        kind = _kind(fields[c])
        num = kind == "numeric"
        out.append((c, i, kind, fields[c].simpleString(), row["__n"], row[f"__nn{i}"],
                    row[f"__mean{i}"] if num else None, row[f"__std{i}"] if num else None,
                    row[f"__min{i}"] if num else None, row[f"__max{i}"] if num else None,
                    row[f"__z{i}"] if num else None, exact.get(i)))
    return out


def profile(df: DataFrame, target: str | None = "target", exclude: tuple[str, ...] = (), round_stats: bool = True) -> DataFrame:
    """One row per feature column with role and statistics.

    Two scans: one aggregation for every statistic of every column, and one exact
    distinct count of the non-numeric columns, whatever their number of values.
    ``n_unique`` (nulls excluded) is reported for non-numeric columns, the
    ones whose role depends on it; numeric columns carry mean, sample std,
    min, max and zero share instead.
    """
    spark = df.sparkSession
    cols = feature_columns(df, target, exclude)
    fields = {f.name: f.dataType for f in df.schema.fields}
    raw = _raw_stats(df, cols, fields) if cols else []
    t = (spark.range(1).select(F.inline(F.array(*[F.struct(*[
             F.lit(v).cast(typ).alias(name) for v, (name, typ) in zip(r, _raw_fields())]) for r in raw])))
         if raw else spark.range(0).select(*[F.lit(None).cast(typ).alias(name) for name, typ in _raw_fields()]))

    n, nd = F.col("n"), F.col("nd")
    role = (F.when(F.col("kind") == "numeric", "numeric")
             .when((F.col("kind") == "string") & F.col("id_word") & (nd > ID_LIKE_MIN_DISTINCT), "id_like")
             .when((F.col("kind") == "string") & (nd <= CATEGORICAL_MAX_DISTINCT), "categorical")
             .otherwise("high_cardinality"))
    id_word = F.lit(False)
    for c in cols:
        if looks_like_id(c):
            id_word = id_word | (F.col("column") == c)

    def stat(name: str) -> Column:
        x = finite(F.col(name))
        return F.round(x, 4) if round_stats else x

    nulls = n - F.col("nn")
    null_pct = F.when(n > 0, nulls / n * 100)
    zeros_pct = F.when((n > 0) & (F.col("kind") == "numeric"), F.col("zeros") / n * 100)
    if round_stats:
        null_pct, zeros_pct = F.round(null_pct, 2), F.round(zeros_pct, 2)
    return t.withColumn("id_word", id_word).select(
        "column", "position", role.alias("role"), "dtype", nd.alias("n_unique"),
        stat("mean").alias("mean"), stat("std").alias("std"), stat("min").alias("min"), stat("max").alias("max"),
        null_pct.alias("null_pct"), zeros_pct.alias("zeros_pct"), nulls.alias("null_count"))


def _raw_fields() -> list[tuple[str, str]]:
    return [tuple(p.strip().split(" ")) for p in _RAW_SCHEMA.split(",")]


def roles(prof: DataFrame) -> dict[str, list[str]]:
    """The role lists (one small collect of the per-column profile)."""
    out: dict[str, list[str]] = {"numeric": [], "categorical": [], "high_cardinality": [], "id_like": []}
    for r in prof.select("column", "role", "position").orderBy("position").collect():
        out[r["role"]].append(r["column"])
    return out


def profile_table(prof: DataFrame) -> DataFrame:
    """The published profile columns (drops the helper null count)."""
    return prof.select("column", "position", "role", "dtype", "n_unique", "mean", "std", "min", "max",
                       "null_pct", "zeros_pct")


def missing_map(prof: DataFrame) -> DataFrame:
    """Only columns with at least one null (tests the count, not the rounded %)."""
    return prof.where(F.col("null_count") > 0).select("column", "null_pct")


def top_values(df: DataFrame, columns: list[str], k: int = 5) -> DataFrame:
    """A5/O2: the k most frequent non-null values per column; ties by value ascending.

    Call it on categorical columns (at most 50 distinct values each, proven by
    the role rule): the grouped frame then has at most 50 rows per column, so
    the per-column window is bounded whatever the table size.
    """
    if not columns:
        return df.sparkSession.createDataFrame([], "column string, value string, count bigint, rank int")
    longf = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), qcol(c).cast("string").alias("value")) for c in columns])))
    counts = longf.where(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count(F.lit(1)).alias("count"))
    w = Window.partitionBy("column").orderBy(F.col("count").desc(), F.col("value").asc())
    return counts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def target_distribution(df: DataFrame, target: str = "target") -> DataFrame:
    """Rows per class."""
    return df.groupBy(F.col(target).alias("target")).agg(F.count(F.lit(1)).alias("n"))


def imbalance(df: DataFrame, target: str = "target") -> DataFrame:
    """max/min class count, 2 decimals, only for exactly two classes (else null)."""
    d = target_distribution(df, target)
    return d.agg(
        F.count(F.lit(1)).alias("n_classes"),
        F.when(F.count(F.lit(1)) == 2, F.round(F.max("n") / F.min("n"), 2)).alias("imbalance_ratio"),
    )


FULL_SCHEMA = ("section string, item string, position int, label string, n bigint, mean double, std double, min double, "
               "max double, null_pct double, ratio double")


def full_profile(df: DataFrame, target: str = "target", top: int = 5) -> DataFrame:
    """A24 as one long table: the column rows, each categorical column's top values, the target's classes and the imbalance.

    ``section`` is ``column`` (label: role, n: distinct values), ``top_value`` (label: value, n: rows, position: rank),
    ``target`` (label: class, n: rows) or ``imbalance`` (n: classes, ratio).
    """
    prof = profile(df, target)
    empty = {f.split()[0]: F.lit(None).cast(f.split()[1]) for f in FULL_SCHEMA.split(", ")}

    def rows(frame: DataFrame, section: str, **cols: Column) -> DataFrame:
        have = {"section": F.lit(section), **cols}
        return frame.select(*[have.get(k, v).cast(frame.sparkSession.range(0).select(v.alias(k)).schema[k].dataType).alias(k)
                              for k, v in empty.items()])

    c = F.col
    classes = target_distribution(df, target)
    return (rows(prof, "column", item=c("column"), position=c("position"), label=c("role"), n=c("n_unique"), mean=c("mean"), std=c("std"),
                 min=c("min"), max=c("max"), null_pct=c("null_pct"))
            .unionByName(rows(top_values(df, roles(prof)["categorical"], top), "top_value", item=c("column"), position=c("rank"),
                              label=c("value"), n=c("count")))
            .unionByName(rows(classes, "target", item=F.lit(target), label=c("target").cast("string"), n=c("n")))
            .unionByName(rows(imbalance(df, target), "imbalance", item=F.lit(target), n=c("n_classes"), ratio=c("imbalance_ratio"))))


def key_sample(df: DataFrame, key: list[str], fraction: float, seed: str = "sample") -> DataFrame:
    """A stable sample by key hash (never ``limit``: that depends on scan order).

    A row is kept when the first 32 bits of ``md5("<seed>:<key>")`` fall under
    ``fraction * 2^32``: the same rows on any layout, and in any engine with md5.
    """
    h = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), *[F.col(k).cast("string") for k in key])), 1, 8), 16, 10)
    return df.where(h.cast("long") < F.lit(int(fraction * 2 ** 32)))


def write_profile(prof: DataFrame, path: str) -> None:
    """Profile sink (JSON lines); takes the column profile or the full one."""
    (prof if "section" in prof.columns else profile_table(prof)).write.mode("overwrite").json(path)


def read_profile(spark, path: str, schema: str = PROFILE_SCHEMA) -> DataFrame:
    """Re-read a saved profile with its declared schema (``FULL_SCHEMA`` for a full one; no inference)."""
    return spark.read.schema(schema).json(path)


def _num_text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit("None"))


def _names(prof: DataFrame, role: str, limit: int | None = None) -> Column:
    ordered = F.array_sort(F.collect_list(F.when(F.col("role") == role, F.struct("position", "column"))))
    names = F.transform(ordered, lambda s: s["column"])
    return F.slice(names, 1, limit) if limit else names


def report(prof: DataFrame, df: DataFrame, target: str = "target", max_names: int | None = None,
           max_stats: int | None = None) -> DataFrame:
    """The profile as report text, ``(line_no, line)``.

    ``max_names`` numeric names and ``max_stats`` lines of numeric statistics are shown (default: all).
    """
    counts = target_distribution(df, target)
    balance = counts.agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("target", "n"))),
                                 lambda s: F.concat(s["target"].cast("string"), F.lit(": "), s["n"].cast("string"))),
                     ", ").alias("dist"),
        F.when(F.count(F.lit(1)) == 2, F.round(F.max("n") / F.min("n"), 2)).alias("ratio"),
        F.sum("n").alias("n_rows"))
    summary = prof.agg(
        F.count(F.lit(1)).alias("n_features"),
        *[F.count_if(F.col("role") == r).alias(f"k_{r}") for r in ("numeric", "categorical", "high_cardinality", "id_like")],
        _names(prof, "numeric", max_names).alias("numeric"), _names(prof, "categorical").alias("categorical"),
        _names(prof, "high_cardinality").alias("high_cardinality"), _names(prof, "id_like").alias("id_like"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("null_count") > 0, F.struct(
            "position", F.concat(F.col("column"), F.lit(": "), F.col("null_pct").cast("string")).alias("t"))))),
            lambda s: s["t"]), ", ").alias("missing"))
    # the balance enters as one scalar subquery (a struct), so the table is counted once
    both = summary.withColumn("__b", balance.select(F.struct("dist", "ratio", "n_rows")).scalar()).select("*", "__b.*")

    def role_line(no: int, label: str, role: str, more: bool = False) -> Column:
        text = F.concat(F.lit(f"{label} ("), F.col(f"k_{role}").cast("string"), F.lit("): "),
                        F.array_join(F.col(role), ", "),
                        F.when(F.lit(more and max_names is not None) & (F.col(f"k_{role}") > F.lit(max_names or 0)), F.lit("...")).otherwise(F.lit("")))
        return F.struct(F.lit(no).alias("line_no"), F.when((F.col(f"k_{role}") > 0) | F.lit(role == "numeric"), text).alias("line"))

    head = both.select(F.inline(F.array(
        F.struct(F.lit(0).alias("line_no"), F.concat(F.lit("Size: ~"), F.format_number("n_rows", 0), F.lit(" rows x "),
                                                   F.col("n_features").cast("string"), F.lit(" features")).alias("line")),
        F.struct(F.lit(1).alias("line_no"), F.lit("Task: binary classification, target = 0/1").alias("line")),
        F.struct(F.lit(2).alias("line_no"), F.concat(F.lit("Class balance: {"), F.col("dist"), F.lit("} (imbalance: "),
                                                   _num_text(F.col("ratio")), F.lit(")")).alias("line")),
        F.struct(F.lit(3).alias("line_no"), F.lit("").alias("line")),
        F.struct(F.lit(4).alias("line_no"), F.lit("=== COLUMN TYPES ===").alias("line")),
        role_line(5, "Numeric", "numeric", True),
        role_line(6, "Categorical", "categorical"),
        role_line(7, "High cardinality", "high_cardinality"),
        role_line(8, "ID columns (dropped)", "id_like"),
        F.struct(F.lit(9).alias("line_no"), F.concat(F.lit("Missing: "), F.when(F.col("missing") == "", F.lit("none"))
                                                   .otherwise(F.concat(F.lit("{"), F.col("missing"), F.lit("}")))).alias("line")),
        F.struct(F.lit(10).alias("line_no"), F.lit("=== STATISTICS" + (f" (first {max_stats} numeric)" if max_stats else " (numeric)") + " ===").alias("line")),
    ))).where(F.col("line").isNotNull())
    nums = prof.where(F.col("role") == "numeric")
    w = Window.orderBy("position")  # over the numeric columns of one table: a handful of rows
    ranked = nums.withColumn("__r", F.row_number().over(w))
    stats = ((ranked.where(F.col("__r") <= max_stats) if max_stats else ranked).select(
        (F.lit(10) + F.col("__r")).alias("line_no"),
        F.concat(F.lit("  "), F.col("column"), F.lit(": mean="), _num_text(F.col("mean")), F.lit(", std="),
                 _num_text(F.col("std")), F.lit(", ["), _num_text(F.col("min")), F.lit(", "), _num_text(F.col("max")),
                 F.lit("]")).alias("line")))
    return head.unionByName(stats)
