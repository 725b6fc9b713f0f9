"""Registered profile queries on the ``labelled`` fixture."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import profile as P
from ..operators import stats
from ..sources import fixtures as fx
from .registry import register
from .split_plans import SPLIT_CTES, labelled_split

# Column spec of the labelled view (name, kind, dtype) used to write the SQL twins.
LABELLED_SPEC = [
    ("key", "numeric", "bigint"), ("total_price", "numeric", "double"), ("acct_bal", "numeric", "double"),
    ("nation_key", "numeric", "int"), ("priority", "string", "string"), ("segment", "string", "string"),
    ("stock_code", "string", "string"), ("customer_id", "string", "string"),
]
_ID_WORDS = ("id", "_id", "index", "idx")


def _profile_sql(spec, table: str) -> str:
    aggs = ["count(*) AS n"]
    for i, (c, kind, _) in enumerate(spec):
        aggs.append(f"count({c}) AS nn{i}")
        if kind == "numeric":
            v = f"CAST({c} AS DOUBLE)"
            aggs += [f"avg({v}) AS mean{i}", f"stddev_samp({v}) AS std{i}", f"min({v}) AS min{i}",
                     f"max({v}) AS max{i}", f"count_if({v} = 0) AS z{i}"]
        else:
            aggs.append(f"count(DISTINCT {c}) AS nd{i}")
    parts = []
    for i, (c, kind, dtype) in enumerate(spec):
        if kind == "numeric":
            role, nd = "'numeric'", "CAST(NULL AS BIGINT)"
            st = [f"round(CASE WHEN isnan({s}{i}) OR isinf({s}{i}) THEN NULL ELSE {s}{i} END, 4)"
                  for s in ("mean", "std", "min", "max")]
            zeros = f"round(z{i} / n * 100, 2)"
        else:
            idl = "TRUE" if any(w in c.lower() for w in _ID_WORDS) else "FALSE"
            role = (f"CASE WHEN {idl} AND nd{i} > 1000 THEN 'id_like' WHEN nd{i} <= 50 THEN 'categorical' "
                    f"ELSE 'high_cardinality' END")
            nd = f"nd{i}"
            st = ["CAST(NULL AS DOUBLE)"] * 4
            zeros = "CAST(NULL AS DOUBLE)"
        parts.append(
            f"SELECT '{c}' AS \"column\", {i} AS position, {role} AS role, '{dtype}' AS dtype, {nd} AS n_unique, "
            f"{st[0]} AS mean, {st[1]} AS std, {st[2]} AS min, {st[3]} AS max, "
            f"round((n - nn{i}) / n * 100, 2) AS null_pct, {zeros} AS zeros_pct, n - nn{i} AS null_count FROM s")
    return f"s AS (SELECT {', '.join(aggs)} FROM {table}),\nprof AS (\n" + "\nUNION ALL\n".join(parts) + "\n)"


_PROFILE_CTE = _profile_sql(LABELLED_SPEC, "labelled")


def _with_profile(select: str) -> str:
    return fx.with_views("", "labelled").rstrip() + ",\n" + _PROFILE_CTE + "\n" + select


@register("column_profile", "A1 A2 A3 A4 A23 A24 F1 F3 F4 O3",
          _with_profile('SELECT "column", position, role, dtype, n_unique, mean, std, min, max, null_pct, zeros_pct FROM prof'))
def column_profile(spark, sf_dir):
    return P.profile_table(P.profile(fx.labelled(spark, sf_dir)))


@register("missing_map", "A12 A3",
          _with_profile('SELECT "column", null_pct FROM prof WHERE null_count > 0'))
def missing_map(spark, sf_dir):
    return P.missing_map(P.profile(fx.labelled(spark, sf_dir)))


@register("role_lists", "A23 O3",
          _with_profile('SELECT role, count(*) AS n_columns, string_agg("column", \',\' ORDER BY position) AS columns '
                        'FROM prof GROUP BY role'))
def role_lists(spark, sf_dir):
    prof = P.profile(fx.labelled(spark, sf_dir))
    return prof.groupBy("role").agg(
        F.count(F.lit(1)).alias("n_columns"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("position", "column"))), lambda s: s["column"]),
                     ",").alias("columns"))


def _top_values_sql(cols: list[str], k: int = 5) -> str:
    parts = [f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value, count(*) AS count FROM labelled "
             f"WHERE {c} IS NOT NULL GROUP BY {c}" for c in cols]
    body = "\nUNION ALL\n".join(parts)
    return fx.with_views(
        f'SELECT "column", value, count, rank FROM (SELECT "column", value, count, CAST(row_number() OVER '
        f'(PARTITION BY "column" ORDER BY count DESC, value ASC) AS INTEGER) AS rank FROM ({body}) t) r '
        f"WHERE rank <= {k}", "labelled")


@register("top_values", "A5 O2", _top_values_sql(["priority", "segment"]))
def top_values(spark, sf_dir):
    df = fx.labelled(spark, sf_dir)
    prof = P.profile(df)
    cats = P.roles(prof)["categorical"]  # at most 50 distinct values each: bounded windows
    return P.top_values(df, cats, 5)


@register("target_distribution", "A6 S5", fx.with_views(
    "SELECT target, count(*) AS n FROM labelled GROUP BY target", "labelled"))
def target_distribution(spark, sf_dir):
    df = fx.labelled(spark, sf_dir)
    from ..sources.tables import detect_target
    return P.target_distribution(df, detect_target(df))


@register("imbalance", "A7 A19", fx.with_views(
    "SELECT count(*) AS n_classes, CASE WHEN count(*) = 2 THEN round(max(n) / min(n), 2) END AS imbalance_ratio "
    "FROM (SELECT target, count(*) AS n FROM labelled GROUP BY target) d", "labelled"))
def imbalance(spark, sf_dir):
    return P.imbalance(fx.labelled(spark, sf_dir))


@register("row_count", "S3 S1", fx.with_views("SELECT count(*) AS n_rows FROM labelled", "labelled"))
def row_count(spark, sf_dir):
    return fx.labelled(spark, sf_dir).agg(F.count(F.lit(1)).alias("n_rows"))


@register("column_medians", "A10", fx.with_views(
    "SELECT 'total_price' AS \"column\", round(median(total_price), 6) AS median FROM labelled UNION ALL "
    "SELECT 'acct_bal', round(median(acct_bal), 6) FROM labelled UNION ALL "
    "SELECT 'nation_key', round(median(CAST(nation_key AS DOUBLE)), 6) FROM labelled", "labelled"))
def column_medians(spark, sf_dir):
    df = fx.labelled(spark, sf_dir)
    m = stats.exact_medians(df, ["total_price", "acct_bal", "nation_key"])
    return m.select("column", F.round("median", 6).alias("median"))


# ---------------------------------------------------------------- bench-size variant (lineitem)

LABELLED_BIG_SPEC = [
    ("l_orderkey", "numeric", "bigint"), ("l_linenumber", "numeric", "int"), ("l_partkey", "numeric", "bigint"),
    ("l_suppkey", "numeric", "bigint"), ("l_extendedprice", "numeric", "double"), ("l_quantity", "numeric", "double"),
    ("l_discount", "numeric", "double"), ("l_tax", "numeric", "double"), ("l_linestatus", "string", "string"),
]


@register("column_profile_big", "A1 A2 A3 A4 A23 A24", fx.with_views("", "labelled_big").rstrip() + ",\n"
          + _profile_sql(LABELLED_BIG_SPEC, "labelled_big")
          + '\nSELECT "column", position, role, dtype, n_unique, mean, std, min, max, null_pct, zeros_pct FROM prof')
def column_profile_big(spark, sf_dir):
    return P.profile_table(P.profile(fx.labelled_big(spark, sf_dir)))


_REPORT_SQL = """,
bal AS (SELECT string_agg(CAST(target AS VARCHAR) || ': ' || CAST(n AS VARCHAR), ', ' ORDER BY target) AS dist,
               CASE WHEN count(*) = 2 THEN round(max(n) / min(n), 2) END AS ratio, sum(n) AS n_rows
        FROM (SELECT target, count(*) AS n FROM labelled GROUP BY target) d),
pr AS (SELECT *, row_number() OVER (PARTITION BY role ORDER BY position) AS rn FROM prof),
sm AS (SELECT count(*) AS n_features,
              count_if(role = 'numeric') AS k_numeric, count_if(role = 'categorical') AS k_categorical,
              count_if(role = 'high_cardinality') AS k_high, count_if(role = 'id_like') AS k_id,
              coalesce(string_agg("column", ', ' ORDER BY position) FILTER (WHERE role = 'numeric' AND rn <= 20), '') AS numeric,
              string_agg("column", ', ' ORDER BY position) FILTER (WHERE role = 'categorical') AS categorical,
              string_agg("column", ', ' ORDER BY position) FILTER (WHERE role = 'high_cardinality') AS high,
              string_agg("column", ', ' ORDER BY position) FILTER (WHERE role = 'id_like') AS idl,
              string_agg("column" || ': ' || CAST(null_pct AS VARCHAR), ', ' ORDER BY position) FILTER (WHERE null_count > 0) AS missing
       FROM pr),
lines AS (
  SELECT 0 AS line_no, 'Size: ~' || format('{:,}', n_rows) || ' rows x ' || CAST(n_features AS VARCHAR) || ' features' AS line FROM sm, bal
  UNION ALL SELECT 1, 'Task: binary classification, target = 0/1'
  UNION ALL SELECT 2, 'Class balance: {' || dist || '} (imbalance: ' || coalesce(CAST(ratio AS VARCHAR), 'None') || ')' FROM bal
  UNION ALL SELECT 3, ''
  UNION ALL SELECT 4, '=== COLUMN TYPES ==='
  UNION ALL SELECT 5, 'Numeric (' || CAST(k_numeric AS VARCHAR) || '): ' || numeric || CASE WHEN k_numeric > 20 THEN '...' ELSE '' END FROM sm
  UNION ALL SELECT 6, 'Categorical (' || CAST(k_categorical AS VARCHAR) || '): ' || categorical FROM sm WHERE k_categorical > 0
  UNION ALL SELECT 7, 'High cardinality (' || CAST(k_high AS VARCHAR) || '): ' || high FROM sm WHERE k_high > 0
  UNION ALL SELECT 8, 'ID columns (dropped) (' || CAST(k_id AS VARCHAR) || '): ' || idl FROM sm WHERE k_id > 0
  UNION ALL SELECT 9, 'Missing: ' || CASE WHEN missing IS NULL THEN 'none' ELSE '{' || missing || '}' END FROM sm
  UNION ALL SELECT 10, '=== STATISTICS (first 15 numeric) ==='
  UNION ALL SELECT CAST(10 + rn AS INTEGER), '  ' || "column" || ': mean=' || coalesce(CAST(mean AS VARCHAR), 'None')
         || ', std=' || coalesce(CAST(std AS VARCHAR), 'None') || ', [' || coalesce(CAST(min AS VARCHAR), 'None')
         || ', ' || coalesce(CAST(max AS VARCHAR), 'None') || ']' FROM pr WHERE role = 'numeric' AND rn <= 15
)
SELECT line_no, line FROM lines"""


@register("profile_report", "S14 O3 F8", fx.with_views("", "labelled").rstrip() + ",\n" + _PROFILE_CTE + _REPORT_SQL)
def profile_report(spark, sf_dir):
    df = fx.labelled(spark, sf_dir)
    return P.report(P.profile(df), df, max_names=20, max_stats=15)


@register("freq_encode_all_rows", "A9 M4", fx.with_views("", "labelled").rstrip() + "," + SPLIT_CTES
          + ", fr AS (SELECT stock_code AS v, count(*) / (SELECT count(*) FROM assigned WHERE split = 'train') AS freq "
            "FROM assigned WHERE split = 'train' AND stock_code IS NOT NULL GROUP BY stock_code)\n"
            "SELECT a.key, a.split, coalesce(f.freq, 0.0) AS stock_code_freq FROM assigned a LEFT JOIN fr f ON a.stock_code = f.v")
def freq_encode_all_rows(spark, sf_dir):
    from ..operators.encode import FrequencyEncoder
    sp = labelled_split(spark, sf_dir)
    enc = FrequencyEncoder(inputCols=["stock_code"], outputCols=["stock_code_freq"], denominator="all")
    return enc.fit(sp.where(F.col("split") == "train")).transform(sp).select("key", "split", "stock_code_freq")


_SAMPLE_FRACTION = 0.5
_SAMPLE_SQL = ("SELECT * FROM labelled WHERE ('0x' || substr(md5(concat_ws(':', 'sample', CAST(key AS VARCHAR))), 1, 8))::UBIGINT "
               f"< {int(_SAMPLE_FRACTION * 2 ** 32)}")


@register("sampled_profile", "S2 A24", fx.with_views("", "labelled", extra={"sampled": _SAMPLE_SQL}).rstrip() + ",\n"
          + _profile_sql(LABELLED_SPEC, "sampled")
          + '\nSELECT "column", role, n_unique, mean, null_pct FROM prof')
def sampled_profile(spark, sf_dir):
    df = P.key_sample(fx.labelled(spark, sf_dir), ["key"], _SAMPLE_FRACTION)
    return P.profile(df).select("column", "role", "n_unique", "mean", "null_pct")


@register("profile_roundtrip", "S7 A24", _with_profile(
    'SELECT "column", position, role, dtype, n_unique, mean, std, min, max, null_pct, zeros_pct FROM prof'))
def profile_roundtrip(spark, sf_dir):
    import uuid
    from ..session import scratch_path
    path = scratch_path(spark, f"profiles/{uuid.uuid4().hex}")
    P.write_profile(P.profile(fx.labelled(spark, sf_dir)), path)
    return P.read_profile(spark, path)


_NULLS = ", ".join(f"CAST(NULL AS DOUBLE) AS {c}" for c in ("mean", "std", "min", "max", "null_pct"))
_TOP_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS item, CAST({c} AS VARCHAR) AS label, count(*) AS n, CAST(row_number() OVER (ORDER BY count(*) DESC, {c}) AS INTEGER) AS rk "
    f"FROM labelled WHERE {c} IS NOT NULL GROUP BY {c}" for c in ("priority", "segment"))


@register("full_profile", "A24 A5 A6 A7 S7", _with_profile(f"""
SELECT 'column' AS section, "column" AS item, position, role AS label, n_unique AS n, mean, std, min, max, null_pct, CAST(NULL AS DOUBLE) AS ratio FROM prof
UNION ALL SELECT 'top_value', item, rk, label, n, {_NULLS}, NULL FROM ({_TOP_SQL}) t WHERE rk <= 5
UNION ALL SELECT 'target', 'target', NULL, CAST(target AS VARCHAR), count(*), {_NULLS}, NULL FROM labelled GROUP BY target
UNION ALL SELECT 'imbalance', 'target', NULL, NULL, count(*), {_NULLS}, CASE WHEN count(*) = 2 THEN round(max(n) / min(n), 2) END
          FROM (SELECT count(*) AS n FROM labelled GROUP BY target) d"""))
def full_profile(spark, sf_dir):
    import uuid
    from ..session import scratch_path
    path = scratch_path(spark, f"profiles/{uuid.uuid4().hex}")
    P.write_profile(P.full_profile(fx.labelled(spark, sf_dir)), path)
    return P.read_profile(spark, path, P.FULL_SCHEMA)


# ---------------------------------------------------------------- a profile that grows by increments

def _increments(spark, sf_dir):
    """Three increments of the table, one profiled twice, the first two folded into one state."""
    import uuid
    from ..operators import profile_state as PS
    from ..session import scratch_path
    df = fx.labelled(spark, sf_dir)
    log = PS.state_log(spark, scratch_path(spark, f"profile_states/{uuid.uuid4().hex}"))
    for i in range(3):
        PS.add_increment(log, df.where(F.col("key") % 3 == i), f"day{i}")
        if i == 1:
            PS.add_increment(log, df.where(F.col("key") % 3 == 1), "day1")
            log.compact(PS.merged)
    return log.read()


@register("profile_increments", "A1 A2 A3 A4 A23 A24 S7", _with_profile(
    f'SELECT "column", position, role, dtype, CASE WHEN n_unique <= {P.ID_LIKE_MIN_DISTINCT * 5 // 4} THEN n_unique END AS n_unique, mean, std, min, max, '
    "null_pct, zeros_pct FROM prof"))
def profile_increments(spark, sf_dir):
    """From stored states, without a scan of earlier increments; distinct counts where they are exact."""
    from ..operators import profile_state as PS
    prof = PS.profile_of(_increments(spark, sf_dir))
    return P.profile_table(prof.withColumn("n_unique", F.when(F.col("n_unique_exact"), F.col("n_unique"))))


@register("top_values_increments", "A5 O2 S7", _top_values_sql(["priority", "segment"]))
def top_values_increments(spark, sf_dir):
    from ..operators import profile_state as PS
    return PS.top_values_of(_increments(spark, sf_dir))
