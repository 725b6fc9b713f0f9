"""Fixture views over the driver tables (FIXTURES.md section 2).

Each view exists twice: as a DataFrame built with the DataFrame API (what the
queries run on) and as SQL text that DuckDB runs for the oracle. The two must
stay equivalent; tests compare them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import read_table


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority"])
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"])
    k = F.col("o_orderkey")
    return o.join(c, o.o_custkey == c.c_custkey, "inner").select(
        k.alias("key"),
        F.when(k % 17 == 0, F.lit(None).cast("double")).otherwise(F.col("o_totalprice")).alias("total_price"),
        F.when(k % 11 == 0, F.lit(0.0)).otherwise(F.col("c_acctbal")).alias("acct_bal"),
        F.col("c_nationkey").alias("nation_key"),
        F.col("o_orderpriority").alias("priority"),
        F.when(k % 13 == 0, F.lit(None).cast("string")).otherwise(F.col("c_mktsegment")).alias("segment"),
        F.concat(F.lit("S"), (F.col("o_custkey") % 97).cast("string")).alias("stock_code"),
        F.col("c_name").alias("customer_id"),
        F.when((F.col("o_totalprice") > 150000) != (k % 10 == 0), 1).otherwise(0).alias("target"),
    )


LABELLED_BIG_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]


def labelled_big(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem", [
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
        "l_quantity", "l_discount", "l_tax", "l_linestatus", "l_returnflag"])
    return li.select(*LABELLED_BIG_KEY, "l_quantity", "l_discount", "l_tax", "l_linestatus",
                     F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("target"))


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_totalprice"])
    m1 = o.select(F.col("o_orderkey").alias("key"), F.lit("m1").alias("model_id"),
                  (F.floor(F.col("o_totalprice") / 50000) / F.lit(100.0)).alias("p1"))
    m2 = o.select(F.col("o_orderkey").alias("key"), F.lit("m2").alias("model_id"),
                  ((F.col("o_orderkey") % 7) / F.lit(7.0)).alias("p1"))
    return m1.unionByName(m2)


def _module_for(user_id):
    m = user_id % 4
    return (F.when(m == 0, "sklearn.metrics").when(m == 1, "cv2").when(m == 2, "yaml").otherwise("foo.bar"))


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "value", "props"])
    u = F.col("user_id")
    return e.select(
        F.col("event_id").alias("attempt_seq"),
        "ts",
        F.concat(F.lit("c"), (u % 5).cast("string")).alias("campaign"),
        (u % 2).alias("agent_id"),
        (F.col("event_id") % 20).alias("round"),
        F.when(F.col("event_type") == "error",
               F.concat(F.lit('No module named "'), _module_for(u), F.lit('"'))).alias("error"),
        F.when(F.col("event_type").isin("error", "signup"), F.lit(None).cast("double"))
         .otherwise(F.col("value") / F.lit(500.0)).alias("roc_auc"),
        F.concat(F.lit("approach "), F.col("props")).alias("approach_description"),
        F.concat(F.lit("analysis of "), "event_type", F.lit(": "), F.repeat(F.col("props"), (F.col("event_id") % 40).cast("int"))).alias("agent_analysis"),
        F.col("value").alias("duration_seconds"),
    )


def usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return usage_from_events(read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "value", "props"]))


def usage_from_events(e: DataFrame) -> DataFrame:
    """The ``usage`` projection; works on a batch or a streaming ``events`` frame."""
    m = F.col("user_id") % 4
    model = (F.when(m == 0, "deepseek/deepseek-r1").when(m == 1, "deepseek/deepseek-v3.2")
             .when(m == 2, "qwen/qwen3-32b").otherwise("other/unknown"))
    return e.select(
        F.col("event_id").alias("call_seq"),
        "ts",
        model.alias("model"),
        (F.lit(1000) + F.lit(100) * F.regexp_extract("props", "([0-9]+)", 1).cast("bigint")).alias("input_tokens"),
        F.floor(F.col("value") * 10).cast("bigint").alias("output_tokens"),
    )


# Code appended to a response, by ``(conv_id + turn) % 9``; ``{n}`` becomes the conversation id. Together they
# hold python and plain fences, several blocks, an empty block, a nested tag, no code, and a case for every code rule.
RESPONSE_TAILS = [
    "\n```python\ndef build_model(X):\n    return fit(X, {n})\n```\nthen\n```python\nverbose_eval=1\n```",
    "\n```\nx = {n}\n```\n```\ny = x\n```",
    "",
    "\n```python\nimport pickle\nkey = lambda r: r[{n}]\n```\n```\nplain\n```",
    "\n```python\ndef build_model(X):\n    m.fit(X, early_stopping_rounds = {n})\n    train(verbose_eval = 100)\n```",
    "\n```python\n   \n```\ntail {n}",
    "\n```python\nseed = {n}\n```\n```python\ndef train_code(X):\n    p = m.predict_proba(X)\n```",
    "\n```python\ndef build_model(X):\n    p = m.predict_proba(X)[:, 1]\n    return early_stopping_rounds\n```",
    "\n```sql\nselect {n}\n```\nunclosed ```python\nz = 1",
]


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "conversations", ["conv_id", "turn", "role", "text"])
    n = F.col("conv_id").cast("string")
    tail = F.lit("")
    for i, t in enumerate(RESPONSE_TAILS):
        tail = F.when((F.col("conv_id") + F.col("turn")) % len(RESPONSE_TAILS) == i, F.replace(F.lit(t), F.lit("{n}"), n)).otherwise(tail)
    return c.where(F.col("role") == "assistant").select("conv_id", "turn", F.concat("text", tail).alias("text"))


VIEWS = {
    "labelled": labelled,
    "labelled_big": labelled_big,
    "predictions": predictions,
    "attempts": attempts,
    "usage": usage,
    "responses": responses,
}


# SQL twins for the oracle (DuckDB and Spark SQL both accept them).
VIEW_SQL = {
    "labelled": """
SELECT o.o_orderkey AS key,
       CASE WHEN o.o_orderkey % 17 = 0 THEN NULL ELSE o.o_totalprice END AS total_price,
       CASE WHEN o.o_orderkey % 11 = 0 THEN CAST(0 AS DOUBLE) ELSE c.c_acctbal END AS acct_bal,
       c.c_nationkey AS nation_key,
       o.o_orderpriority AS priority,
       CASE WHEN o.o_orderkey % 13 = 0 THEN NULL ELSE c.c_mktsegment END AS segment,
       concat('S', CAST(o.o_custkey % 97 AS STRING)) AS stock_code,
       c.c_name AS customer_id,
       CASE WHEN (o.o_totalprice > 150000) <> (o.o_orderkey % 10 = 0) THEN 1 ELSE 0 END AS target
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""",
    "labelled_big": """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
       l_quantity, l_discount, l_tax, l_linestatus,
       CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS target
FROM lineitem""",
    "predictions": """
SELECT o_orderkey AS key, 'm1' AS model_id, floor(o_totalprice / 50000) / CAST(100 AS DOUBLE) AS p1 FROM orders
UNION ALL
SELECT o_orderkey AS key, 'm2' AS model_id, (o_orderkey % 7) / CAST(7 AS DOUBLE) AS p1 FROM orders""",
    "attempts": """
SELECT event_id AS attempt_seq, ts, concat('c', CAST(user_id % 5 AS STRING)) AS campaign,
       user_id % 2 AS agent_id, event_id % 20 AS round,
       CASE WHEN event_type = 'error' THEN concat('No module named "',
            CASE user_id % 4 WHEN 0 THEN 'sklearn.metrics' WHEN 1 THEN 'cv2' WHEN 2 THEN 'yaml' ELSE 'foo.bar' END, '"') END AS error,
       CASE WHEN event_type IN ('error', 'signup') THEN NULL ELSE value / CAST(500 AS DOUBLE) END AS roc_auc,
       concat('approach ', props) AS approach_description,
       concat('analysis of ', event_type, ': ', repeat(props, CAST(event_id % 40 AS INTEGER))) AS agent_analysis,
       value AS duration_seconds
FROM events""",
    "usage": """
SELECT event_id AS call_seq, ts,
       CASE user_id % 4 WHEN 0 THEN 'deepseek/deepseek-r1' WHEN 1 THEN 'deepseek/deepseek-v3.2'
                        WHEN 2 THEN 'qwen/qwen3-32b' ELSE 'other/unknown' END AS model,
       1000 + 100 * CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS input_tokens,
       CAST(floor(value * 10) AS BIGINT) AS output_tokens
FROM events""",
    "responses": "SELECT conv_id, turn, concat(text, replace(CASE (conv_id + turn) % {} {} END, '{{n}}', CAST(conv_id AS STRING))) AS text\n"
                 "FROM conversations WHERE role = 'assistant' AND text IS NOT NULL UNION ALL\n"
                 "SELECT conv_id, turn, NULL FROM conversations WHERE role = 'assistant' AND text IS NULL".format(
                     len(RESPONSE_TAILS), " ".join("WHEN {} THEN '{}'".format(i, t.replace("'", "''")) for i, t in enumerate(RESPONSE_TAILS))),
}


def with_views(sql: str, *names: str, extra: dict[str, str] | None = None) -> str:
    """Prefix an oracle query with the fixture views it reads, as CTEs."""
    ctes = [f"{n} AS ({VIEW_SQL[n]}\n)" for n in names]
    for n, body in (extra or {}).items():
        ctes.append(f"{n} AS ({body}\n)")
    return ("WITH " + ",\n".join(ctes) + "\n" + sql) if ctes else sql
