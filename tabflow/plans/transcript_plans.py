"""Registered transcript queries over the ``responses`` and ``attempts`` fixtures."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import transcripts as T
from ..sources import fixtures as fx
from .registry import register

_BLOCKS_CTE = r""",
b0 AS (SELECT conv_id, turn, text,
              regexp_extract_all(text, '(?s)```python\n?(.*?)```', 1) AS py,
              regexp_extract_all(text, '(?s)```\n?(.*?)```', 1) AS anyf FROM responses),
b1 AS (SELECT conv_id, turn, text,
              list_filter(list_transform(CASE WHEN len(py) > 0 THEN py ELSE anyf END,
                                         lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '') AS blocks
       FROM b0)
"""


def _sql(select: str) -> str:
    return fx.with_views("", "responses").rstrip() + _BLOCKS_CTE + select


@register("code_blocks", "T1 F11", _sql(
    "SELECT conv_id, turn, CAST(generate_subscripts(blocks, 1) - 1 AS INTEGER) AS block_idx, unnest(blocks) AS code "
    "FROM b1"))
def code_blocks(spark, sf_dir):
    return T.explode_blocks(fx.responses(spark, sf_dir))


_MAIN_SQL = ("coalesce(list_filter(blocks, lambda x: contains(x, 'build_model') OR contains(substr(x, 1, 50), 'train_code'))[1], "
             "blocks[1])")


@register("main_block", "T4", _sql(
    f"SELECT conv_id, turn, {_MAIN_SQL} AS main_code, "
    r"substr(regexp_replace(split_part(text, '```', 1), '^\s+|\s+$', '', 'g'), 1, 600) AS description FROM b1"))
def main_block(spark, sf_dir):
    r = fx.responses(spark, sf_dir)
    blocks = T.code_blocks(F.col("text"))
    return r.select("conv_id", "turn", T.main_block(blocks).alias("main_code"),
                    T.description(F.col("text")).alias("description"))


_RULE_SQL = " UNION ALL ".join([
    "SELECT conv_id, turn, 'verbose_eval' AS rule FROM m WHERE regexp_matches(code, '\\bverbose_eval\\s*=')",
    "SELECT conv_id, turn, 'early_stopping_rounds' FROM m "
    "WHERE regexp_matches(code, 'early_stopping_rounds\\s*=\\s*[0-9]+') AND contains(code, '.fit(')",
    "SELECT conv_id, turn, 'lambda_with_pickle' FROM m WHERE regexp_matches(code, '\\blambda\\b') AND contains(code, 'pickle')",
    "SELECT conv_id, turn, 'missing_build_model' FROM m WHERE NOT contains(code, 'def build_model')",
    "SELECT conv_id, turn, 'predict_proba_shape' FROM m WHERE contains(code, 'predict_proba') AND NOT contains(code, '[:, 1]') "
    "AND NOT contains(code, 'column_stack') AND NOT contains(code, 'hstack')",
])


@register("code_issues", "T3", _sql(
    f", m AS (SELECT conv_id, turn, {_MAIN_SQL} AS code FROM b1 WHERE len(blocks) > 0)\n"
    f"SELECT rule, count(*) AS n FROM ({_RULE_SQL}) r GROUP BY rule"))
def code_issues(spark, sf_dir):
    r = fx.responses(spark, sf_dir)
    code = r.select(T.main_block(T.code_blocks(F.col("text"))).alias("code")).where(F.col("code").isNotNull())
    return (code.select(F.explode(T.code_issues(F.col("code"))).alias("rule"))
                .groupBy("rule").agg(F.count(F.lit(1)).alias("n")))


def _pip_sql() -> str:
    rows = ", ".join(f"('{m}', '{p}')" for m, p in T.PIP_NAMES)
    return f"SELECT * FROM (VALUES {rows}) AS t(module, package)"


@register("missing_packages", "T2 J7 F11 F12", fx.with_views(
    "SELECT coalesce(p.package, h.module) AS package, count(*) AS n FROM "
    "(SELECT split_part(regexp_extract(error, 'No module named [''\"]([^''\"]+)[''\"]', 1), '.', 1) AS module "
    " FROM attempts WHERE regexp_extract(error, 'No module named [''\"]([^''\"]+)[''\"]', 1) <> '') h "
    "LEFT JOIN pip p ON h.module = p.module GROUP BY 1", "attempts", extra={"pip": _pip_sql()}))
def missing_packages(spark, sf_dir):
    return T.missing_packages(fx.attempts(spark, sf_dir), "error")


# an ending by conversation: a plain exit, a method of that name, none; every second one starts the runner
_ENDS = ["\nexit(1)", "\nsys.exit(0)\nobj.quit()", "", "\n    quit ()"]
_RUNNER_END = "\nexec(open(os.environ[\'AGENT_RUNNER_PATH\']).read())"


@register("code_run_issues", "T3", _sql(
    ", c AS (SELECT conv_id, turn, concat(" + _MAIN_SQL + ", CASE (conv_id + turn) % 4 "
    + " ".join(f"WHEN {i} THEN '{t}'" for i, t in enumerate(_ENDS)) + " END, CASE WHEN conv_id % 2 = 0 THEN '" + _RUNNER_END.replace("'", "''")
    + "' ELSE '' END) AS code FROM b1 WHERE len(blocks) > 0)\n"
    "SELECT conv_id, turn, concat_ws(',', CASE WHEN regexp_matches(code, '" + T.EXIT_CALL + "') THEN 'direct_exit' END, "
    "CASE WHEN NOT contains(code, '" + T.RUNNER_NAME + "') THEN 'missing_runner' END) AS issues FROM c"))
def code_run_issues(spark, sf_dir):
    r = fx.responses(spark, sf_dir)
    end = F.element_at(F.array(*[F.lit(t) for t in _ENDS]), ((F.col("conv_id") + F.col("turn")) % 4 + 1).cast("int"))
    code = F.concat(T.main_block(T.code_blocks(F.col("text"))), end, F.when(F.col("conv_id") % 2 == 0, F.lit(_RUNNER_END)).otherwise(""))
    rows = r.select("conv_id", "turn", code.alias("code")).where(F.col("code").isNotNull())
    return rows.select("conv_id", "turn", F.array_join(T.run_issues(F.col("code")), ",").alias("issues"))
