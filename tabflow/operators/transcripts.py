"""Jobs over tables of model responses and run logs.

All work is built-in regex/array functions on whole texts (JVM, codegen);
nothing is truncated before extraction.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import strip
from ..sources.tables import literal_table

# Fenced-block patterns (python-tagged first, then any fence).
PY_FENCE = r"(?s)```python\n?(.*?)```"
ANY_FENCE = r"(?s)```\n?(.*?)```"
MISSING_MODULE = r"""No module named ['"]([^'"]+)['"]"""
DESCRIPTION_CHARS = 600

# Import name -> package name; any other name maps to itself.
PIP_NAMES = [
    ("umap", "umap-learn"), ("sklearn", "scikit-learn"), ("cv2", "opencv-python"), ("PIL", "Pillow"),
    ("yaml", "pyyaml"), ("lightgbm", "lightgbm"), ("xgboost", "xgboost"), ("catboost", "catboost"),
    ("shap", "shap"), ("optuna", "optuna"), ("boruta", "boruta"), ("phik", "phik"), ("prince", "prince"),
]

# Static code-check rules.
VERBOSE_EVAL = r"\bverbose_eval\s*="
EARLY_STOPPING = r"early_stopping_rounds\s*=\s*[0-9]+"
FIT_CALL = ".fit("
LAMBDA_WORD = r"\blambda\b"
PICKLE_WORD = "pickle"
MODEL_HOOK = "def build_model"
PROBA_CALL = "predict_proba"
PROBA_SHAPE = ["[:, 1]", "column_stack", "hstack"]


def code_blocks(text: Column) -> Column:
    """Stripped, non-empty fenced blocks; python-tagged ones if any, else any fence."""
    py = F.regexp_extract_all(text, F.lit(PY_FENCE), 1)
    anyf = F.regexp_extract_all(text, F.lit(ANY_FENCE), 1)
    blocks = F.when(F.size(py) > 0, py).otherwise(anyf)
    return F.filter(F.transform(blocks, strip), lambda b: b != "")


def explode_blocks(df: DataFrame, text: str = "text", keys: tuple[str, ...] = ("conv_id", "turn")) -> DataFrame:
    """T1 as rows: ``(keys..., block_idx, code)`` in text order."""
    return df.select(*keys, F.posexplode(code_blocks(F.col(text))).alias("block_idx", "code"))


def main_block(blocks: Column) -> Column:
    """T4: first block with ``build_model`` (or ``train_code`` in its first 50 chars), else the first block."""
    hit = F.filter(blocks, lambda b: b.contains("build_model") | F.substring(b, 1, 50).contains("train_code"))
    return F.coalesce(F.get(hit, 0), F.get(blocks, 0))


def description(text: Column, width: int = DESCRIPTION_CHARS) -> Column:
    """T4: the text before the first fence, stripped, first 600 characters."""
    return F.substring(strip(F.split_part(text, F.lit("```"), F.lit(1))), 1, width)


def pip_table(spark: SparkSession) -> DataFrame:
    return literal_table(spark, PIP_NAMES, ["module", "package"])


def missing_packages(logs: DataFrame, text: str = "error") -> DataFrame:
    """First ``No module named 'x'`` per log -> head of the dotted name -> package; counts per package."""
    mod = F.regexp_extract(F.col(text), MISSING_MODULE, 1)
    heads = (logs.select(mod.alias("m")).where(F.col("m") != "")
                 .select(F.split_part(F.col("m"), F.lit("."), F.lit(1)).alias("module")))
    # fixed 13-row map: a bounded broadcast
    mapped = heads.join(F.broadcast(pip_table(logs.sparkSession)), "module", "left")
    return (mapped.select(F.coalesce("package", "module").alias("package"))
                  .groupBy("package").agg(F.count(F.lit(1)).alias("n")))


def code_issues(code: Column) -> Column:
    """Names of the rules a code text breaks, as an array."""
    one_column = ~code.contains(PROBA_SHAPE[0]) & ~code.contains(PROBA_SHAPE[1]) & ~code.contains(PROBA_SHAPE[2])
    flags = [
        F.when(code.rlike(VERBOSE_EVAL), F.lit("verbose_eval")),
        F.when(code.rlike(EARLY_STOPPING) & code.contains(FIT_CALL), F.lit("early_stopping_rounds")),
        F.when(code.rlike(LAMBDA_WORD) & code.contains(PICKLE_WORD), F.lit("lambda_with_pickle")),
        F.when(~code.contains(MODEL_HOOK), F.lit("missing_build_model")),
        F.when(code.contains(PROBA_CALL) & one_column, F.lit("predict_proba_shape")),
    ]
    return F.filter(F.array(*flags), lambda x: x.isNotNull())


# Calls that end the whole run (not methods of that name), and the name a submission must use to start it.
EXIT_CALL = r"(^|[^\w.])(exit|quit)\s*\("
RUNNER_NAME = "AGENT_RUNNER_PATH"


def run_issues(code: Column) -> Column:
    """T3, as a run would meet them: calls that would end the runner, and no call of the runner at all."""
    flags = [F.when(code.rlike(EXIT_CALL), F.lit("direct_exit")), F.when(~code.contains(RUNNER_NAME), F.lit("missing_runner"))]
    return F.filter(F.array(*flags), lambda x: x.isNotNull())
