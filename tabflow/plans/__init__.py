"""Registered queries: importing this package fills ``registry.QUERIES`` and ``registry.ORACLE``."""

from . import encode_plans, log_plans, metric_plans, model_plans, profile_plans, split_plans, transcript_plans  # noqa: F401
from .registry import OPERATORS, ORACLE, QUERIES  # noqa: F401
