"""M7: an ordered, named chain of transformers that refits only what a change touches.

``NamedChain.add(name, stage)`` appends (or inserts, replaces, removes) any Spark ML estimator or transformer. ``fit(train)``
walks the chain and gives every prefix a fingerprint: the training rows (schema, number, two hash sums, in one pass), and
each stage's class and parameters so far. A stage whose fingerprint was fitted before, in this session or in the chain's
folder, is taken from there; from the first changed stage on, stages are fitted on the training rows as
the stages before leave them. Adding a stage to a fitted chain of ten therefore fits one.

The fitted chain is applied to every split alike (``transform``) and can be saved and loaded as a ``PipelineModel``.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.ml import Estimator, PipelineModel, Transformer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import qcol
from ..sources.commits import COMPLETE, Files


def rows_fingerprint(df: DataFrame) -> str:
    """A digest of a table's schema and rows, whatever their order (one aggregation)."""
    # maps cannot be hashed; their entries can
    cols = [F.to_json(qcol(f.name)) if "map<" in f.dataType.simpleString() else qcol(f.name) for f in df.schema.fields]
    h = F.xxhash64(*cols) if cols else F.lit(0).cast("long")
    g = F.xxhash64(h, F.lit("second"))
    r = df.agg(F.count(F.lit(1)), F.sum(h.cast("decimal(38,0)")), F.bit_xor(g)).first()
    return hashlib.sha256(json.dumps([df.schema.jsonValue(), [str(x) for x in r]], sort_keys=True).encode()).hexdigest()


def stage_fingerprint(before: str, name: str, stage) -> str:
    """The prefix that ends in ``stage``: what came before, the class and every parameter that is set or has a default."""
    # repr of nested stages holds their random uid; none of the library's stages nests others
    params = {p.name: repr(stage.getOrDefault(p)) for p in stage.params if stage.isDefined(p)}
    cls = f"{type(stage).__module__}.{type(stage).__qualname__}"
    return hashlib.sha256(json.dumps([before, name, cls, params], sort_keys=True).encode()).hexdigest()


class FittedChain:
    """The fitted stages by name; ``fitted`` lists those that this fit had to train."""

    def __init__(self, names: list[str], models: list[Transformer], fitted: list[str]):
        self.names, self.models, self.fitted = names, models, fitted

    def transform(self, df: DataFrame, upto: str | None = None) -> DataFrame:
        """``df`` through all stages, or up to the named one."""
        for name, m in zip(self.names, self.models):
            df = m.transform(df)
            if name == upto:
                break
        return df

    def stage(self, name: str) -> Transformer:
        return self.models[self.names.index(name)]

    def save(self, path: str) -> None:
        PipelineModel(self.models).write().overwrite().save(path)


class NamedChain:
    """Ordered ``(name, stage)`` pairs; ``path`` keeps fitted stages across sessions."""

    def __init__(self, path: str | None = None):
        self.stages: list[tuple[str, Estimator | Transformer]] = []
        self.path = path
        self._known: dict[str, Transformer] = {}

    @property
    def names(self) -> list[str]:
        return [n for n, _ in self.stages]

    def add(self, name: str, stage: Estimator | Transformer, before: str | None = None) -> "NamedChain":
        """Append a stage, or insert it in front of ``before``."""
        if name in self.names:
            raise ValueError(f"the chain has a stage {name!r} already")
        at = len(self.stages) if before is None else self.names.index(before)
        self.stages.insert(at, (name, stage))
        return self

    def replace(self, name: str, stage: Estimator | Transformer) -> "NamedChain":
        self.stages[self.names.index(name)] = (name, stage)
        return self

    def remove(self, name: str) -> "NamedChain":
        del self.stages[self.names.index(name)]
        return self

    def _load(self, fingerprint: str, spark) -> Transformer | None:
        if fingerprint in self._known:
            return self._known[fingerprint]
        if self.path and Files(spark).exists(f"{self.path}/{fingerprint}/{COMPLETE}"):
            return PipelineModel.load(f"{self.path}/{fingerprint}").stages[0]
        return None

    def _keep(self, fingerprint: str, model: Transformer, spark) -> None:
        self._known[fingerprint] = model
        if self.path:
            PipelineModel([model]).write().overwrite().save(f"{self.path}/{fingerprint}")
            Files(spark).create(f"{self.path}/{fingerprint}/{COMPLETE}", "")  # last: a fit that dies here is fitted again

    def fit(self, train: DataFrame) -> FittedChain:
        """Fit the stages that no earlier fit on the same rows covers."""
        spark, current = train.sparkSession, train
        prefix, models, fitted = rows_fingerprint(train), [], []
        for name, stage in self.stages:
            prefix = stage_fingerprint(prefix, name, stage)
            model = stage
            if isinstance(stage, Estimator):
                model = self._load(prefix, spark)
                if model is None:
                    model = stage.fit(current)
                    fitted.append(name)
                    self._keep(prefix, model, spark)
            models.append(model)
            current = model.transform(current)
        return FittedChain(self.names, models, fitted)
