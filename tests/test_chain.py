"""Named chain: only what changed is fitted; fitted ranks equal a brute force on any split."""

import bisect
import random

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array

from tabflow.operators.chain import NamedChain, rows_fingerprint
from tabflow.operators.encode import FrequencyEncoder, MedianImputer
from tabflow.operators.ranks import RankTransform


def table(spark, n=300, seed=1):
    rnd = random.Random(seed)
    return spark.createDataFrame([(i, None if rnd.random() < 0.1 else rnd.gauss(0, 5), rnd.choice("abc")) for i in range(n)], "key long, x double, s string")


def chain(path=None):
    c = NamedChain(path).add("impute", MedianImputer(inputCols=["x"], outputCols=["filled"]))
    c.add("assemble", VectorAssembler(inputCols=["filled"], outputCol="v"))
    return c.add("scale", StandardScaler(inputCol="v", outputCol="z", withMean=True))


def test_only_the_changed_suffix_is_fitted(spark, tmp_path):
    df = table(spark)
    c = chain(str(tmp_path / "chain"))
    assert c.fit(df).fitted == ["impute", "scale"] and c.fit(df.repartition(5)).fitted == []
    c.add("freq", FrequencyEncoder(inputCols=["s"], outputCols=["f"]))
    assert c.fit(df).fitted == ["freq"]
    c.add("twice", SQLTransformer(statement="SELECT *, filled * 2 AS filled2 FROM __THIS__"), before="scale")
    fitted = c.fit(df)
    assert c.names == ["impute", "assemble", "twice", "scale", "freq"] and fitted.fitted == ["scale", "freq"]
    assert c.remove("twice").fit(df).fitted == []
    assert c.replace("impute", MedianImputer(inputCols=["x"], outputCols=["filled"])).fit(df).fitted == []  # the same stage, built anew
    assert c.fit(df.where("key <> 7")).fitted == ["impute", "scale", "freq"]  # other rows
    with pytest.raises(ValueError):
        c.add("freq", SQLTransformer(statement="SELECT * FROM __THIS__"))


def test_another_session_finds_the_fitted_stages_and_scores_alike(spark, tmp_path):
    df, path = table(spark), str(tmp_path / "chain")
    ranked = RankTransform(inputCols=["x"], outputCols=["x_rank"])
    full = chain(path).add("rank", ranked).add("freq", FrequencyEncoder(inputCols=["s"], outputCols=["f"])).fit(df)
    other = chain(path).add("rank", ranked).add("freq", FrequencyEncoder(inputCols=["s"], outputCols=["f"])).fit(df)
    assert len(full.fitted) == 4 and other.fitted == []
    full.save(str(tmp_path / "model"))
    test = table(spark, 100, 9)

    def values(m):
        return sorted(map(repr, m.transform(test).withColumn("z", vector_to_array("z")).select("key", "z", "x_rank", "f").collect()))
    assert values(full) == values(other) == values(PipelineModel.load(str(tmp_path / "model")))
    assert full.transform(test, upto="impute").columns == ["key", "x", "s", "filled"]


def test_fingerprint_depends_on_rows_not_on_their_order(spark):
    df = table(spark)
    assert rows_fingerprint(df) == rows_fingerprint(df.repartition(7).orderBy("x"))
    assert len({rows_fingerprint(x) for x in (df, df.unionByName(df.limit(1)), df.where("key <> 3"), df.withColumnRenamed("s", "t"))}) == 4


@pytest.mark.parametrize("values", [[1.0], [3.0, 3.0, 3.0, 1.0, -2.0], "many", "drift", []])
def test_fitted_ranks_equal_brute_force(spark, values):
    rnd = random.Random(4)
    train = values if isinstance(values, list) else [round(rnd.gauss(0, 3), 2) for _ in range(3000)]
    asked = [None, float("nan"), -1e9, 1e9, 0.0, 0.005] + train[:50] + [rnd.uniform(-4, 4) for _ in range(50)]
    asked += [100.0 + i for i in range(300)] if values == "drift" else []
    m = RankTransform(inputCols=["x"], outputCols=["r"]).fit(spark.createDataFrame([(v,) for v in train + [None]], "x double"))
    rows = m.transform(spark.createDataFrame([(v,) for v in asked], "x double").repartition(3)).collect()
    known = sorted(train)

    def want(v):
        if v is None or v != v or not known:
            return None
        below, upto = bisect.bisect_left(known, v), bisect.bisect_right(known, v)
        return (below + (upto - below + 1) / 2) / len(known)
    assert len(rows) == len(asked)
    for r in rows:
        assert r.r == (None if want(r.x) is None else pytest.approx(want(r.x), abs=1e-12)), r
