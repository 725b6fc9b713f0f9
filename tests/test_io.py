"""Sources and sinks round trips."""

import json
import os
import tempfile

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tabflow.operators import metrics as M
from tabflow.operators import profile as P
from tabflow.operators import split as S
from tabflow.sources import fixtures as fx
from tabflow.sources import tables as TB


def _tmp():
    return tempfile.mkdtemp(prefix="tabflow-io-")


def test_csv_scan_and_dataset_union(spark):
    d = _tmp()
    lab = fx.labelled(spark, SF_SMALL)
    sp = S.stratified_split(lab, "key")
    for name in ("train", "val"):
        sp.where(F.col("split") == name).drop("split").write.option("header", True).csv(f"{d}/{name}")
    schema = lab.schema
    tr = TB.read_labelled(spark, f"{d}/train", "csv", schema)
    va = TB.read_labelled(spark, f"{d}/val", "csv", schema)
    assert tr.count() + va.count() == lab.count()
    assert TB.detect_target(tr) == "target"
    tr.write.parquet(f"{d}/p_train")
    va.write.parquet(f"{d}/p_val")
    ds = TB.load_dataset(spark, f"{d}/p_train", f"{d}/p_val")
    got = {r["split"]: r["count"] for r in ds.groupBy("split").count().collect()}
    assert got == {r["split"]: r["count"] for r in sp.groupBy("split").count().collect()}


def test_split_sink_is_written_once(spark):
    d = _tmp() + "/splits"
    sp = S.stratified_split(fx.labelled(spark, SF_SMALL), "key")
    TB.write_splits(sp, d)
    TB.write_splits(sp.limit(1), d)  # ignored: the first write stays
    assert spark.read.parquet(d).count() == sp.count()


def test_predictions_and_submission(spark):
    d = _tmp()
    preds = fx.predictions(spark, SF_SMALL)
    TB.write_predictions(preds, f"{d}/preds")
    back = TB.read_predictions(spark, f"{d}/preds")
    assert back.count() == preds.count()
    ens = M.ensemble_mean(back)
    test = fx.labelled(spark, SF_SMALL).select("key")
    TB.write_submission(test, ens, "key", f"{d}/sub")
    sub = spark.read.option("header", True).csv(f"{d}/sub")
    assert sub.columns == ["id", "target"] and sub.count() == test.count()


def test_logs_append_and_run_meta(spark):
    d = _tmp()
    a = fx.attempts(spark, SF_SMALL).limit(5)
    TB.append_log(a, f"{d}/attempts")
    TB.append_log(a, f"{d}/attempts")
    assert spark.read.parquet(f"{d}/attempts").count() == 10
    for i, (key, val) in enumerate([("duration_seconds", 12.5), ("duration_sec", 7.0)]):
        os.makedirs(f"{d}/runs/run_{i}")
        with open(f"{d}/runs/run_{i}/meta.json", "w") as f:
            json.dump({"run_id": f"run_{i}", "agent_id": i, "roc_auc": 0.7, key: val}, f, indent=2)
    meta = {r["run_id"]: r["duration_seconds"] for r in TB.read_run_meta(spark, f"{d}/runs").collect()}
    assert meta == {"run_0": 12.5, "run_1": 7.0}


def test_profile_sink_and_stable_sample(spark):
    d = _tmp()
    lab = fx.labelled(spark, SF_SMALL)
    P.write_profile(P.profile(lab), f"{d}/profile")
    back = P.read_profile(spark, f"{d}/profile")
    assert back.count() == 8 and "role" in back.columns
    s1 = {r["key"] for r in P.key_sample(lab, ["key"], 0.3).collect()}
    s2 = {r["key"] for r in P.key_sample(lab.repartition(7), ["key"], 0.3).collect()}
    assert s1 == s2 and 0 < len(s1) < lab.count()
