"""The tasks that align predictions with labels grow with the rows."""

from pyspark.sql import functions as F

from tabflow.operators import metrics as M


def test_alignment_tasks_grow_with_rows(spark, monkeypatch):
    labels = spark.range(400).select(F.col("id").alias("key"), F.when(F.col("id") % 7 > 3, 1).otherwise(0).alias("target"))
    preds = labels.select("key", F.explode(F.array(F.lit("m"), F.lit("n"))).alias("model_id"), (F.col("key") % 9 / 9.0).alias("p1"))
    preds = preds.unionByName(preds.where("model_id = 'n' and key = 1")).unionByName(preds.limit(3).withColumn("key", F.lit(None).cast("long")).withColumn("model_id", F.lit("o")))
    plain = sorted(map(tuple, M.evaluate(preds, labels).collect()))
    monkeypatch.setattr(M, "ROWS_A_TASK", 50)
    left, lab = M._dealt_by_rows(preds, labels, 400, ["key"])
    assert left.rdd.getNumPartitions() == lab.rdd.getNumPartitions() == -(-(400 + 804) // 50)
    assert sorted(map(tuple, M.evaluate(preds, labels).collect())) == plain
