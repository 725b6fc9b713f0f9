"""tabflow: labelled-table preparation, modelling and evaluation on Spark.

Main entry points (all take and return DataFrames):

* ``operators.profile.profile(df)`` -> per-column roles and statistics; ``roles(prof)`` -> role lists
* ``operators.split.stratified_split(df, key)`` -> ``df`` plus ``split`` (exact quotas, hashed key order)
* ``operators.encode``: ``label_encoder``, ``FrequencyEncoder``, ``MedianImputer``, ``unseen_categories``
* ``operators.models``: ``train_run``, ``fit``, ``score``, ``stacked``, ``search``, ``save`` / ``load``
* ``operators.metrics.evaluate(preds, labels)`` -> guarded AUC per model; ``ensemble_mean``
* ``operators.attempts`` / ``operators.ledger`` / ``operators.transcripts``: log, ledger and transcript jobs
* ``llm``: training-data operators (dedup, extraction, quality, mixing, ...), on their own
* ``streaming``: the usage ledger and budget admission as Structured Streaming jobs

``session.configure(spark)`` applies the package defaults to an existing session; registered,
oracle-checked queries live in ``plans`` and are exposed through ``__spark_entry__``.
"""
