"""Lineage folder policy: read spark.checkpoint.dir from the session; only a
local master without it gets a scratch folder."""

from reviewspark.session import ensure_checkpoint_dir, materialize


def test_checkpoint_dir_is_set_and_stable(spark):
    a = ensure_checkpoint_dir(spark)
    b = ensure_checkpoint_dir(spark)
    assert a and a == b
    assert spark.sparkContext.getCheckpointDir()


def test_materialize_round_trip(spark):
    df = spark.range(10).withColumnRenamed("id", "x")
    back = materialize(df, "unit")
    assert sorted(r.x for r in back.collect()) == list(range(10))
    assert "FileScan parquet" in back._jdf.queryExecution().executedPlan().toString()
