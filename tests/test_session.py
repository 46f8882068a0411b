"""Session rules: the checkpoint folder comes from the session; written
intermediates land under it."""

from __future__ import annotations

from cohortloom.plans.materialize import materialize
from cohortloom.session import ensure_checkpoint_dir


def test_existing_checkpoint_dir_is_kept(spark):
    before = spark.sparkContext.getCheckpointDir()
    assert before
    assert ensure_checkpoint_dir(spark, "/nonexistent/not-used") == before


def test_materialize_writes_under_the_checkpoint_dir(spark):
    df = spark.range(100).selectExpr("id", "id * 2 AS twice")
    out = materialize(df, "session-test")
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, df.collect()))
    base = spark.sparkContext.getCheckpointDir().replace("file:", "")
    assert any(base in f.replace("file:", "") for f in out.inputFiles())
