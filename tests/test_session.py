"""Staged tables leave nothing but themselves behind."""

from verbamark import session


def shuffle_files(spark):
    files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    return {f.getName() for f in (files.apply(i) for i in range(files.size())) if f.getName().startswith("shuffle_")}


def test_staging_removes_its_shuffles(spark):
    setting = spark.conf.get(session.SHUFFLE_CLEANUP, "false")
    before = shuffle_files(spark)
    staged = session.stage(spark.range(1000).selectExpr("id % 7 AS k").groupBy("k").count(), "sevenths")
    assert not shuffle_files(spark) - before
    assert spark.conf.get(session.SHUFFLE_CLEANUP, "false") == setting
    assert sorted(r.k for r in staged.collect()) == list(range(7))
