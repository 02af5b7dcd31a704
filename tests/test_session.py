import pytest

from tarnbrook.session import materialize, path_exists, scratch_path, scratch_root, scratch_scope, side_by_side


def test_scratch_follows_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    root = scratch_root(spark)
    assert root == configured.rstrip("/") if configured else root
    assert scratch_path(spark, "x").startswith(root + "/x-")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_scope_removes_what_was_written(spark):
    kept = materialize(spark.range(3), "kept")
    with scratch_scope(spark):
        with scratch_scope(spark):
            inner = materialize(spark.range(5), "inner").inputFiles()[0]
        outer = materialize(spark.range(5), "outer")
        threaded = side_by_side(spark, [lambda n=n: materialize(spark.range(n), "side") for n in (1, 2, 3)])
        assert [df.count() for df in threaded] == [1, 2, 3]
        assert outer.count() == 5 and not path_exists(spark, inner)
        files = [df.inputFiles()[0] for df in (outer, *threaded)]
    assert not any(path_exists(spark, f) for f in files)
    assert kept.count() == 3


def test_side_by_side_finishes_all_before_it_raises(spark):
    done = []

    def fail():
        raise ValueError("one of them")

    with pytest.raises(ValueError, match="one of them"):
        side_by_side(spark, [fail, lambda: done.append(spark.range(2).count())])
    assert done == [2]
