"""Session helpers: shared folder lookup and cluster sizing."""

from riskweave.session import cluster_conf, scratch_path, shared_dir


def test_shared_dir_from_session(spark):
    d = shared_dir(spark)
    assert d and (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir())
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(d)


def test_cluster_conf_sizes_partitions():
    tb100 = 100 * 1024 ** 4
    conf = cluster_conf(tb100, executor_cores=8, executors=1000)
    assert int(conf["spark.sql.shuffle.partitions"]) == 409600  # ~256 MB of input each
    small = cluster_conf(10 * 1024 ** 3, executor_cores=4, executors=10)
    assert int(small["spark.sql.shuffle.partitions"]) == 120  # at least 3x the slots


def test_scratch_folders_are_the_applications_own_and_go_with_it(spark, monkeypatch):
    import atexit
    from riskweave import session
    ended = []
    monkeypatch.setattr(session, "_scratch", set())
    monkeypatch.setattr(atexit, "register", lambda f, *a: ended.append((f, a)))
    one, two = scratch_path(spark, "a"), scratch_path(spark, "b")
    assert f"/riskweave/{spark.sparkContext.applicationId}/a-" in one and len(ended) == 1
    f, args = ended[0]
    assert str(args[1].toString()).endswith(f"/riskweave/{spark.sparkContext.applicationId}") and two.startswith(one.rsplit("/", 1)[0])
    f(None, None)  # a JVM that is gone does not matter
