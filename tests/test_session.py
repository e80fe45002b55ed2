"""Session helpers: partition sizing fills only unset settings; the shared working folder."""

from formmart.session import input_bytes, size_for_input, work_dir


def test_size_for_input_fills_only_unset(spark):
    keys = ["spark.sql.adaptive.coalescePartitions.initialPartitionNum",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.files.maxPartitionBytes"]
    before = {k: spark.conf.get(k, None) for k in keys}
    try:
        applied = size_for_input(spark, 100 * (1 << 40))
        # shuffle.partitions was set when the session was built: left alone
        assert "spark.sql.shuffle.partitions" not in applied
        assert applied["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] == "409600"
        small = size_for_input(spark, 10 << 20)
        assert small["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] == "200"
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_input_bytes_and_work_dir(spark, sf_dir):
    assert input_bytes(spark, [f"{sf_dir}/lineitem.parquet"]) > 0
    assert work_dir(spark).startswith(("file:", "hdfs:", "s3", "gs:", "abfs", "/"))


def test_a_cluster_needs_a_shared_folder():
    import pytest
    from formmart import session

    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)

        class getConf:  # noqa: N801
            get = staticmethod(lambda *a: None)

    class Session:
        sparkContext = Context()

        class conf:  # noqa: N801
            get = staticmethod(lambda *a: None)

    with pytest.raises(ValueError):
        session.work_dir(Session())
