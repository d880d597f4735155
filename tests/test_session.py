from tablepipe.session import DEFAULT_CONF, ensure_checkpoint_dir, scratch_path, ship_package


def test_scratch_under_checkpoint_dir(spark):
    base = ensure_checkpoint_dir(spark)
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(base + "/tablepipe-scratch/x-")
    assert spark.sparkContext.getCheckpointDir() is not None


def test_defaults_and_shipping(spark):
    assert spark.conf.get("spark.sql.session.timeZone") == DEFAULT_CONF["spark.sql.session.timeZone"]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == "dynamic"
    ship_package(spark)
    ship_package(spark)  # once per application
    # a Python worker can import the package (used by UDTFs and the paged source)
    got = spark.range(2).rdd.map(lambda _: __import__("tablepipe").__version__).collect()
    assert got == [__import__("tablepipe").__version__] * 2
