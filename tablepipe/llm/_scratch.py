"""Intermediate tables in the shared folder of ``spark.checkpoint.dir``: they cut
lineage, survive lost executors, and are deleted when an operator has used them."""

from __future__ import annotations

from contextlib import contextmanager

from tablepipe.session import scratch_path

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _shuffle_files_go(spark):
    """Shuffle files of a query are deleted when it ends, not when the driver collects garbage."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


class Scratch:
    """Tables of one run of an operator."""

    def __init__(self, spark, name):
        self.spark, self.name, self.paths = spark, name, {}

    def cut(self, df, name):
        """``df`` written to a table of its own and read back."""
        path = scratch_path(self.spark, f"{self.name}-{name}")
        with _shuffle_files_go(self.spark):
            df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[name] = path
        return out

    def drop(self, *names):
        """Delete tables that nothing reads any more."""
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(self.paths.pop(name))
            path.getFileSystem(conf).delete(path, True)
