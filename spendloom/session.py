"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

#: Set where the session does not say otherwise.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def get_session(app: str = "spendloom", master: str | None = None,
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    """Return the active session, or build one.

    Settings that the launcher made stay as they are; only those that are
    unset get the library's defaults. ``master``, ``shuffle_partitions`` and
    ``extra`` are the caller's own wishes, for local runs and tests.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    made = spark.conf.getAll
    for k, v in _DEFAULTS.items():
        if k not in made:
            spark.conf.set(k, v)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    The cluster's setting wins. A temporary folder stands in for it on a local
    master only: on a cluster every executor would write to its own disk.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="spendloom-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path


def scratch_table_path(spark: SparkSession, name: str) -> str:
    """A table location under the shared checkpoint folder, removed when the application ends."""
    path = f"{checkpoint_dir(spark)}/{name}"
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path
