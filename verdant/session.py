"""Session construction and cluster-safe scratch locations.

The library never invents a machine-local folder on a cluster: lineage is cut
by a table written under ``spark.checkpoint.dir`` (or the SparkContext
checkpoint dir), which the cluster must name. Only a ``local`` master (tests,
development) may leave both unset; it gets a folder under the system temp
folder. Any other master raises.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "verdant", extra: dict | None = None) -> SparkSession:
    """Return a SparkSession with the defaults this library is tuned for.

    On a cluster ``master`` is left to spark-submit; locally pass ``local[N]``.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Checkpoint directory from the session; a local one is made only if it is
    unset and the master is local."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if configured:
        sc.setCheckpointDir(configured)
        return configured
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="verdant-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(local)
    return local


def scratch_path(spark: SparkSession, prefix: str) -> str:
    """A fresh path under the checkpoint directory (shared storage)."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{prefix}-{uuid.uuid4().hex}"
    if _SCOPES:
        _SCOPES[-1].append(path)
    return path


_SCOPES: list[list[str]] = []      # scratch paths of the open scopes, the innermost last


@contextmanager
def scratch_scope(spark: SparkSession):
    """Delete, on leaving, the scratch tables that were written inside, also after an error.

    Results are read from such tables, so write them where they are to stay (or collect them) before
    leaving. Tables from outside the scope, or from a scope inside it, are not touched."""
    made: list[str] = []
    _SCOPES.append(made)
    try:
        yield
    finally:
        _SCOPES[:] = [scope for scope in _SCOPES if scope is not made]
        for name in made:
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def written(df: DataFrame, prefix: str) -> DataFrame:
    """Write ``df`` under the checkpoint directory and read it back: it is
    computed once, its lineage is cut, and nothing stays cached."""
    path = scratch_path(df.sparkSession, prefix)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
