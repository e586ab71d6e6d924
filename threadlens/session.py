"""Session helpers: one place for the settings every job here relies on."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Recursive CTEs (tree walk) must not stop at Spark's default row budget of
# one million rows: a level of a large forest is far bigger than that.
SESSION_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.cteRecursionRowLimit": "-1",
    # JSON objects with a repeated key: the last one wins, as in Python
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
}


def get_spark(master: str | None = None, app: str = "threadlens",
              shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the operators expect."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = b.config("spark.ui.enabled", "false")
    # checkpoint files of DataFrames that are gone are removed by the cleaner
    b = b.config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    for k, v in SESSION_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    prepare(spark)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session (idempotent)."""
    spark.conf.set("spark.sql.cteRecursionRowLimit", "-1")
    spark.conf.set("spark.sql.mapKeyDedupPolicy", "LAST_WIN")
    checkpoint_dir(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so functions
    that run there can import it although only the driver has it on its path.
    (``--py-files`` does the same; a second copy does no harm.)"""
    sc = spark.sparkContext
    if getattr(sc, "_threadlens_shipped", False):
        return
    here = os.path.dirname(os.path.abspath(__file__))
    # Spark serves the driver's file to every executor; nobody else reads it
    path = os.path.join(tempfile.mkdtemp(prefix="threadlens-py-"), "threadlens.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(here):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.join("threadlens", os.path.relpath(full, here)))
    sc.addPyFile(path)
    sc._threadlens_shipped = True


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only where it is unset *and* the master is local (tests, a laptop) a folder
    of our own is picked; a cluster without the setting is refused, because a
    folder on one machine is no place for tables that other machines read.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        d = sc.getCheckpointDir()
    if not d:
        if not re.match(r"local(\[.*\])?$", sc.master):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        d = tempfile.mkdtemp(prefix="threadlens-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d


def materialize(df, name: str = "table"):
    """Cut the lineage of a DataFrame that later steps read several times: it
    is written as Parquet below the shared folder and read back, so the work is
    done once, readers take only the columns they need, and a lost executor
    costs a re-read instead of a re-run."""
    path = shared_dir(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique (not yet existing) path below the shared checkpoint
    location, for tables and files a job writes and reads back. All paths of
    one application have one parent (see ``remove_scratch``)."""
    base = checkpoint_dir(spark)
    sep = "" if base.endswith("/") else "/"
    return f"{base}{sep}threadlens/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"


def remove_scratch(spark: SparkSession) -> None:
    """Delete everything this application wrote through ``shared_dir``. Call
    it at the end; tables returned by the library are no longer readable then."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint_dir(spark)}/threadlens/{spark.sparkContext.applicationId}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def qualified(spark: SparkSession, path: str) -> str:
    """The path with the scheme of the default file system where it names none."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(p).toString()
