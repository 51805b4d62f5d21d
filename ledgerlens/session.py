"""SparkSession construction and the few settings every job relies on."""

from __future__ import annotations

import os
import tempfile
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings applied to sessions we build. On a cluster the deployment's own
# spark-defaults win for anything it sets; these are the job's requirements.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # ledger writes replace only the invoice_year partitions they touch
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # The JVM never JIT-compiles methods above 8000 bytes of bytecode; wide
    # parse expressions inlined into filters can generate such methods and
    # then run interpreted (3x slower measured). At this limit Spark falls
    # back to smaller per-operator code instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

#: stage tables hold hashes and repeated texts: smaller than by Spark's default codec
STAGE_CODEC = ("compression", "zstd")


def get_spark(master: str | None = None, app: str = "ledgerlens",
              conf: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting one only when unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used
    as is, and it is an error when none is set. Only on a local master (tests
    on one machine) a fresh scratch folder is used instead.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and not sc.master.split("[")[0] == "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = configured or tempfile.mkdtemp(prefix="ledgerlens-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written stage tables."""
    base = ensure_checkpoint_dir(spark)
    return base.rstrip("/") + "/" + name


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists, on whatever file system it lies."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def remove_path(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of the files under a folder."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(p).getLength()


@contextmanager
def _lowered(spark: SparkSession, name: str, most: int):
    """The number (or bytes) set as ``name`` is at most ``most`` for the queries run inside."""
    before = spark.conf.get(name, None)
    if before is not None and spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(before) <= most:
        yield
        return
    spark.conf.set(name, most)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def compilable_methods(spark: SparkSession):
    """Queries run inside keep their generated methods small enough for the
    JVM to compile (see ``DEFAULT_CONF``), in sessions not built here too."""
    name = "spark.sql.codegen.hugeMethodLimit"
    return _lowered(spark, name, int(DEFAULT_CONF[name]))


#: bytes of files for one task of the workbook flows: packed sheets and stage tables are many times as large when read
TASK_BYTES = 32 << 20


def small_scans(spark: SparkSession):
    """Queries run inside cut what they read into tasks of ``TASK_BYTES``, so
    that these are many, of like lengths, for all cores."""
    return _lowered(spark, "spark.sql.files.maxPartitionBytes", TASK_BYTES)


#: bytes of a stored table for which a shuffle of its rows gets one partition more
PARTITION_BYTES = 1 << 20


def sized_shuffles(spark: SparkSession, stored: int):
    """Queries run inside, over stage tables of ``stored`` bytes, cut their
    shuffles into no more partitions than these are worth, nor less than
    there are cores: the many of a large job cost a small one more time than
    its rows do."""
    return _lowered(spark, "spark.sql.shuffle.partitions", max(spark.sparkContext.defaultParallelism, -(-stored // PARTITION_BYTES)))


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``ledgerlens`` importable in executor Python workers.

    Operators that run Python on executors (workbook parsing and writing)
    pickle functions of this package by reference. The package is zipped
    once per application and added with ``addPyFile`` (what ``--py-files``
    does), so it works whatever the workers' working directory or install.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    import zipfile
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    zpath = os.path.join(tempfile.mkdtemp(prefix="ledgerlens-pyfiles-"), "ledgerlens.zip")
    with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(pkg_dir):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(zpath)
    _SHIPPED.add(sc.applicationId)
