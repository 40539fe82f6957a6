"""Session construction and lineage-cutting helpers."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession


def get_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "candlewick") -> SparkSession:
    """A session for local runs and tests. On a cluster use the cluster's own builder."""
    spark = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``candlewick`` importable in the Python workers (applyInPandas,
    transformWithStateInPandas): zip the package once per application and
    ``addPyFile`` it, as ``--py-files`` would. Workers do not see the
    driver's ``sys.path``."""
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="candlewick-pyfiles-"), "candlewick.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as zf:
        for root, _, files in os.walk(pkg):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(root, name)
                    zf.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(out)
    # the driver-side worker of transformWithState gets no py-files, only
    # the functions' environment: put the package root on its PYTHONPATH
    root = os.path.dirname(pkg)
    current = sc.environment.get("PYTHONPATH", "")
    if root not in current.split(os.pathsep):
        sc.environment["PYTHONPATH"] = os.pathsep.join(x for x in (root, current) if x)
    _SHIPPED.add(app)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make sure ``DataFrame.checkpoint`` has a directory.

    The cluster names its shared folder in ``spark.checkpoint.dir``; that is
    used when present. Only a local-mode session without that setting (tests,
    laptops) gets a fresh temporary folder. On a cluster without the setting
    we refuse rather than write to a machine-local folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="candlewick-ckpt-"))
        return sc.getCheckpointDir()
    raise RuntimeError("set spark.checkpoint.dir to a shared folder before running sequential detectors")


_SCRATCH: list[str] = []


def release_scratch(spark: SparkSession) -> int:
    """Delete every intermediate written by ``cut_lineage`` so far (call once
    the results that read them have been consumed). Uses the Hadoop
    FileSystem of each path, so it works on any shared store."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    n = 0
    while _SCRATCH:
        path = jvm.org.apache.hadoop.fs.Path(_SCRATCH.pop())
        if path.getFileSystem(conf).delete(path, True):
            n += 1
    return n


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder that ``release_scratch`` deletes."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/candlewick/{name}-{uuid.uuid4().hex}"
    _SCRATCH.append(path)
    return path


def cut_lineage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Materialise ``df`` as parquet under the shared checkpoint folder and
    read it back: one computation (a reliable ``checkpoint()`` of an
    unpersisted plan computes it twice), durable across executor loss, and
    later reads get column pruning and filter pushdown."""
    path = scratch_folder(df.sparkSession, name)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.parquet(path)
