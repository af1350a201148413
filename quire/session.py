"""Session helpers: local sessions for tests/bench, checkpoint directory lookup."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every session of this engine wants; the cluster may override any of them.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "quire", extra: dict | None = None) -> SparkSession:
    """A local session for tests and the bench (never used on a cluster)."""
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    The cluster names it in ``spark.checkpoint.dir``. Only a ``local`` master,
    whose driver and tasks are one process, gets a scratch folder where nothing is set; on a
    cluster that would be another disk on each executor, so it is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not is_local(sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="quire-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def is_local(master: str) -> bool:
    """Whether driver and tasks share one process (``local-cluster`` doesn't)."""
    return master == "local" or master.startswith("local[")


def _tables_folder(spark) -> str:
    """This application's folder below the checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/quire-tables/{spark.sparkContext.applicationId}"


def release_tables(spark) -> None:
    """Delete every table that this application has written with
    :func:`cut_lineage` or below :func:`scratch_path`. Call it when no result that reads them is
    needed any more."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(_tables_folder(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def cut_lineage(df, label: str = "t"):
    """Write ``df`` as parquet under the cluster's checkpoint folder and read
    it back: the returned DataFrame is a plain scan, so iterative jobs keep a
    constant-size plan (a checkpointed DataFrame still carries its origin plan).
    Written files survive executor loss."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.mode("overwrite").parquet(path)
    out = spark.read.parquet(path)
    out._stored_at = path
    return out


def forget(*tables) -> None:
    """Delete tables that :func:`cut_lineage` stored and that no plan reads any more (others are
    left alone), and have Spark's cleaner drop the shuffles to which nothing refers, so that
    rounds don't add up on the disks."""
    import gc
    paths = {t.__dict__.pop("_stored_at", None) for t in tables if t is not None} - {None}
    if not paths:
        return
    spark = next(t for t in tables if t is not None).sparkSession
    jvm = spark.sparkContext._jvm
    for path in paths:
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
    gc.collect()
    jvm.java.lang.System.gc()


def scratch_path(spark, label: str = "t") -> str:
    """A fresh folder name under the cluster's checkpoint folder."""
    import uuid
    return f"{_tables_folder(spark)}/{label}-{uuid.uuid4().hex}"


_SHIPPED: set = set()


def ship_package(spark) -> None:
    """Make ``quire`` importable in the Python workers (pandas UDFs,
    ``mapInPandas``) wherever the driver was started: the package is zipped
    once per process and added with ``SparkContext.addPyFile``, which Spark
    distributes to every executor."""
    import zipfile

    sc = spark.sparkContext
    key = id(sc._jsc) if hasattr(sc, "_jsc") else id(sc)
    if key in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    out_dir = tempfile.mkdtemp(prefix="quire-pkg-")
    zpath = os.path.join(out_dir, "quire.zip")
    with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as z:
        for base, _dirs, files in os.walk(pkg_dir):
            if "__pycache__" in base:
                continue
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(base, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(zpath)
    _SHIPPED.add(key)
