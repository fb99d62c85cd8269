"""Session helpers: a local session for tests and benches, and the shared
checkpoint folder used to cut lineage."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark import SparkFiles
from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "chronoframe") -> SparkSession:
    """A local session configured the way the tests and the bench expect.

    On a cluster, build the session with the cluster's own settings instead;
    nothing in the library depends on these values except the time zone,
    which only affects how wall-clock strings are parsed (H8).
    """
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared folder there; only a local-mode session (tests,
    bench) with nothing set falls back to a fresh scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
    configured = spark.conf.get("spark.checkpoint.dir", None)
    target = current or configured
    if not target:
        if not sc.master.startswith("local"):
            # A machine-local folder would vanish with its executor.
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor shares")
        target = tempfile.mkdtemp(prefix="chronoframe-ckpt-")
        spark.conf.set("spark.checkpoint.dir", target)
    if not current:
        sc.setCheckpointDir(target)
    return sc.getCheckpointDir() or target


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written intermediate tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, name) if "://" not in base else base.rstrip("/") + "/" + name


def ship(spark: SparkSession) -> None:
    """Give the Python workers of this application the package, once: a zip of its
    sources next to Spark's own driver files, handed out by ``addPyFile``."""
    sc = spark.sparkContext
    package = os.path.dirname(os.path.abspath(__file__))
    name = os.path.basename(package)
    if f"{name}.zip" in getattr(sc, "_python_includes", []):
        return
    folder = os.path.join(SparkFiles.getRootDirectory(), "shipped")
    os.makedirs(folder, exist_ok=True)
    target = os.path.join(folder, f"{name}.zip")
    with zipfile.ZipFile(target, "w") as z:
        for top, _, files in os.walk(package):
            for f in sorted(files):
                if f.endswith(".py"):
                    z.write(os.path.join(top, f), os.path.join(name, os.path.relpath(os.path.join(top, f), package)))
    sc.addPyFile(target)
