"""Session helpers: sessions for local use, tables, and cut points in the shared folder.

A cut point is a Parquet table in the folder that the cluster names in ``spark.checkpoint.dir``. It ends the lineage
like ``checkpoint()`` but is compressed and columnar, and every executor can read it, so a lost executor costs nothing
but the tasks it was running.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_LOCAL: dict[str, str] = {}


def local_session(cores: int = 8, shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and benchmarks."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("biblioweave")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give this package to the Python workers of the session, wherever they run; once for each application."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    _SHIPPED.add(app)
    root, folder = Path(__file__).resolve().parent, tempfile.mkdtemp(prefix="biblioweave-code-")
    atexit.register(shutil.rmtree, folder, True)
    archive = f"{folder}/biblioweave.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, f"{root.name}/{p.relative_to(root)}")
    spark.sparkContext.addPyFile(archive)  # Spark's own file server hands it to the executors


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table ``name`` of a data directory."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; where it is unset and the master is local, a temporary one."""
    conf = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        return conf.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = tempfile.mkdtemp(prefix="biblioweave-")
        atexit.register(shutil.rmtree, _LOCAL[app], True)
    return "file://" + _LOCAL[app]


def new_path(spark: SparkSession, label: str) -> str:
    """An unused path in the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def cut(df: DataFrame, label: str = "cut") -> DataFrame:
    """``df`` written to the shared folder and read from there: later steps don't run it again.

    The shuffle files that the write needed are deleted with its end, not when the driver happens to collect its garbage.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before) if before is not None else spark.conf.unset(CLEANUP)
    out = spark.read.schema(df.schema).parquet(path)
    out._cut_path = path  # for drop_cut
    return out


def drop_cut(df: DataFrame | None) -> None:
    """Delete the files of a cut point that no later step reads."""
    path = getattr(df, "_cut_path", None)
    if path is None:
        return
    jvm = df.sparkSession._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(target, True)

