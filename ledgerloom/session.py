"""The Spark session and the cutting of lineage."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_session(name: str = "ledgerloom", master: str | None = None, **conf: str) -> SparkSession:
    """The active session, or a new one with the settings this library is tested with."""
    builder = SparkSession.builder.appName(name).config(map=CONF | {k.replace("__", "."): v for k, v in conf.items()})
    spark = (builder.master(master) if master else builder).getOrCreate()
    ship(spark)
    return spark


def ship(spark: SparkSession) -> None:
    """Give this package to the Python workers of the session's executors, once."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    _SHIPPED.add(sc.applicationId)
    root = Path(__file__).parent
    file = Path(tempfile.mkdtemp(prefix="ledgerloom-code-")) / "ledgerloom.zip"
    with zipfile.ZipFile(file, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    sc.addPyFile(str(file))


_SHIPPED: set[str] = set()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by the cluster in spark.checkpoint.dir. Only a session on one machine may do without: its
    executors are the driver's process, and get a folder of that machine. Elsewhere a missing setting is an error.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if sc.getCheckpointDir() is None:
        if not named and not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all machines of the cluster share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="ledgerloom-checkpoint-"))
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Compute df now, keep it as a Parquet table in the checkpoint folder and forget how it was made.

    The copy is on shared storage, so a lost executor costs the tasks it was running and nothing more. It is compressed,
    read by column, and its size is known to the planner; the plan of what follows starts afresh, without the
    constraints and statistics that a chain of checkpoints in an iteration would gather. The table is deleted by
    release, or when Python ends.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    if not _TABLES:
        atexit.register(_delete_all)
    _TABLES[path] = spark
    out = spark.read.schema(df.schema).parquet(path)
    out._cut_at = path  # for release
    return out


def scratch(spark: SparkSession) -> str:
    """A new folder in the checkpoint folder, deleted when Python ends."""
    path = f"{checkpoint_dir(spark)}/scratch-{uuid.uuid4().hex}"
    if not _TABLES:
        atexit.register(_delete_all)
    _TABLES[path] = spark
    return path


_TABLES: dict[str, SparkSession] = {}


def release(*tables: DataFrame) -> None:
    """Delete tables made by cut that nothing reads any more."""
    for df in tables:
        path = getattr(df, "_cut_at", None)
        if path and (spark := _TABLES.pop(path, None)):
            where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def _delete_all() -> None:
    for path, spark in list(_TABLES.items()):
        try:
            where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
        except Exception:  # noqa: BLE001 - the session may be gone already; the folder's owner cleans up then
            return
    _TABLES.clear()
