"""Session helpers: reading the input tables, and cutting lineage in a shared folder."""

from __future__ import annotations

import atexit
import io
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def session(name: str = "textloom", cores: str = "*", partitions: int = 8) -> SparkSession:
    """A local session with the settings the library relies on (UTC, adaptive execution, Arrow)."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shipped(spark: SparkSession) -> None:
    """Sends this package to the executors once a context: their Python workers need not have it on their path."""
    sc = spark.sparkContext
    if getattr(sc, "_textloom_shipped", False):
        return
    root, packed = Path(__file__).resolve().parent, io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, f"textloom/{p.relative_to(root)}")
    folder = f"{shared_folder(spark)}/textloom/{uuid.uuid4().hex}"
    path = sc._jvm.org.apache.hadoop.fs.Path(f"{folder}/textloom.zip")
    out = path.getFileSystem(sc._jsc.hadoopConfiguration()).create(path)
    out.write(bytearray(packed.getvalue()))
    out.close()
    atexit.register(_remove, spark, folder)
    sc.addPyFile(str(path.toString()))
    sc._textloom_shipped = True


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One input table; column pruning and filters reach the parquet scan."""
    shipped(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or a temporary one where that is unset (tests)."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    jsc = spark.sparkContext._jsc.sc()
    if jsc.getCheckpointDir().isEmpty():
        if not jsc.isLocal():
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="textloom-"))
    return jsc.getCheckpointDir().get().rstrip("/")


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared folder, so that lost executors cost no recomputation."""
    shipped(df.sparkSession)
    shared_folder(df.sparkSession)
    return df.checkpoint()


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # noqa: BLE001  the session may be gone already
        pass


def removed_at_exit(spark: SparkSession, path: str) -> str:
    """``path``, which is deleted when the session ends."""
    atexit.register(_remove, spark, path)
    return path


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once as compressed columns in the shared folder and read back; removed at exit."""
    spark = df.sparkSession
    shipped(spark)
    path = removed_at_exit(spark, f"{shared_folder(spark)}/textloom/{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
