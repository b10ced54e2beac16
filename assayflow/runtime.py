"""Session helpers: table access and lineage cuts that survive a lost executor."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()
_written: list[tuple[SparkSession, str]] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The whole Parquet table ``name`` of a data directory."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers of all executors, once per application.

    So batch functions find it whatever the workers' search path is.
    """
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = Path(__file__).parent
    archive = os.path.join(tempfile.mkdtemp(prefix="assayflow-code-"), "assayflow.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(archive)
    _shipped.add(sc.applicationId)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: the session's ``spark.checkpoint.dir``, else its checkpoint folder.

    Only where the session names none and runs in one process (tests, local mode) a
    temporary folder of this machine is made and stored in the session, so that later calls
    reuse it. On a cluster a missing setting is an error: a local folder would be another
    one on every executor.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not named:
        named = sc.getCheckpointDir()
    if not named:
        named = spark.conf.get("assayflow.shared.dir", None)
    if not named:
        if not is_local(sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        named = f"file://{tempfile.mkdtemp(prefix='assayflow-')}"
        spark.conf.set("assayflow.shared.dir", named)
    return named.rstrip("/")


def is_local(master: str) -> bool:
    """Driver and executors are one process on one machine."""
    return master == "local" or (master.startswith("local[") and master.endswith("]"))


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    This cuts the lineage like ``checkpoint()``, keeps column statistics for the planner
    and does not depend on any executor staying alive. The files are removed when the
    driver ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/assayflow-{label}-{uuid.uuid4().hex}"
    df.write.mode("error").parquet(path)
    _written.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


@atexit.register
def _remove_written() -> None:
    for spark, path in _written:
        try:
            jvm = spark.sparkContext._jvm
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
        except Exception:  # the session has ended; the folder's owner removes it
            pass
