"""Reading the Parquet tables and keeping intermediate results."""

from __future__ import annotations

import atexit
import io
import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: Where this package lies; Python workers of this machine look for it there too.
_HOME = Path(__file__).resolve().parents[2]


def is_local(spark: SparkSession) -> bool:
    """Whether all tasks run on the driver's machine."""
    return spark.sparkContext.master.startswith("local[") or spark.sparkContext.master == "local"


def importable(spark: SparkSession) -> None:
    """Lets the session's Python workers import this package: from where the driver has it, and on a cluster from a copy that is shipped."""
    sc = spark.sparkContext
    paths = sc.environment.get("PYTHONPATH", "").split(os.pathsep)
    if str(_HOME) not in paths:
        sc.environment["PYTHONPATH"] = os.pathsep.join([str(_HOME), *filter(None, paths)])
    if not is_local(spark) and not hasattr(sc, "_pagelattice_shipped"):
        held = io.BytesIO()
        with zipfile.ZipFile(held, "w") as z:
            for f in sorted((_HOME / "pagelattice").rglob("*.py")):
                z.write(f, f.relative_to(_HOME))
        path = f"{shared_dir(spark).rstrip('/')}/pagelattice-{uuid.uuid4().hex}.zip"
        write_bytes(spark, path, held.getvalue())
        sc.addPyFile(path)
        sc._pagelattice_shipped = path


def write_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    """Writes a file from the driver to any file system that the session knows."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = where.getFileSystem(spark._jsc.hadoopConfiguration()).create(where, True)
    out.write(bytearray(data))
    out.close()


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """One table of a data directory; with columns, only these are scanned."""
    importable(spark)
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as spark.checkpoint.dir names it; where that is unset, a fresh local one on one machine, else RuntimeError."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not is_local(spark):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    if not hasattr(spark.sparkContext, "_pagelattice_dir"):
        spark.sparkContext._pagelattice_dir = "file://" + tempfile.mkdtemp(prefix="pagelattice-")
    return spark.sparkContext._pagelattice_dir


#: Tables of this driver that are there still.
_KEPT: list[str] = []


def forget(spark: SparkSession) -> int:
    """Deletes all tables kept so far, once their results are written: between the queries of a long session. Returns how many."""
    n = len(_KEPT)
    while _KEPT:
        path = _KEPT.pop()
        try:
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
        except Exception:  # noqa: BLE001  the session may be gone; the folder is the cluster's to clean then
            pass
    return n


def kept(df: DataFrame) -> DataFrame:
    """Writes df as a table in the shared folder and returns the reader of it.

    Cuts the lineage: an executor lost later costs a read, not a recomputation, and what is
    derived twice from df is computed once. The table is deleted by forget, or when the driver ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/kept-{uuid.uuid4().hex}"
    df.write.parquet(path)
    if not _KEPT:
        atexit.register(forget, spark)
    _KEPT.append(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, rows_per_task: int, n: int, *by) -> DataFrame:
    """df hashed into about n / rows_per_task partitions, at least those of the session."""
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n // rows_per_task))
    return df.repartition(parts, *by) if by else df.repartition(parts)


def within(df: DataFrame, limit: int) -> bool:
    """Whether df has at most limit rows; counts no more than limit + 1."""
    return df.limit(limit + 1).agg(F.count("*")).first()[0] <= limit


def within_bytes(df: DataFrame, limit: int, size) -> bool:
    """Whether the sizes of all rows of df, a column expression, come to at most limit."""
    return (df.agg(F.sum(size.cast("long"))).first()[0] or 0) <= limit


def closed_list(df: DataFrame, most: int) -> list:
    """All rows of a list that is closed; ValueError if it has more than most."""
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"a closed list of {df.columns} has more than {most} rows")
    return rows
