"""Helpers shared by the training-data operators: tables, the shared folder, written intermediate tables."""

from __future__ import annotations

import atexit
import gc
import tempfile
import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; a temporary one only where that is unset (tests)."""
    sc = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not found and sc._jsc.sc().getCheckpointDir().isDefined():
        found = sc._jsc.sc().getCheckpointDir().get()
    if not found:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        if sc.applicationId not in _own:
            _own[sc.applicationId] = "file://" + tempfile.mkdtemp(prefix="matchloom-")
        found = _own[sc.applicationId]
    return f"{found.rstrip('/')}/matchloom-{sc.applicationId}"


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # the session may have ended before the interpreter
        return


def written(df: DataFrame, label: str) -> DataFrame:
    """Writes df to the shared folder as Parquet and reads it back: short lineage that survives lost executors.

    All such tables of an application lie in one folder named by it. drop() frees one; the rest goes at the interpreter's end.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    atexit.register(_remove, spark, path)
    out = spark.read.schema(df.schema).parquet(path)
    out._matchloom_path = path
    return out


def drop(*tables: DataFrame | None) -> None:
    """Deletes tables that written() returned, once nothing that is still to run reads them."""
    for df in tables:
        if df is not None and (path := getattr(df, "_matchloom_path", None)):
            _remove(df.sparkSession, path)


def free_shuffles(spark: SparkSession) -> None:
    """Files of shuffles that no DataFrame refers to any more go when the driver's JVM collects garbage; this asks for it.

    What Python has let go is told to the JVM by a thread that wakes every few seconds.
    """
    gc.collect()
    time.sleep(3)
    spark.sparkContext._jvm.System.gc()


_batches: dict[str, str] = {}


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Long texts make 10,000-row Arrow batches large; a setting of the user's own stays. Sets the session's number of rows
    a batch, as Spark reads it when a plan runs, and never raises what an operator has set before."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = spark.conf.get(key, "10000")
    if now in ("10000", _batches.get(spark.sparkContext.applicationId)):
        _batches[spark.sparkContext.applicationId] = str(min(int(now), rows))
        spark.conf.set(key, _batches[spark.sparkContext.applicationId])


def let(value: Column, body) -> Column:
    """body(value) with value computed once, though body names it many times."""
    return F.element_at(F.transform(F.array(value), body), 1)


def space_words(text: Column) -> Column:
    """Words [^\\x20\\x09-\\x0D]+ of a text as an array; of null, an empty array."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), _SPACE), "")
