"""Helpers shared by the operators of this package."""

from __future__ import annotations

import contextlib
import sys
import types
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Words are runs of anything but ASCII white space (space and \t..\r).
WORD_RE = r"[^\x20\x09-\x0D]+"
SPACE_RE = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z, every other character as it is."""
    return F.translate(c, UPPER, LOWER)


def words(text: Column) -> Column:
    """The words of a text as an array; null or blank text has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE_RE), lambda w: w != "")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the session names it."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        raise ValueError("set spark.checkpoint.dir to a folder shared by the driver and all executors")
    return path.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once below the shared folder and return it reread: its
    plan runs once, its lineage ends, and a lost executor loses none of it."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_stored(df: DataFrame) -> None:
    """Delete the files of a table made by :func:`stored`, once nothing reads it."""
    spark = df.sparkSession
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/llm-" not in path:
            raise ValueError(f"not a scratch table: {path}")
        jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
        jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)


def schema_with(df: DataFrame, **added: str) -> StructType:
    """The schema of ``df`` and some further columns, for ``mapInArrow``."""
    new = StructType.fromDDL(", ".join(f"`{name}` {kind}" for name, kind in added.items()))
    return StructType([*df.schema.fields, *new.fields])


def worker_cache(name: str, make):
    """A value kept for the life of a Python worker, made at first use.  Task
    code is unpickled anew for every task, so its own globals do not last."""
    store = sys.modules.setdefault("_quarry_worker_cache", types.ModuleType("_quarry_worker_cache"))
    if not hasattr(store, name):
        setattr(store, name, make())
    return getattr(store, name)


ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(df: DataFrame, rows: int = 1000) -> DataFrame:
    """``df``, its session set to hand Python at most ``rows`` rows at a time:
    rows that hold whole texts are large, and a batch lies in memory on both
    sides.  A lower setting is left as it is."""
    conf = df.sparkSession.conf
    now = int(conf.get(ARROW_ROWS, "10000"))
    if now <= 0 or now > rows:
        conf.set(ARROW_ROWS, str(rows))
    return df


def release_memory() -> None:
    """Hand freed memory back to the machine: a Python worker outlives its
    task, and its allocators would keep what the task needed most."""
    import ctypes

    import pyarrow as pa
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


@contextlib.contextmanager
def no_cycle_search():
    """Keep Python from looking for reference cycles again and again while
    many small objects are made that have none."""
    import gc
    on = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if on:
            gc.enable()


def slices(batches, rows: int = 256):
    """Arrow batches in pieces of a few rows, so that a task never holds all
    texts of a batch as Python objects.  At the end, memory is released."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)
    release_memory()


def text_bytes(column) -> list:
    """An Arrow string column as a list of UTF-8 ``bytes`` (None for null)."""
    import pyarrow as pa
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()
