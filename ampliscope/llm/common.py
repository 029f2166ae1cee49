"""What the training-data operators share: scratch tables and text buffers."""

from __future__ import annotations

import atexit
import ctypes
import re
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ampliscope.runtime import ship, trim  # noqa: F401  for the operators

#: Bytes of text that one numpy pass takes at a time inside an Arrow batch.
SLICE_BYTES = 4 << 20


def scratch_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share. Where none is set: a temporary one of a single machine's
    session, removed at its end, else a folder in the warehouse, which is shared as well."""
    conf = spark.sparkContext.getConf()
    base = spark.conf.get("spark.checkpoint.dir", None) or conf.get("spark.checkpoint.dir", None)
    if not base:
        if re.match(r"local(\[|$)", spark.sparkContext.master):
            own = tempfile.mkdtemp(prefix="ampliscope-")
            atexit.register(shutil.rmtree, own, ignore_errors=True)
            base = f"file://{own}"
        else:
            base = f"{spark.conf.get('spark.sql.warehouse.dir')}/ampliscope-scratch"
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write df as Parquet under the shared folder and read it back: the lineage ends here."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    give_back(spark)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def discard(df: DataFrame | None) -> None:
    """Delete a table of materialize() that nothing reads any more."""
    path = getattr(df, "_scratch_path", None)
    if path:
        spark = df.sparkSession
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a string column; a null counts as empty."""
    column = pc.fill_null(column, "").cast(pa.large_binary())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    return at, np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)


def slices(offsets: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of a batch that hold at most `most` bytes, or one longer row."""
    start, n = 0, len(offsets) - 1
    while start < n:
        end = int(np.searchsorted(offsets, offsets[start] + most, side="right")) - 1
        end = min(max(end, start + 1), n)
        yield start, end
        start = end


def _trim_python() -> None:
    pa.default_memory_pool().release_unused()
    own = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
    if own is not None:
        own(0)


def give_back(spark: SparkSession) -> None:
    """Freed memory of the driver, its JVM's and its Python's, goes back to the system."""
    trim(spark)
    _trim_python()


def settle(spark: SparkSession) -> None:
    """At the end of a part of a long operator: the driver's garbage is collected, as it holds the shuffle files and
    broadcasts of what is done, and its freed memory given back."""
    spark.sparkContext._jvm.System.gc()
    give_back(spark)


def trimmed(rows: Callable) -> Callable:
    """rows, a function for mapInArrow, that gives freed memory back to the system at a task's end: workers live on between tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from rows(batches)
        _trim_python()

    return run


def begin_of(text: str):
    """The first seven bytes of a text as a number that orders as texts do: a small key for ranges, null for null."""
    return F.conv(F.rpad(F.hex(F.substring(F.encode(F.substring(text, 1, 7), "UTF-8"), 1, 7)), 14, "0"), 16, 10).cast("long")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that df doesn't have."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def held_out(doc_id: str = "doc_id"):
    """True for the fifth of the documents that no model learns from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))
