"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import posixpath
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.shared import folder as shared_folder

#: Most rows that one Arrow batch hands to Python; bounds a worker's memory when texts are long.
BATCH_ROWS = 512
#: Most rows of a few longs that a join sends to all executors (8 MB a column); larger sides are shuffled.
BROADCAST_ROWS = 500_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bound_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Keep Arrow batches small; a smaller setting of the session stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key, "10000")) > rows:
        spark.conf.set(key, str(rows))


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage: write to the shared folder and read back, so a lost executor costs nothing that came before."""
    spark = df.sparkSession
    path = shared_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def sized(df: DataFrame, rows: int) -> DataFrame:
    """``df``, to be broadcast where its counted (or at most) ``rows`` are few enough."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def table_of_few(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """Rows that the driver holds and whose number doesn't grow with the input, to be broadcast."""
    return F.broadcast(spark.createDataFrame(rows, schema))


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body``; keeps Catalyst from copying a costly expression."""
    return F.element_at(F.transform(F.array(value), body), 1)


def utf8_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes and the n + 1 offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def pieces(offsets: np.ndarray, most: int = 1 << 20):
    """Runs of rows (first, last + 1) of at most ``most`` bytes, or one longer row."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1
        j = min(n, max(i + 1, j))
        yield i, j
        i = j


def lean(run):
    """The Arrow function ``run``, after which a reused worker gives its free memory back."""

    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only some C libraries have it
            if trim is not None:
                trim(0)

    return wrapped


def file_system(uri: str):
    """The pyarrow file system and the path for a URI; a bare path is local."""
    from pyarrow import fs

    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri)


class SharedWriter:
    """A file that appears under its final name only when it is whole, so a retried task leaves no torn file."""

    def __init__(self, folder: str, name: str):
        self.fs, root = file_system(folder)
        self.fs.create_dir(root, recursive=True)
        self.path = posixpath.join(folder, name)
        self._final = posixpath.join(root, name)
        self._temp = posixpath.join(root, f".{name}.{uuid.uuid4().hex}")
        self._out = self.fs.open_output_stream(self._temp, compression=None)
        self.size = 0

    def write(self, data: bytes) -> None:
        self._out.write(data)
        self.size += len(data)

    def commit(self) -> None:
        self._out.close()
        self.fs.move(self._temp, self._final)

    def abandon(self) -> None:
        self._out.close()
        self.fs.delete_file(self._temp)
