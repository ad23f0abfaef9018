"""Helpers shared by the training-data operators: staging, files, words."""

from __future__ import annotations

import io
import os
import re
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from lagframe.session import scratch_path

# Documents per Arrow batch: texts may be long, so batches are kept short.
TEXT_BATCH_ROWS = 500
VECTORED_READS = "parquet.hadoop.vectored.io.enabled"

# Word characters are everything but space and the five ASCII controls 9-13;
# bytes.split() and bytes.translate() without arguments use the same set.
WORD = "[^\\x20\\x09-\\x0D]+"
SPACES = b" \t\n\x0b\x0c\r"
# Letters and, beyond ASCII, numerals that are none.
_LETTER_LIKE = re.compile(r"[^\W\d_]")


def has_letter(text: str) -> bool:
    """Whether the text has a character of Unicode's category L."""
    return any(m.group().isalpha() for m in _LETTER_LIKE.finditer(text))


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application.

    A package that was itself submitted as an archive is there already.
    """
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    app = spark.sparkContext.applicationId
    if app in _SHIPPED or not os.path.isdir(package):
        return
    archive = os.path.join(tempfile.mkdtemp(prefix="lagframe-"), "lagframe.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(package)))
    spark.sparkContext.addPyFile(archive)
    _SHIPPED.add(app)


def read_on_heap(spark: SparkSession) -> SparkSession:
    """No vectored Parquet reads, unless the session sets them.

    Those of files go through threads of their own, which keep native buffers as
    long as the column chunks they have read.
    """
    if spark.conf.get(VECTORED_READS, None) is None:
        spark.conf.set(VECTORED_READS, "false")
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Ship the package and keep Arrow batches of texts short."""
    ship(read_on_heap(spark))
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key, "10000")) > TEXT_BATCH_ROWS:
        spark.conf.set(key, str(TEXT_BATCH_ROWS))
    return spark


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of that many rows for the jobs run inside, where rows are short."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Columns by exact name, the first of that name, whatever else there is.

    Column lookup in Spark ignores case, so an extra ``TEXT`` beside
    ``text`` would be ambiguous; positions are not.
    """
    if len(set(c.lower() for c in df.columns)) == len(df.columns):
        return df.select(*names)
    at = positional(df)
    return at.select(*[F.col(f"c{df.columns.index(n)}").alias(n) for n in names])


def positional(df: DataFrame) -> DataFrame:
    """The frame with columns named c0, c1, ... in their order."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])


def releasing(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """``work`` for mapInArrow, giving back Arrow's free memory when a task ends: workers serve many."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(batches)
        finally:
            pa.default_memory_pool().release_unused()

    return run


def map_columns(df: DataFrame, work: Callable[[Iterator[dict[str, list]]], Iterable[dict]],
                schema: str) -> DataFrame:
    """``work`` over the Arrow batches of each partition, as lists by column.

    Lists keep nulls as None and integers exact, which pandas doesn't. What
    ``work`` yields, lists or Arrow arrays by column, becomes batches of
    ``schema``. Workers serve one task after another, so Arrow's free memory
    goes back when a task ends.
    """
    prepare(df.sparkSession)
    out = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        lists = ({n: c.to_pylist() for n, c in zip(b.schema.names, b.columns, strict=True)} for b in batches)
        for found in work(lists):
            yield pa.RecordBatch.from_arrays([x if isinstance(x := found[f.name], pa.Array) else pa.array(x, f.type)
                                              for f in out], schema=out)

    return df.mapInArrow(releasing(run), schema)


def number_lists(parts: list[np.ndarray]) -> pa.Array:
    """One list of 64-bit numbers per array, without Python numbers between."""
    if not parts:
        return pa.array([], pa.list_(pa.int64()))
    ends = np.cumsum([len(p) for p in parts])
    return pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()),
                                    pa.array(np.concatenate(parts).view(np.int64), pa.int64()))


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts lineage: a lost executor costs no recomputation, and every later
    pass reads only its columns.
    """
    path = scratch_path(read_on_heap(df.sparkSession), name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a URI or plain path, and the path within it."""
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    if "://" in path:
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


def make_folder(path: str) -> None:
    fs, at = filesystem(path)
    fs.create_dir(at, recursive=True)


def spread(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small list of work items, one to a partition."""
    if not rows:
        return spark.createDataFrame([], schema)
    return spark.createDataFrame(spark.sparkContext.parallelize(rows, len(rows)), schema)


def word_count(text) -> "F.Column":
    """Number of words of a text column; null counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


class RangeReader:
    """Byte ranges of one file in any folder that pyarrow can open."""

    def __init__(self, path: str):
        fs, at = filesystem(path)
        self.file = fs.open_input_file(at)
        self.size = self.file.size()

    def read(self, offset: int, length: int) -> bytes:
        data = self.file.read_at(length, offset)
        if len(data) != length:
            raise OSError(f"short read: {len(data)} of {length} bytes at {offset}")
        return data

    def __enter__(self) -> "RangeReader":
        return self

    def __exit__(self, *_) -> None:
        self.file.close()


def open_output(path: str) -> io.IOBase:
    fs, at = filesystem(path)
    return fs.open_output_stream(at, compression=None)
