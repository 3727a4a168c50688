"""What the operators share: session set-up, shared-folder tables and byte-bounded slices of Arrow batches."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from productlens.session import checkpoint_dir, ensure_utc, ship_package

#: Text bytes that a Python task works on at once; a single longer text is one slice.
SLICE_BYTES = 4 << 20


def prepare(spark: SparkSession) -> None:
    """Session settings that every operator with Python tasks needs; rows per Arrow batch follow their bytes."""
    ensure_utc(spark)
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, deleted when the driver's JVM ends."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table that no later step reads."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def written(df: DataFrame, label: str, options: dict[str, str] | None = None) -> tuple[DataFrame, str]:
    """``df`` as a parquet table in the shared folder (lineage ends there), and its path; ``options`` are the writer's."""
    spark = df.sparkSession
    path = shared_folder(spark, label)
    df.write.options(**(options or {})).parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def lower_ascii(c: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


#: The same for Python strings: ``text.translate(LOWER)``.
LOWER = {i: i + 32 for i in range(65, 91)}


def held_out(doc_id: Column, folds: int) -> Column:
    """True where crc32 of the id's decimal text leaves no remainder; NULL ids are held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % F.lit(folds) == 0, F.lit(True))


def slices(batches: Iterator[pa.RecordBatch], text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Each batch in row slices of about ``limit`` bytes of column ``text``, so memory does not follow the batch."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        block = np.cumsum(sizes, dtype=np.int64) // limit
        cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            yield batch.slice(a, b - a)


def texts_of(batch: pa.RecordBatch, text: str) -> list[str]:
    """The column's strings; NULL reads as empty."""
    return [t or "" for t in batch.column(text).to_pylist()]


def filtered(docs: DataFrame, text_col: str, start) -> DataFrame:
    """The rows of ``docs`` that pass, all columns as they are, without a shuffle.

    ``start()`` is called once in each task and returns ``keep(texts) -> bool array``.
    """
    prepare(docs.sparkSession)

    def run(batches):
        keep = start()
        for b in slices(batches, text_col, 1 << 20):
            yield b.filter(pa.array(keep(texts_of(b, text_col))))

    return docs.mapInArrow(run, docs.schema)


class WordTable:
    """Ids for strings in order of first sight, with what was computed for each; forgets all beyond ``limit``.

    Forgetting only costs a second computation. ``compute`` gets a list of new strings and extends the caller's arrays.
    """

    def __init__(self, compute, reset, limit: int = 600_000):
        self.compute, self.reset, self.limit, self.ids = compute, reset, limit, {}

    def see(self, lists: list[list[str]]) -> None:
        """Make every string of ``lists`` known."""
        if len(self.ids) > self.limit:
            self.ids.clear()
            self.reset()
        ids = self.ids
        new = list(set().union(*lists).difference(ids)) if lists else []
        if new:
            base = len(ids)
            ids.update(zip(new, range(base, base + len(new))))
            self.compute(new)

    def index(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.ids.__getitem__, words), dtype=np.int64, count=len(words))


class Growing:
    """A numpy array that grows by doubling."""

    def __init__(self, dtype, width: int = 0):
        self.shape, self.dtype = ((width,) if width else ()), dtype
        self.clear()

    def clear(self) -> None:
        self.data, self.size = np.empty((1024, *self.shape), self.dtype), 0

    def extend(self, values: np.ndarray) -> None:
        need = self.size + len(values)
        if need > len(self.data):
            grown = np.empty((max(need, 2 * len(self.data)), *self.shape), self.dtype)
            grown[: self.size] = self.data[: self.size]
            self.data = grown
        self.data[self.size: need] = values
        self.size = need


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions starts[0].., starts[1].. of the given lengths, one after another."""
    total = int(lengths.sum())
    if not total:
        return np.empty(0, np.int64)
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(total, dtype=np.int64)


def list_array(values: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    """One list per count from flat int32 values."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int32, copy=False)))
