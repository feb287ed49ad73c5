"""Helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallybook.session import checkpoint_dir


def ship(spark: SparkSession) -> None:
    """Have Spark send this package to the executors, whose Python workers import it. Once per session's context."""
    sc = spark.sparkContext
    if sc.applicationId not in _SHIPPED:
        root = Path(__file__).parents[1]
        file = Path(tempfile.mkdtemp(), f"{root.name}.zip")
        with zipfile.ZipFile(file, "w") as z:
            for f in sorted(root.rglob("*.py")):
                z.write(f, f.relative_to(root.parent))
        sc.addPyFile(str(file))
        _SHIPPED.add(sc.applicationId)


_SHIPPED: set[str] = set()


def staged(df: DataFrame, name: str, paths: list[str] | None = None) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back, so that later uses
    see one and the same result and a lost executor costs no recomputation. ``paths`` gets the folder, for :func:`dropped`."""
    path = scratch(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    if paths is not None:
        paths.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(spark: SparkSession, paths: list[str]) -> None:
    """Delete staged folders that nothing reads any more."""
    for p in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def scratch(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def apart(df: DataFrame) -> DataFrame:
    """``df`` with columns of its own, so that it can meet frames that share its origin."""
    return df.select(*[F.col(c).alias(c) for c in df.columns])


class Kept(dict):
    """A cache that makes missing values with ``make``; it keeps short keys only, ``most`` at a time. Python workers go on to
    other stages, so tasks empty it at their end (:meth:`clear`)."""

    def __init__(self, make: Callable, most: int = 100_000, longest: int = 64):
        super().__init__()
        self.make, self.most, self.longest = make, most, longest

    def __missing__(self, key):
        value = self.make(key)
        if len(key) <= self.longest:
            if len(self) >= self.most:
                self.clear()
            self[key] = value
        return value


def give_back() -> None:
    """Return the memory that earlier tasks of this Python worker have freed to the system, where its C library can."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass


def _bytes(*values: int) -> np.ndarray:
    among = np.zeros(256, bool)
    among[list(values)] = True
    return among


_WHITE, _CONTROL_WHITE = (9, 10, 11, 12, 13, 32), (28, 29, 30, 31)
_KIND = np.zeros(256, np.uint8)  # of letters, digits and signs (all but the apostrophe) of ASCII
for _k, _chars in enumerate((b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"), 1):
    _KIND[list(_chars)] = _k
_CUT, _BEFORE = _bytes(*_WHITE), _bytes(*_WHITE, *_CONTROL_WHITE)
#: First bytes of the characters beyond ASCII that are white space, and of many that aren't.
_WIDE = _bytes(0xE1, 0xE2, 0xE3)
_AFTER = _bytes(*_WHITE, *_CONTROL_WHITE, 0xC2, 0xE1, 0xE2, 0xE3)


def units(texts: pa.StringArray) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The texts cut before single ASCII white space characters and between letters, digits and signs of ASCII, and how many units
    each text has (one at least). No cut is made before white space that may have more of any kind on either side, so a run of it
    is never parted from itself or from what follows, and none beside an apostrophe."""
    texts = texts.cast(pa.string()).fill_null("")
    offsets, data = texts.buffers()[1:]
    bounds = np.frombuffer(offsets, np.int32)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int32)
    first, bounds = int(bounds[0]), bounds.astype(np.int64) - bounds[0]
    data = (data or pa.py_buffer(b"")).slice(first, int(bounds[-1]))
    raw = np.frombuffer(data, np.uint8)
    at = np.flatnonzero(_CUT[raw])
    at = at[(at > 2) & (at + 1 < len(raw))]
    before = raw[at - 1]
    white = _BEFORE[before] | (before >= 0x80) & ((raw[at - 2] == 0xC2) | _WIDE[raw[at - 3]])
    cut, kind = np.zeros(len(raw), bool), _KIND[raw]
    cut[1:] = (kind[1:] != kind[:-1]) & (kind[1:] > 0) & (kind[:-1] > 0)
    cut[at[~(white | _AFTER[raw[at + 1]])]] = True
    at = np.flatnonzero(cut)
    at = np.delete(at, (i := np.searchsorted(at, bounds))[np.append(at, -1)[i] == bounds])  # texts begin there anyway
    i = np.searchsorted(at, bounds)
    ends = np.append(np.insert(at, i[:-1], bounds[:-1]), bounds[-1]).astype(np.int32)
    return pa.StringArray.from_buffers(len(ends) - 1, pa.py_buffer(ends), data).dictionary_encode(), np.diff(i) + 1


def text_slices(b: pa.RecordBatch, column: str, most: int) -> Iterator[pa.RecordBatch]:
    """``b`` in slices of rows whose texts have about ``most`` bytes, one row at least."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(b.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at, done = 0, 0
    while at < b.num_rows:
        end = max(at + 1, int(np.searchsorted(sizes, done + most, "right")))
        yield b.slice(at, end - at)
        at, done = end, int(sizes[end - 1])


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` doesn't have yet."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def in_fold(doc_id: Column, folds: int, fold: int) -> Column:
    """crc32(doc_id as text) mod ``folds`` = ``fold``; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def ranked(df: DataFrame, order: list[Column], name: str, per: list[str] = ()) -> DataFrame:
    """``df`` with its 0-based ``rank`` in the given order (within ``per``, which the order must
    begin with). Rows are dealt out by range, so a hot value of ``per`` spreads over tasks; only one
    count per (partition, ``per``) meets in a window."""
    cols = df.columns
    n = partitions(df.sparkSession)
    part, at = F.shiftright("_at", 33), F.col("_at").bitwiseAND((1 << 33) - 1)
    rows = staged(df.repartitionByRange(n, *order).sortWithinPartitions(*order)
                  .withColumn("_at", F.monotonically_increasing_id())
                  .select(*cols, part.alias("_part"), at.alias("_row")), name)
    key = ["_part", *per]
    runs = rows.groupBy(*key).agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy(*per).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    runs = runs.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    runs = runs.select(*[F.col(k).alias(f"_run{i}") for i, k in enumerate(key)], "_first", "_before")
    same = [F.col(k).eqNullSafe(F.col(f"_run{i}")) for i, k in enumerate(key)]
    return rows.join(runs, same, "left").select(*cols, (F.col("_before") + F.col("_row") - F.col("_first")).alias("rank"))
