"""Results that several consumers of one job read: written once, read by each, deleted when the job ends."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tallybook.session import checkpoint_dir

#: Tables of more rows than this are joined in SLICES slices by their key, one after the other, so that the shuffle files of
#: one slice only lie on disk at a time. Every row is in one slice.
SLICED_ROWS = 1_000_000
SLICES = 8
_SLICE = "__slice"
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def slices_for(*tables: DataFrame, keys: Iterable[list[tuple[DataFrame, str]]] = ()) -> int:
    """Number of slices in which to join these tables, whose rows are counted. ``keys`` lists the columns that meet in a join:
    those of different types, which a join converts, have different hashes, so such tables are not sliced."""
    if any(len({t.schema[c].dataType for t, c in columns}) > 1 for columns in keys):
        return 1
    return SLICES if sum(t.count() for t in tables) > SLICED_ROWS else 1


def slice_of(n: int, *key: Column) -> Column:
    """The slice of a key. The second number keeps it from going with other hashes of the same key."""
    return F.pmod(F.xxhash64(*key, F.lit("slice")), F.lit(n)).cast("int")


class StageStore:
    """A folder of its own under ``spark.checkpoint.dir`` for one job's staged results.

    >>> with StageStore(spark) as store:                      # doctest: +SKIP
    ...     sales_export(model, store).write.parquet(out)

    A stage survives the loss of executors, since it lies in the folder that all of them share, and later reads plan with its real size.
    What reads a stage must run before the store is closed. Without ``with`` the folder stays until :meth:`close`.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{checkpoint_dir(spark).rstrip('/')}/stages-{uuid.uuid4().hex}"
        self.written: dict[str, DataFrame] = {}

    def stage(self, name: str, df: DataFrame) -> DataFrame:
        """``df`` from disk; a name that is already there is not computed again."""
        if name not in self.written:
            self._write(df, name)
            self.written[name] = self.spark.read.schema(df.schema).parquet(f"{self.root}/{name}")
        return self.written[name]

    def stage_slices(self, name: str, parts: DataFrame | Iterable[DataFrame], n: int, at: Column) -> list[DataFrame]:
        """``n`` slices of the rows of ``parts``, which are written one after the other; ``at`` is the number of a row's slice."""
        path = f"{self.root}/{name}"
        for df in [parts] if isinstance(parts, DataFrame) else parts:
            schema = df.schema
            self._write(df.withColumn(_SLICE, at), name, _SLICE)
        read = self.spark.read.schema(StructType([*schema.fields, StructField(_SLICE, IntegerType())])).parquet(path)
        return [read.where(F.col(_SLICE) == k).drop(_SLICE) for k in range(n)]

    def stage_all(self, name: str, parts: Iterable[DataFrame]) -> DataFrame:
        """The rows of all ``parts``, which are written one after the other."""
        for df in parts:
            schema = df.schema
            self._write(df, name)
        return self.spark.read.schema(schema).parquet(f"{self.root}/{name}")

    def _write(self, df: DataFrame, name: str, by: str | None = None) -> None:
        """The shuffle files of this job go when it ends, not when the driver happens to collect its garbage."""
        old = self.spark.conf.get(_CLEAN, None)
        self.spark.conf.set(_CLEAN, "true")
        try:
            w = df.write.mode("append").option("compression", "zstd")
            (w.partitionBy(by) if by else w).parquet(f"{self.root}/{name}")
        finally:
            self.spark.conf.unset(_CLEAN) if old is None else self.spark.conf.set(_CLEAN, old)

    def drop(self, name: str, k: int | None = None) -> None:
        """A stage, or one of its slices, that nothing reads any more."""
        self._delete(f"{self.root}/{name}" + ("" if k is None else f"/{_SLICE}={k}"))
        if k is None:
            self.written.pop(name, None)

    def _delete(self, folder: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def close(self) -> None:
        self._delete(self.root)
        self.written.clear()

    def __enter__(self) -> "StageStore":
        return self

    def __exit__(self, *exc) -> None:
        self.close()
