"""Written tables that cut lineage and are reused by several jobs.

Every table goes below the folder named by ``spark.checkpoint.dir``, else the
warehouse, which all executors share, so losing an executor never loses a stage.
While a table is written its row count and in-memory size are observed, which is
what broadcast decisions are based on later.
"""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed cost per row of a broadcast hash relation: row header, pointer, hash slot.
ROW_OVERHEAD = 48

# How long to wait for the observed values after a table was written.
OBSERVATION_SECONDS = 60

# Session setting that says a file: path is mounted by all machines.
SHARED_MOUNT = "spark.starrung.sharedMount"

_local_root: list[str] = []
# Applications and folders of theirs that were tried out.
_shared_roots: set[tuple[str, str]] = set()


def shared_root(spark: SparkSession) -> str:
    """Folder for intermediate tables that all executors share; without one, a scratch folder in local mode only.

    It is the checkpoint folder of the session or, on a cluster without one, the warehouse. Where executors are
    processes of their own, a file: path may be a mount or each machine's own disk. It is tried out before it is
    used, unless the session says that all machines mount it, and refused if the trial does not show that it is shared.
    """
    master = spark.sparkContext.master
    local = master == "local" or master.startswith("local[")
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        checkpoint = spark.sparkContext._jsc.sc().getCheckpointDir()
        root = checkpoint.get() if checkpoint.isDefined() else None
    if not root and not local:
        root = spark.conf.get("spark.sql.warehouse.dir", None)
    if root:
        root = root.rstrip("/")
        if not local and spark.conf.get(SHARED_MOUNT, "false") != "true" and _is_local(spark, root):
            refusal = (f"{root} is not seen alike by the driver and all executors; name a shared folder as "
                       f"spark.checkpoint.dir, or set {SHARED_MOUNT} if it is one that all machines mount")
            try:
                shared = _is_shared(spark, root)
            except Exception as error:
                raise RuntimeError(refusal) from error
            if not shared:
                raise RuntimeError(refusal)
        return root
    if not local:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not _local_root:
        _local_root.append(tempfile.mkdtemp(prefix="starrung-"))
    return _local_root[0]


def _is_shared(spark: SparkSession, root: str) -> bool:
    """Whether the driver finds all that tasks write below a folder, and tasks can read it; tried once per session.

    There are two tasks per core, so all executors of that moment take part. What those see that join later is not known.
    """
    tried = spark.sparkContext.applicationId, root
    if tried not in _shared_roots:
        rows, path = 2 * max(spark.sparkContext.defaultParallelism, 1), f"{root}/starrung-{uuid.uuid4().hex}"
        try:
            spark.range(0, rows, 1, rows).write.parquet(path)
            found = spark.read.schema("id long").parquet(path).agg(F.count_distinct("id")).first()[0]
        finally:
            target, files = hadoop_path(spark, path)
            files.delete(target, True)
        if found < rows:
            return False
        _shared_roots.add(tried)
    return True


def _is_local(spark: SparkSession, root: str) -> bool:
    """Whether a path, by its scheme or by the default one, is on a machine's own disk."""
    return hadoop_path(spark, root)[1].getUri().getScheme() == "file"


def hadoop_path(spark: SparkSession, path: str):
    """A path and the file system it is on, by the settings that the session's readers and writers go by."""
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def _value_bytes(value: Column, kind: T.DataType) -> Column:
    """Bytes of one value in Spark's row format; numbers of fixed width take a word each, whatever their type."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(value), F.lit(0)) + F.lit(8)
    if isinstance(kind, T.ArrayType):
        items = kind.elementType
        if isinstance(items, (T.StringType, T.BinaryType, T.ArrayType, T.MapType, T.StructType)):
            held = F.aggregate(value, F.lit(0).cast("long"), lambda upto, item: upto + _value_bytes(item, items))
            return F.coalesce(held, F.lit(0)) + F.lit(16)
        return F.greatest(F.size(value), F.lit(0)).cast("long") * _value_bytes(F.lit(0), items) + F.lit(16)
    if isinstance(kind, T.MapType):
        keys = _value_bytes(F.map_keys(value), T.ArrayType(kind.keyType))
        return keys + _value_bytes(F.map_values(value), T.ArrayType(kind.valueType))
    if isinstance(kind, T.StructType):
        return reduce(add, [_value_bytes(value.getField(f.name), f.dataType) for f in kind.fields], F.lit(16))
    return F.lit(24 if isinstance(kind, T.DecimalType) and kind.precision > 18 else 8)


def row_bytes(df: DataFrame) -> Column:
    """Size one row takes in a broadcast relation, as a column; lists and structs by their lengths, without rendering them."""
    parts = [_value_bytes(F.col(f"`{field.name}`"), field.dataType) for field in df.schema.fields]
    return reduce(add, parts, F.lit(ROW_OVERHEAD)).cast("long")


@dataclass(frozen=True)
class Kept:
    """A table together with its measured size, and the columns in which it has NULLs."""

    df: DataFrame
    rows: int
    bytes: int
    nulls: frozenset[str]
    totals: dict = field(default_factory=dict)


def _measures(df: DataFrame) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("__rows"),
        F.coalesce(F.sum(row_bytes(df)), F.lit(0)).alias("__bytes"),
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"__null_{c}") for c in df.columns],
    ]


def _kept(df: DataFrame, found: dict, totals: Iterable[str] = ()) -> Kept:
    return Kept(
        df,
        found.get("__rows") or 0,
        found.get("__bytes") or 0,
        frozenset(c for c in df.columns if found.get(f"__null_{c}")),
        {total: found.get(total) or 0 for total in totals},
    )


def _observed(seen: Observation) -> dict | None:
    """Observed values, or None if their event got lost, as can happen on a busy driver."""
    found: list[dict] = []
    waiter = threading.Thread(target=lambda: found.append(seen.get), daemon=True)
    waiter.start()
    waiter.join(OBSERVATION_SECONDS)
    return found[0] if found else None


def measured(df: DataFrame) -> Kept:
    """``df`` as it is, measured by one aggregation over it."""
    return _kept(df, df.agg(*_measures(df)).first().asDict())


class Workspace:
    """Owns the intermediate tables of one run; use it as a context manager to drop them."""

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = f"{(root or shared_root(spark)).rstrip('/')}/starrung-{uuid.uuid4().hex}"
        self._count = 0

    def __enter__(self) -> Workspace:
        return self

    def __exit__(self, *exc) -> None:
        self.release()

    def path(self, name: str) -> str:
        self._count += 1
        return f"{self.root}/{self._count:03d}-{name}"

    def table(self, df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
        """Write ``df`` once and read it back with the same schema; for ratings and the like."""
        path = self.path(name)
        df.write.partitionBy(*partition_by).parquet(path)
        return self._read(df.schema, path, partition_by)

    def counted(self, df: DataFrame, name: str, partition_by: tuple[str, ...], **totals: Column) -> tuple[DataFrame, dict]:
        """``table`` with sums that are observed while it is written, over the written columns."""
        path = self.path(name)
        seen = Observation()
        sums = [column.alias(total) for total, column in totals.items()]
        df.observe(seen, *sums).write.partitionBy(*partition_by).parquet(path)
        back = self._read(df.schema, path, partition_by)
        return back, _observed(seen) or back.agg(*sums).first().asDict()

    def keep(self, df: DataFrame, name: str, **totals: Column) -> Kept:
        """Write ``df`` once and measure it on the way; for tables that may be looked up.

        ``totals`` are further sums to observe.
        """
        path = self.path(name)
        seen = Observation()
        extra = [column.alias(total) for total, column in totals.items()]
        df.observe(seen, *_measures(df), *extra).write.parquet(path)
        back = self._read(df.schema, path, ())
        found = _observed(seen) or back.agg(*_measures(back), *extra).first().asDict()
        return _kept(back, found, totals)

    def few(self, df: DataFrame, name: str, most: int = 10_000) -> Kept:
        """A table that is expected to be short: fetched if it has up to ``most`` rows, else written."""
        got = df.limit(most + 1).toArrow()
        if got.num_rows > most:
            return self.keep(df, name)
        nulls = frozenset(c for c in df.columns if got.column(c).null_count)
        size = got.nbytes + got.num_rows * ROW_OVERHEAD
        return Kept(self.spark.createDataFrame(got, schema=df.schema), got.num_rows, size, nulls)

    def _read(self, schema: T.StructType, path: str, partition_by: tuple[str, ...]) -> DataFrame:
        fields = [f for f in schema if f.name not in partition_by] + [schema[p] for p in partition_by]
        return self.spark.read.schema(T.StructType(fields)).parquet(path)

    def intact(self) -> bool:
        """Whether the tables written so far are still there."""
        path, files = hadoop_path(self.spark, self.root)
        return not self._count or files.exists(path)

    def release(self) -> None:
        """Delete everything this workspace wrote."""
        path, files = hadoop_path(self.spark, self.root)
        files.delete(path, True)
