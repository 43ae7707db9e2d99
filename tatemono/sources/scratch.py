"""Intermediate tables in the folder the cluster shares.

A table that several later jobs read is written once as parquet and read
back. That cuts the lineage, survives the loss of any executor, keeps columnar
pruning, and gives the optimizer the true size of the table.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHECKPOINT_CONF = "spark.checkpoint.dir"

# A table is broadcast only after its measured size turned out below this.
BROADCAST_BYTES = 32 * 1024 * 1024

_RUN = uuid.uuid4().hex
_own_folder: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; in local mode, where that
    is unset, a folder of this process that is removed at exit."""
    named = spark.conf.get(CHECKPOINT_CONF, None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
    if not _own_folder:
        folder = tempfile.mkdtemp(prefix="tatemono-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        _own_folder.append(folder)
    return _own_folder[0]


# names the folder of a scope; threads of a job inherit local properties
_SCOPE = "tatemono.scratch.scope"


def new_path(spark: SparkSession, name: str) -> str:
    """A path of this process in the shared folder that nothing uses yet."""
    scope = spark.sparkContext.getLocalProperty(_SCOPE)
    return lasting_path(spark, f"{scope}/{name}" if scope else name)


def lasting_path(spark: SparkSession, name: str) -> str:
    """The same, outside of any scope: it stays until all tables are removed."""
    return f"{shared_folder(spark)}/tatemono-{_RUN}/{name}-{uuid.uuid4().hex}"


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Deletes, at its end, the scratch tables that were stored inside it and
    no others. Results must be written elsewhere before."""
    outer = spark.sparkContext.getLocalProperty(_SCOPE)
    inner = f"{outer}/scope-{uuid.uuid4().hex}" if outer else f"scope-{uuid.uuid4().hex}"
    spark.sparkContext.setLocalProperty(_SCOPE, inner)
    try:
        yield
    finally:
        spark.sparkContext.setLocalProperty(_SCOPE, outer)
        _delete(spark, f"{shared_folder(spark)}/tatemono-{_RUN}/{inner}")


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new scratch table and return a scan of it."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove_tables(spark: SparkSession) -> None:
    """Delete every scratch table of this process, once no result that reads
    one is needed any more."""
    _delete(spark, f"{shared_folder(spark)}/tatemono-{_RUN}")


@dataclass(frozen=True)
class Size:
    rows: int
    bytes: int

    @property
    def broadcastable(self) -> bool:
        return self.bytes <= BROADCAST_BYTES


def _width(column: Column, kind: T.DataType) -> Column:
    slot = F.lit(16)
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(column), F.lit(0)) + slot
    if isinstance(kind, T.StructType):
        return sum((_width(column[f.name], f.dataType) for f in kind.fields), slot)
    if isinstance(kind, T.ArrayType) and not isinstance(kind.elementType, (T.StringType, T.BinaryType, T.StructType)):
        return F.coalesce(F.size(column), F.lit(0)) * slot + slot
    if isinstance(kind, (T.ArrayType, T.MapType)):
        return F.coalesce(F.octet_length(F.to_json(F.struct(column))), F.lit(0)) + slot
    return slot


def row_bytes(df: DataFrame) -> Column:
    """In-memory bytes of a row, on the high side."""
    return sum((_width(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields), F.lit(32)).cast("long")


def measure(df: DataFrame) -> Size:
    """Row count and in-memory size of a (stored) table; one small job."""
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(row_bytes(df)).alias("b")).first()
    return Size(row["n"], row["b"] or 0)


def fits(df: DataFrame, limit: int | None = None) -> bool:
    """Whether a stored table may be broadcast: up to ``limit`` bytes, by
    default ``BROADCAST_BYTES``."""
    return measure(df).bytes <= (BROADCAST_BYTES if limit is None else limit)
