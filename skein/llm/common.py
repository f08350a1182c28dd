"""What the operators of this subpackage share: the cluster's shared folder, written tables, label splits."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Prefix of internal columns, so that extra input columns never clash with them.
P = "__sk_"
#: Most bytes of an Arrow batch: texts of any length are held in small numbers.
_BATCH, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "4m"


_caches: dict[str, Callable[[], None]] = {}
_last = ""


def keeps_cache(owner: str, drop: Callable[[], None]) -> None:
    """Say how to drop what an operator keeps in a Python worker between its tasks."""
    _caches[owner] = drop


def fresh_task(owner: str) -> None:
    """First call of each function that runs in Python workers, which live through many stages.

    Drops what other operators keep there, and returns memory that earlier tasks left free to the system.
    """
    global _last
    if owner != _last:
        for name, drop in _caches.items():
            if name != owner:
                drop()
        gc.collect()
        _last = owner
    _release()


def _release() -> None:
    """Return free memory to the system."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such call
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of texts by bytes, not by rows only, unless the session does so itself."""
    if spark.conf.get(_BATCH, None) is None:
        spark.conf.set(_BATCH, BATCH_BYTES)


def map_arrow(df: DataFrame, f: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str, owner: str) -> DataFrame:
    """mapInArrow over batches of bounded size, in workers that hold nothing of other operators."""
    small_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fresh_task(owner)
        yield from f(batches)
        _release()  # the worker may idle through other stages

    return df.mapInArrow(run, schema)


def arrow_column(f: Callable[[pa.Array], pa.Array], schema: str, owner: str, column: Column) -> Column:
    """f of a column, batch by batch, as map_arrow runs it."""
    small_batches(SparkSession.active())

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        fresh_task(owner)
        for b in batches:
            yield f(b)
        _release()

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, schema)(column)


def shared_dir(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir, which all executors share.

    Only a local session without the setting gets a temporary folder of its own.
    """
    where = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if not where:
        where = sc.getCheckpointDir()
    if not where:
        if not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        where = tempfile.mkdtemp(prefix="skein-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(where)
    return where


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _own(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/tables/{spark.sparkContext.applicationId}"


_paths: list[str] = []


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new folder for a table in the application's part of the shared folder."""
    _paths.append(f"{_own(spark)}/{name}-{uuid.uuid4().hex}")
    return _paths[-1]


def written_so_far() -> list[str]:
    """The folders that fresh_path has given and nobody has dropped, in order."""
    return list(_paths)


def drop_written(spark: SparkSession, paths: list[str] | None = None) -> None:
    """Delete tables this application has written into the shared folder, all of them by default; for when no result needs them any more."""
    for name in [_own(spark)] if paths is None else paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    _paths[:] = [] if paths is None else [p for p in _paths if p not in set(paths)]


def written(df: DataFrame, name: str) -> DataFrame:
    """Write df as compressed Parquet into the shared folder and read it back."""
    path = fresh_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the decimal text of the id, modulo parts; null ids go to fold -1."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(parts)), F.lit(-1))
