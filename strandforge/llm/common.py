"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Rows that a Python worker turns into Python objects at a time.
SLICE = 512


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Where it is unset, a local master gets a temporary folder (driver and
    executors are one process there); any other master must set it.
    """
    conf = spark.sparkContext.getConf()
    if found := conf.get("spark.checkpoint.dir"):
        return found.rstrip("/")
    if not conf.get("spark.master", "").startswith("local[") and conf.get("spark.master") != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    global _LOCAL
    if _LOCAL is None:
        _LOCAL = "file://" + tempfile.mkdtemp(prefix="strandforge-")
    return _LOCAL


_LOCAL: str | None = None


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back, which cuts the lineage.

    A lost executor then costs the tasks it ran, not the whole history.
    """
    spark = df.sparkSession
    lean_session(spark)
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Bytes of a batch, to a Python worker and back: executors keep the direct memory of their largest ones.
BATCH_BYTES = 1 << 20
#: The session's settings. A few thousand rows can be any number of bytes; vectored reads of Parquet keep direct
#: memory of the size of a file's part in each of their threads.
SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(BATCH_BYTES),
    "parquet.hadoop.vectored.io.enabled": "false",
}


def lean_session(spark: SparkSession) -> None:
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)


def bounded(batch: pa.RecordBatch, most: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in parts of at most `most` bytes, or of one row; nothing is copied."""
    if batch.nbytes <= most or batch.num_rows < 2:
        yield batch
    else:
        half = batch.num_rows // 2
        yield from bounded(batch.slice(0, half), most)
        yield from bounded(batch.slice(half), most)


@cache
def _lean() -> Callable[[], object]:
    """Lets a Python worker give big arrays back to the system as soon as it drops them; returns what gives back the rest.

    Workers serve many tasks, and several share an executor's memory.
    """
    pa.set_memory_pool(pa.system_memory_pool())
    libc = ctypes.CDLL(None)
    if hasattr(libc, "mallopt"):
        libc.mallopt(-3, 1 << 18)  # M_MMAP_THRESHOLD: larger blocks are mapped, each for itself
    return (lambda: libc.malloc_trim(0)) if hasattr(libc, "malloc_trim") else (lambda: None)


def arrow_map(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: T.StructType | str) -> DataFrame:
    """df.mapInArrow(run, schema) in workers that keep little memory. It sets the session's SETTINGS."""
    lean_session(df.sparkSession)

    def lean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trim = _lean()
        try:
            for made in run(batches):
                yield from bounded(made)
        finally:
            gc.collect()
            trim()

    return df.mapInArrow(lean, schema)


def text_bytes(batch: pa.RecordBatch, column: str = "text") -> Iterator[bytes]:
    """UTF-8 of a text column, null as empty."""
    for x in batch.column(column).cast(pa.large_binary()):
        yield x.as_py() or b""


def with_results(
    df: DataFrame,
    results: T.StructType,
    compute: Callable[[], Callable[[pa.RecordBatch], list[pa.Array]]],
    keep: list[str] | None = None,
    row_filter: bool = False,
) -> DataFrame:
    """df's columns (or `keep` of them) and those of `results`, computed batch by batch in Python workers.

    compute() runs once in each task and returns the function from a record
    batch to the arrays of `results`. An input column named like a result gives
    way to it. With row_filter, the last array is a mask, and only rows
    where it is true stay.
    """
    names = [f.name for f in results]
    kept = [c for c in (df.columns if keep is None else keep) if c not in names]
    schema = T.StructType([df.schema[c] for c in kept] + list(results))
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = compute()
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE):
                batch = whole.slice(at, SLICE)
                made = f(batch)
                arrays = [batch.column(c).cast(arrow.field(c).type) for c in kept] + made[: len(names)]
                out = pa.RecordBatch.from_arrays(arrays, schema=arrow)
                yield out.filter(made[-1]) if row_filter else out

    return arrow_map(df, run, schema)


def need(df: DataFrame, columns: list[str]) -> DataFrame:
    """Those columns; a text that isn't a string is cast."""
    return df.select(*[F.col(f"`{c}`").cast("string").alias(c) if c == "text" else F.col(f"`{c}`") for c in columns])


def unit(column, seed: str):
    """A number in (0, 1) that depends on column's value and seed alone, from md5's first 48 bits."""
    hexed = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(column.cast("string"), F.lit("")))), 1, 12)
    return (F.conv(hexed, 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(2**48))
