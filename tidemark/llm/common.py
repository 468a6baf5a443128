"""Helpers shared by the training-data operators: inputs, lineage cuts, Arrow maps."""

from __future__ import annotations

import ctypes
import os
import sys
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A side is hinted for broadcast only while its measured text stays under this size.
BROADCAST_BYTES = 64 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    A scratch folder is chosen only where the setting is missing and the master
    is local (tests); on a cluster a missing setting is an error.
    """
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if base:
        return base.rstrip("/")
    if not sc.master.startswith("local[") and sc.master != "local":
        raise ValueError("spark.checkpoint.dir must name a folder shared by all executors")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-llm-"))
    return sc.getCheckpointDir().rstrip("/")


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends here, so a
    lost executor costs its running tasks and not the work before this point."""
    path = f"{shared_dir(df.sparkSession)}/tidemark/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once for each Spark context, wherever they start."""
    sc = spark.sparkContext
    if getattr(sc, "_tidemark_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    path = os.path.join(tempfile.mkdtemp(prefix="tidemark-py-"), f"tidemark-{uuid.uuid4().hex}.zip")
    with zipfile.ZipFile(path, "w") as out:
        for folder, _, names in os.walk(os.path.join(root, "tidemark")):
            for name in names:
                if name.endswith(".py"):
                    out.write(os.path.join(folder, name), os.path.relpath(os.path.join(folder, name), root))
    sc.addPyFile(path)
    sc._tidemark_shipped = True


#: Bytes of a batch on its way to Python, and of the slices that functions are handed.
BATCH_BYTES, SLICE_BYTES = 8 << 20, 4 << 20


def slices(batches: Iterator[pa.RecordBatch], limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in views of about ``limit`` bytes, one row at least: a batch of many or long
    texts is never turned into Python values as a whole."""
    for batch in batches:
        step = max(1, int(batch.num_rows * limit / max(1, batch.nbytes)))
        for at in range(0, max(1, batch.num_rows), step):
            yield batch.slice(at, step)
        del batch


def release() -> None:
    """Give memory that a finished task no longer uses back to the system: idle workers live on."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:
            trim(0)


def arrow_map(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | T.StructType) -> DataFrame:
    """``mapInArrow`` of ``fn`` over slices of a few MB; what they held goes back to the system.  The session's
    limit on the bytes of an Arrow batch is lowered to BATCH_BYTES, so a worker and the
    executor's buffers beside it hold little at a time."""
    ship(df.sparkSession)
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from fn(slices(batches))
        release()

    return df.mapInArrow(run, schema)


def byte_views(texts: pa.Array) -> list[memoryview | None]:
    """The UTF-8 bytes of each text where Arrow holds them, without a copy."""
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int32, len(texts) + 1, 4 * texts.offset).tolist() if len(texts) else [0]
    raw = memoryview(data if data is not None else b"").cast("B")
    full = texts.is_valid().to_pylist() if texts.null_count else [True] * len(texts)
    return [raw[ends[i]:ends[i + 1]] if ok else None for i, ok in enumerate(full)]


def text_array(raw: list[bytes]) -> pa.Array:
    """UTF-8 bytes as an Arrow text column."""
    return pa.array(raw, pa.binary()).view(pa.string())


def held_out(doc_id: Column) -> Column:
    """True where crc32 of the id as text leaves 0 modulo 5; a null id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def small(df: DataFrame, bytes_of: Column, limit: int = BROADCAST_BYTES) -> tuple[DataFrame, bool]:
    """``df`` hinted for broadcast if its measured size is within ``limit``, else as it
    is (a shuffle join follows), and which of the two it was."""
    fits = (df.agg(F.sum(bytes_of + F.lit(64))).first()[0] or 0) <= limit
    return (F.broadcast(df) if fits else df), fits


#: Bits of the map behind :func:`maybe`: at most 4 MiB are broadcast, at every input size.
MAP_BITS = 1 << 25


def maybe(df: DataFrame, key: Column, keys: DataFrame, key_of: Column) -> DataFrame:
    """``df`` with ``_maybe``: False where ``key`` is surely none of ``key_of`` in ``keys``.

    The keys' hashes are set in a bit map of fixed size, which is broadcast.  It only
    spares a join rows to shuffle; once it is full every row may match.
    """
    spot = F.pmod(F.xxhash64(key_of), F.lit(MAP_BITS))
    bits = keys.select(spot.alias("_s")).groupBy(F.call_function("bitmap_bucket_number", "_s").alias("_bucket")) \
        .agg(F.call_function("bitmap_construct_agg", F.call_function("bitmap_bit_position", "_s")).alias("_bits"))
    own = df.withColumn("_s", F.pmod(F.xxhash64(key), F.lit(MAP_BITS))) \
        .withColumn("_bucket", F.call_function("bitmap_bucket_number", "_s"))
    at = F.call_function("bitmap_bit_position", "_s")
    byte = F.conv(F.hex(F.substring(F.col("_bits"), (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_set = F.getbit(byte, (at % 8).cast("int")) == 1
    return own.join(F.broadcast(bits), "_bucket", "left").withColumn("_maybe", F.coalesce(is_set, F.lit(False))).drop("_bucket", "_s", "_bits")


def may_match(df: DataFrame, key: Column, keys: DataFrame, key_of: Column) -> DataFrame:
    """``df`` without most rows whose ``key`` is none of ``key_of`` in ``keys``; loses none that is."""
    return maybe(df, key, keys, key_of).where("_maybe").drop("_maybe")
