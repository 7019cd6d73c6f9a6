"""Shared helpers: written intermediate tables, document keys, Arrow text access."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from truetally.session import checkpoint_dir


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder path under the shared checkpoint folder of the session."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def on_workers(spark: SparkSession) -> SparkSession:
    """Make this package importable in the Python workers (once per Spark context)."""
    sc = spark.sparkContext
    if not getattr(sc, "_truetally_shipped", False):
        root = Path(__file__).resolve().parent.parent
        target = os.path.join(tempfile.mkdtemp(prefix="truetally-"), "truetally-package.zip")
        with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
            for f in sorted(root.rglob("*.py")):
                z.write(f, f"{root.name}/{f.relative_to(root)}")
        sc.addPyFile(target)
        sc._truetally_shipped = True
    return spark


#: Bytes of an Arrow batch between the JVM and a Python worker (a longer row makes a batch of its own).
BATCH_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> SparkSession:
    """From now on rows reach Python workers of this session in batches of about ``BATCH_BYTES``.

    Spark's default of 64 MB is held by the JVM (twice while a batch grows) and by
    the worker at once, for every task of an executor."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def giving_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``batches``; at their end Arrow's pool returns its unused memory, as the worker outlives its task."""
    yield from batches
    pa.default_memory_pool().release_unused()


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    Cuts the lineage: later stages depend on files that every executor can
    reach, so a lost executor never forces a recomputation across this point.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def written_counting(df: DataFrame, name: str, flag: Column | None = None) -> tuple[DataFrame, int]:
    """:func:`written`, and how many of its rows there are (or have ``flag``), counted by the same job."""
    seen = Observation()
    counted = F.count(F.lit(1)) if flag is None else F.count_if(flag)
    out = written(df.observe(seen, counted.alias("n")), name)
    return out, seen.get["n"]


def small_side(df: DataFrame, max_rows: int) -> DataFrame:
    """``df`` (a written table) hinted for broadcast if its counted rows fit the bound, else as it is.

    Beyond the bound the join is an ordinary shuffled one.
    """
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names like the given ones that no column of ``df`` has."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def text_key(id_col: str, text_col: str) -> Column:
    """64-bit key of a document row: its id and its whole text (null: empty).

    Rows that agree in both get the same key, and every operator here gives
    such rows the same decision, so repeated rows need no row numbers.
    """
    return F.xxhash64(F.lit("tt"), F.col(id_col), F.coalesce(F.col(text_col), F.lit("")))


def string_buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string or binary array without copying; null counts as empty."""
    if col.null_count:
        col = col.fill_null("" if pa.types.is_string(col.type) or pa.types.is_large_string(col.type) else b"")
    big = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    kind = np.int64 if big else np.int32
    n = len(col)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(col.buffers()[1], kind)[col.offset:col.offset + n + 1].astype(np.int64)
    data = col.buffers()[2]
    buf = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return buf[off[0]:off[-1]], off - off[0]


def doc_chunks(off: np.ndarray, limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Split documents (given by byte offsets) into runs of about ``limit`` bytes.

    Bounds the working memory of the numeric kernels; a document is never
    split, so a longer one makes a run of its own.
    """
    n, i = len(off) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def runs_of(batches: Iterator[pa.RecordBatch], name: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Batches cut into runs of rows with about ``limit`` bytes in column ``name`` (a longer row makes a run of its own).

    What a step holds and hands on at a time then follows the run, not the batch."""
    for batch in batches:
        _, off = string_buffers(arrow_column(batch, name))
        for i, j in doc_chunks(off, limit):
            yield batch.slice(i, j - i)


def pack_batches(batches: Iterator[pa.RecordBatch], limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Texts (``_text``) compressed one by one (``_packed``), so that moving them costs less disk and network."""
    c = zstandard.ZstdCompressor(level=1)
    for batch in runs_of(batches, "_text", limit):
        buf, off = string_buffers(arrow_column(batch, "_text"))
        packed = [c.compress(buf[a:b]) if b > a else b"" for a, b in zip(off[:-1], off[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([arrow_column(batch, "_key"), arrow_column(batch, "_id"),
                                          pa.array(packed, pa.binary())], names=["_key", "_id", "_packed"])


def unpack(packed) -> bytes:
    return zstandard.decompress(packed) if len(packed) else b""


def arrow_column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))
