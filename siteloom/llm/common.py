"""Shared plumbing of the training-data operators.

* ``shared_dir`` / ``materialize`` cut lineage with Parquet written under the folder
  named by ``spark.checkpoint.dir``; nothing is kept on a single machine.
* ``is_small`` measures a table; only what it passes is broadcast, all else is joined by shuffles.
* ``Words`` turns an Arrow string column into flat numpy arrays of words, so that the
  text operators work on whole batches without a Python loop over words.
"""

from __future__ import annotations

import ctypes
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

U = np.uint64
#: Bytes of a table that may be broadcast, as ``is_small`` counts them; beyond it a shuffle join is used.
BROADCAST_BYTES = 64_000_000
#: Bytes of text that are turned into numpy arrays at once.
SLICE_BYTES = 4_000_000


def shared_dir(spark: SparkSession) -> str:
    """A folder of this application in the cluster's shared one (``spark.checkpoint.dir``); it goes when the application ends.

    A local folder is made only where none is set and everything runs in one process.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="siteloom-")
        context.setCheckpointDir(base)
    folder = f"{base.rstrip('/')}/siteloom-{context.applicationId}"
    if folder not in _ENDING:
        path = context._jvm.org.apache.hadoop.fs.Path(folder)
        system = path.getFileSystem(context._jsc.hadoopConfiguration())
        system.mkdirs(path)
        system.deleteOnExit(path)
        _ENDING.add(folder)
    return folder


_ENDING: set[str] = set()


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: no later job repeats its work, no executor's loss hurts it."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _bytes(name: str, kind: T.DataType) -> Column:
    column = F.col(f"`{name}`")
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(column), F.lit(0)) + 16
    if isinstance(kind, T.ArrayType):
        each = len(kind.elementType.fields) * 8 + 24 if isinstance(kind.elementType, T.StructType) else 8
        return F.coalesce(F.size(column), F.lit(0)) * each + 16
    return F.lit(8)


def is_small(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Whether the rows of ``df`` (longs, strings and arrays of fixed-size parts; it should be materialized) are below ``limit`` bytes as a hash relation."""
    width = F.lit(48)
    for field in df.schema.fields:
        width = width + _bytes(field.name, field.dataType)
    return (df.agg(F.sum(width.cast("long"))).first()[0] or 0) <= limit


def semi_filter(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """``df`` joined with ``ids`` (one row a key, materialized): broadcast if it is small, else both sides are shuffled."""
    return df.join(F.broadcast(ids) if is_small(ids) else ids.hint("merge"), key, "inner")


#: Rows and bytes of an Arrow batch, set where the session has Spark's own: ten thousand long texts at once are too much.
_BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "2000"), "spark.sql.execution.arrow.maxBytesPerBatch": ("67108864b", "8m")}


def lean(df: DataFrame) -> DataFrame:
    """``df``, in a session whose Arrow batches are small; what the session has set itself stays."""
    spark = df.sparkSession
    given = spark.sparkContext.getConf()
    for name, (default, ours) in _BATCH.items():
        if not given.contains(name) and spark.conf.get(name) == default:
            spark.conf.set(name, ours)
    return df


def shuffles(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def mix(x: np.ndarray) -> np.ndarray:
    """SplitMix64 finalizer, vectorised."""
    x = x + U(0x9E3779B97F4A7C15)
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


BASE = U(0x9E3779B97F4A7C15 | 1)
INVERSE = U(pow(int(BASE), -1, 1 << 64))


#: Powers by what they are of; ``release`` forgets those that a very long text has asked for.
KEPT: dict = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; the longest array so far is kept."""
    have = KEPT.get(int(base))
    if have is None or len(have) < n:
        have = np.empty(max(n, 1 << 16), U)
        have[0] = 1
        have[1:] = base
        np.multiply.accumulate(have, out=have)
        KEPT[int(base)] = have
    return have[:n]


#: Of the C library, where it has it.
_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)


def _lower_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    return t


LOWER = _lower_table()
#: Word bytes: ASCII letters and digits and every byte of a multi-byte character.
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[65:91] = _WORD[97:123] = True
_WORD[128:] = True
#: Anything but ASCII white space.
_SOLID = np.ones(256, bool)
_SOLID[[9, 10, 11, 12, 13, 32]] = False


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (from 0) and bytes of a string array; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    o = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    b = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return o - o[0], b[o[0] : o[-1]]


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES):
    """Cut a batch so that a piece has about ``limit`` bytes of text; a longer text is a piece of its own."""
    offsets, _ = buffers(batch.column(column))
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        yield batch.slice(at, end - at)
        at = end
    release()


def release() -> None:
    """Give freed memory back to the system: workers live on between stages, beside a full heap."""
    for key in [k for k, a in KEPT.items() if len(a) > 2 * SLICE_BYTES]:
        del KEPT[key]
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


class Words:
    """Flat words of a column of texts.

    bytes: lower-cased (ASCII) bytes of all texts; starts, ends: of the words in them; doc: the row of each word;
    first: index of each row's first word (len(rows) + 1); hash: a 64-bit hash of each word. With ``solid``, a word
    is what stands between white space, else a run of letters and digits.
    """

    def __init__(self, column: pa.Array, solid: bool = False, hashed: bool = True, lower: bool = True):
        self.offsets, raw = buffers(column)
        self.bytes = LOWER[raw] if lower else raw
        n = len(raw)
        inside = np.zeros(n + 1, bool)
        inside[:n] = (_SOLID if solid else _WORD)[raw]
        before = np.zeros(n + 1, bool)
        before[1:] = inside[:-1]
        cut = self.offsets[1:-1]
        before[cut] = False  # a text's first byte may start a word
        self.starts = np.flatnonzero(inside & ~before)
        ends = ~inside & np.concatenate(([False], inside[:-1]))
        ends[cut] |= np.concatenate(([False], inside[:-1]))[cut]
        self.ends = np.flatnonzero(ends)
        self.first = np.searchsorted(self.starts, self.offsets)
        self.count = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(self.count)), self.count)
        if hashed:
            power = powers(BASE, n + 1)
            sums = np.zeros(n + 1, U)
            terms = self.bytes.astype(U)
            terms += U(1)
            terms *= power[:n]
            np.cumsum(terms, out=sums[1:])
            del terms
            back = powers(INVERSE, n + 1)
            self.sums, self.back = sums, back
            self.hash = self.span(self.starts, self.ends)

    def span(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of any spans of bytes."""
        return mix((self.sums[ends] - self.sums[starts]) * self.back[starts])

    def word(self, i: int) -> bytes:
        return self.bytes[self.starts[i] : self.ends[i]].tobytes()


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k words, by its first word; there are k - 1 fewer."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.empty(0, U)
    out = np.zeros(n, U)
    for j in range(k):
        out = out * U(0xD6E8FEB86659FD93) + hashes[j : j + n]
    return mix(out)


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id and text (and what else is named); rows without a doc_id are dropped, a null text is an empty one."""
    return lean(docs).where("doc_id IS NOT NULL").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), *more
    )


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return lean(spark.read.parquet(f"{sf_dir}/{table}.parquet"))
