"""Helpers shared by the training-data operators."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows in one Arrow batch to Python. Texts can be long, so batches stay small.
BATCH_ROWS, BATCH_BYTES = 512, 4 << 20
#: Bytes of text that the vectorised code takes on at once (a longer text is one block).
BLOCK_BYTES = 1 << 17
#: Word characters are all but the ASCII blanks; this is the same class as ``WORD``.
WORD = r"[^\x20\x09-\x0D]+"
#: Odd 64-bit multipliers for the hashes below.
_P = np.uint64(0x9E3779B97F4A7C15)
_M1 = np.uint64(0xBF58476D1CE4E5B9)
_M2 = np.uint64(0x94D049BB133111EB)


#: A stored table may take so many times its files' bytes in memory; what is small enough to broadcast is judged by that.
UNPACKED = 16


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Bound what memory holds at once: Arrow batches sent to Python, and tables that Spark broadcasts by itself."""
    spark.conf.set("spark.sql.sources.fileCompressionFactor", str(UNPACKED))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


@cache
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="lorewell-")


def shared_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names; where a local session leaves it unset, as in tests, one of our own."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return (named or _own_folder()).rstrip("/")


#: Whether shuffle files go when the query that made them ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with a table written to the shared folder, compressed by column, and read again.

    Executors that are lost take nothing of it with them. ``forget`` deletes the table.
    """
    path = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP, "false")
    conf.set(CLEANUP, "true")  # the shuffles behind a written table serve nothing else
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        conf.set(CLEANUP, before)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def forget(*tables: DataFrame) -> None:
    """Delete checkpointed tables that nothing reads any more."""
    for df in tables:
        jvm = df.sparkSession.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(df.written_to)
        path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def slices(batch: pa.RecordBatch, rows: int = 1 << 15) -> Iterator[pa.RecordBatch]:
    """A large batch in pieces, which the JVM takes on one by one."""
    return (batch.slice(at, rows) for at in range(0, max(1, batch.num_rows), rows))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fits(df: DataFrame, rows: int) -> bool:
    """Whether a table has at most ``rows`` rows; reads no more than it must."""
    return df.limit(rows + 1).count() <= rows


def ascii_lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# --------------------------------------------------------------- blocks of text


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    h = h ^ (h >> np.uint64(30))
    h = h * _M1
    h = h ^ (h >> np.uint64(27))
    h = h * _M2
    return h ^ (h >> np.uint64(31))


def text_blocks(texts: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Cut a string array into blocks: (first row, bytes, offsets of its rows). Null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if not len(texts):
        return
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    at, n = 0, len(texts)
    while at < n:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        yield at, data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
        at = end


#: By byte: whether it is part of a word, and A-Z lower-cased.
_INSIDE = np.array([not (b == 32 or 9 <= b <= 13) for b in range(256)])
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], dtype=np.uint8)
_TAIL = np.array([(1 << (8 * k)) - 1 for k in range(9)], dtype=np.uint64)


class Words:
    """The words of a block of texts: bounds, owners and 64-bit hashes of each word."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False) -> None:
        n = len(data)
        self.inside = inside = _INSIDE[data]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        cuts = offsets[:-1][offsets[:-1] < n]
        first[cuts] = inside[cuts]
        last = inside.copy()
        last[:-1] &= ~inside[1:]
        cuts = offsets[1:][offsets[1:] > 0] - 1
        last[cuts] = inside[cuts]
        self.start = np.flatnonzero(first)
        self.end = np.flatnonzero(last) + 1
        self.bounds = np.searchsorted(self.start, offsets)
        self.counts = np.diff(self.bounds)
        # Eight bytes at a time, at any place: a word has few such steps.
        padded = np.concatenate([_LOWER[data] if lower else data, np.zeros(8, np.uint8)])
        eights = np.ndarray((n + 1,), dtype="<u8", buffer=padded, strides=(1,))
        size = self.end - self.start
        self.hash = mix(size.astype(np.uint64) ^ (eights[self.start] & _TAIL[np.minimum(size, 8)]))
        at, which = 8, np.flatnonzero(size > 8)
        while len(which):
            rest = eights[self.start[which] + at] & _TAIL[np.minimum(size[which] - at, 8)]
            self.hash[which] = mix(self.hash[which] * _P ^ rest)
            at += 8
            which = which[size[which] > at]


def windows(words: Words, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words of the block, those that reach from one text into the next included."""
    w = words.hash
    n = max(0, len(w) - size + 1)
    out = np.zeros(n, dtype=np.uint64)
    for k in range(size):
        out = (out ^ w[k : k + n]) * _P + np.uint64(k + 1)
        out ^= out >> np.uint64(29)
    return mix(out)


# ------------------------------------------------------------------ id filters

#: Words of 64 bits in the bit table below: its rows are the bound of what is broadcast (2 MB).
FILTER_WORDS = 1 << 17


def _with_bit(df: DataFrame, id_col: str, ids: DataFrame) -> DataFrame:
    """The rows with ``__hit``: whether their id's bit is set in a bit table of ``ids`` (its only column).

    The table has a fixed size, whatever the number of ids, so it can be broadcast.
    """
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(64 * FILTER_WORDS))
    bit = place(ids[ids.columns[0]])
    bits = ids.groupBy(F.shiftright(bit, 6).alias("__word")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (bit % 64).cast("int"))).alias("__bits"))
    at = place(F.col(f"`{id_col}`").cast("long"))
    met = df.join(F.broadcast(bits), F.shiftright(at, 6) == F.col("__word"), "left")
    return met.withColumn("__hit", F.coalesce(F.call_function("getbit", F.col("__bits"), (at % 64).cast("int")) == 1, F.lit(False))).drop("__word", "__bits")


def likely_in(df: DataFrame, id_col: str, ids: DataFrame) -> DataFrame:
    """Rows whose id is perhaps in ``ids``, so that fewer go into the exact join after this.

    With very many ids it lets all rows pass; it never loses one.
    """
    return _with_bit(df, id_col, ids).filter("__hit").drop("__hit")


def without(df: DataFrame, id_col: str, ids: DataFrame) -> DataFrame:
    """Rows whose id isn't in ``ids`` (null ids stay); only those that may be in it are shuffled."""
    marked = _with_bit(df, id_col, ids)
    gone = ids.select(F.col(ids.columns[0]).alias("__gone")).distinct()
    doubtful = marked.filter("__hit").drop("__hit").join(gone, F.col(f"`{id_col}`").cast("long") == F.col("__gone"), "left_anti")
    return marked.filter(~F.col("__hit")).drop("__hit").unionByName(doubtful)
