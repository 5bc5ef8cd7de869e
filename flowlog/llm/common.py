"""Helpers shared by the operators: words, blocks, packed keys and shared tables."""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
import zipfile

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from flowlog.session import checkpoint_dir

SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
BLOCK_BYTES = 4 << 20      # text of one block of documents; the unit of work of a task's memory
SLICE_BYTES = 1 << 20      # text that a Python worker handles at once
OWNER_KEYS = 4_000_000     # packed keys that one owner group gathers, on average

U64 = np.uint64
_SHIPPED = "flowlog-src.zip"
_MIX_A, _MIX_B = U64(0x9E3779B97F4A7C15), U64(0xBF58476D1CE4E5B9)


def mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """64-bit fingerprint of the ordered pair (a, b), element by element."""
    h = a * _MIX_A
    h += b
    h ^= h >> U64(29)
    h *= _MIX_B
    h ^= h >> U64(32)
    return h


def hash_words(words, seed: int = 0) -> np.ndarray:
    digest = xxhash.xxh3_64_intdigest
    return np.fromiter((digest(w, seed) for w in words), dtype=np.uint64, count=len(words))


def as_bytes(column) -> list[bytes]:
    """UTF-8 bytes of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return [b"" if x is None else x for x in pc.cast(column, pa.binary()).to_pylist()]


def release_memory() -> None:
    """Give memory that is no longer used back to the system: a Python worker waits for its next task with all it ever took."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # glibc only
    if trim is not None:
        trim(0)


def text_runs(batches, text_col: str):
    """(part of a batch, its texts as bytes), part by part, so that no copy of a whole batch's texts is held; then memory is released."""
    for batch in batches:
        column = batch.column(text_col)
        lengths = pc.fill_null(pc.binary_length(pc.cast(column, pa.binary())), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths, dtype=np.int64)
        at, part = 0, None
        while at < len(ends):
            to = max(at + 1, int(np.searchsorted(ends, (int(ends[at - 1]) if at else 0) + SLICE_BYTES, side="right")))
            part = batch.slice(at, to - at)
            yield part, as_bytes(part.column(text_col))
            at = to
        del batch, column, part
        release_memory()


def lower_words(text: bytes) -> list[bytes]:
    """A-Z lowered, cut at ASCII white space (0x20, 0x09-0x0D): what bytes methods do."""
    return text.lower().split()


def text_of(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def fold(id_col: str, mod: int) -> Column:
    """crc32 of the id's decimal text, modulo ``mod``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % F.lit(mod)


def count_blocks(docs: DataFrame, text_col: str, block_bytes: int = BLOCK_BYTES) -> tuple[int, int]:
    """(blocks, bytes) of a table of texts, from one pass over the text column."""
    total = docs.agg(F.sum(F.octet_length(F.col(text_col)))).first()[0] or 0
    return max(1, -(-total // block_bytes)), total


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder (spark.checkpoint.dir) and read it back.

    Later jobs read the files, so a lost executor costs no recomputation and
    everything that depends on a nondeterministic order is evaluated once.
    """
    spark = df.sparkSession
    path = os.path.join(checkpoint_dir(spark), "llm", f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(table: DataFrame) -> None:
    """Delete the files of a table of :func:`materialise` that no later job reads."""
    files = table.inputFiles()
    if files:
        folder = table.sparkSession._jvm.org.apache.hadoop.fs.Path(os.path.dirname(files[0]))
        folder.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(folder, True)


def pack_keys(keys: np.ndarray) -> bytes:
    """Sorted 64-bit keys as differences, stored byte plane by byte plane (high planes compress away)."""
    steps = np.diff(keys, prepend=U64(0))
    return steps.view(np.uint8).reshape(-1, 8).T.tobytes()


def unpack_keys(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(blob, np.uint8).reshape(8, -1)
    steps = np.ascontiguousarray(planes.T).view(np.uint64).ravel()
    return np.cumsum(steps, dtype=np.uint64)


def pack_counts(counts: np.ndarray) -> bytes:
    """Counts of any size: the number of bytes that the largest needs, then byte plane by byte plane."""
    size = max(1, (int(counts.max(initial=0)).bit_length() + 7) // 8)
    planes = np.ascontiguousarray(counts, np.uint64).view(np.uint8).reshape(-1, 8).T[:size]
    return bytes([size]) + planes.tobytes()


def unpack_counts(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(blob, np.uint8, offset=1).reshape(blob[0], -1)
    whole = np.zeros((planes.shape[1], 8), np.uint8)
    whole[:, :blob[0]] = planes.T
    return whole.view(np.int64).ravel()


def owner_bits(expected_keys: int, owner_keys: int = OWNER_KEYS) -> int:
    """Leading key bits that name the owner, so that an owner gathers about ``owner_keys`` keys."""
    return min(20, max(6, int(np.ceil(np.log2(max(1, expected_keys / owner_keys))))))


def owner_slices(keys: np.ndarray, bits: int):
    """(owner, from, to) of each owner's run in sorted keys."""
    if not len(keys):
        return
    own = (keys >> U64(64 - bits)).astype(np.int64)
    starts = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
    ends = np.r_[starts[1:], len(keys)]
    yield from zip(own[starts].tolist(), starts.tolist(), ends.tolist())


def ship_package(spark: SparkSession) -> None:
    """Send this package's source to the Python workers, once per Spark context, wherever they were started."""
    context = spark.sparkContext
    if any(x.endswith(_SHIPPED) for x in context._python_includes):
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="flowlog-src-"), _SHIPPED)
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(top):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(top)))
    context.addPyFile(path)


def spark_of(df: DataFrame) -> SparkSession:
    return df.sparkSession
