"""Helpers of the corpus operators: reading, folds, text buffers, word hashes."""

from __future__ import annotations

import ctypes
import pickle
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ratefuse.operators.stored import stored

#: White space of the word contracts; anything else is part of a word.
SPACES = b" \t\n\x0b\x0c\r"
WORDS = r"[^\x20\x09-\x0D]+"
#: Bytes of text that one vectorised step works on.
STEP_BYTES = 1 << 20


#: Bytes of a batch that Spark hands to a Python worker, at most (about).
BATCH_BYTES = 4 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded_batches(spark: SparkSession) -> None:
    """Let no batch of this session be larger than ``BATCH_BYTES``: what a task holds besides
    its texts then does not grow with their length."""
    if int(spark.conf.get(_BATCH).rstrip("b")) > BATCH_BYTES:
        spark.conf.set(_BATCH, BATCH_BYTES)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


class Shared:
    """A value of known size for all tasks; its classes travel with it."""

    def __init__(self, spark: SparkSession, value: object) -> None:
        self._bytes = spark.sparkContext.broadcast(cloudpickle.dumps(value))
        self._value = None

    def __getstate__(self) -> dict:
        return {"_bytes": self._bytes, "_value": None}

    @property
    def value(self):
        if self._value is None:
            self._value = pickle.loads(self._bytes.value)
        return self._value


def discard(table: DataFrame) -> None:
    """Delete a stored table that no later step reads."""
    spark = table.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def settle(df: DataFrame, name: str) -> DataFrame:
    """Store a table and let go of the shuffle files behind it.

    Spark deletes them once the driver's JVM has collected the plans that made them. Its
    listeners hold the plan of the last event until another comes, so there has to be another.
    """
    out = stored(df, name)
    df.sparkSession.sql("SELECT 1").collect()
    df.sparkSession._jvm.System.gc()
    return out


def give_back() -> None:
    """Return freed memory to the system; workers live on for later stages."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library keeps its memory
        return


def held_out() -> Column:
    """True for the rows that no label may be learnt from; a null id is not held out."""
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    return F.coalesce(fold == 2, F.lit(False))


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts one after another, and where each text begins and ends."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if data is None or not len(texts):
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[ends[0] : ends[-1]], ends - ends[0]


def steps(texts: pa.Array, limit: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes; a longer text is a range of its own."""
    _, ends = utf8(texts)
    lo = 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + limit, "right")) - 1)
        yield lo, min(hi, len(texts))
        lo = hi


def strings(texts: pa.Array) -> list[str]:
    return [t or "" for t in texts.to_pylist()]


_MULT = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0x2545F4914F6CDD1D  # odd, so that it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)


def mixed(x: np.ndarray) -> np.ndarray:
    """Well spread 64-bit values of 64-bit values, one to one."""
    x = x.astype(np.uint64, copy=True)
    rest = np.empty_like(x)
    for shift, mult in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= np.right_shift(x, np.uint64(shift), out=rest)
        x *= np.uint64(mult)
    x ^= np.right_shift(x, np.uint64(31), out=rest)
    return x


class Powers:
    """Powers of the hash base and of its inverse, as far as they were asked for."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def __reduce__(self) -> tuple:
        return Powers, ()  # workers count their own; what the driver needed stays there

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up), 1 << 16)
            self.up, self.down = (
                np.concatenate(
                    ([np.uint64(1)], np.cumprod(np.full(size - 1, base, np.uint64)))
                )
                for base in (np.uint64(_BASE), np.uint64(_INVERSE))
            )
        return self.up[:n], self.down[:n]


POWERS = Powers()


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Sums by which ``span_hash`` gives the hash of any substring at once."""
    up, _ = POWERS.upto(len(data) + 1)
    out = np.zeros(len(data) + 1, np.uint64)
    part = out[1:]
    np.add(data, np.uint64(1), out=part)
    part *= up[: len(data)]
    np.cumsum(part, out=part)
    return out


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    _, down = POWERS.upto(len(sums))
    return mixed((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


def every_hash(sums: np.ndarray, size: int) -> np.ndarray:
    """``span_hash`` of all substrings of one size, without looking each up."""
    _, down = POWERS.upto(len(sums))
    x = sums[size:] - sums[:-size]
    x *= down[: len(x)]
    x += np.uint64(size)
    return mixed(x)


_SPACE = np.zeros(256, bool)
_SPACE[list(SPACES)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def word_spans(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and the number of words before each text."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~_SPACE[data]
    here, before = inside[1:], inside[:-1]
    cut = np.zeros(len(data) + 1, bool)  # words do not reach over the end of a text
    cut[ends] = True
    start = np.flatnonzero((here & (~before | cut))[:-1])
    end = np.flatnonzero(before & (~here | cut))
    return start, end, np.searchsorted(start, ends)


def shingles(
    texts: pa.Array, width: int, lower: bool = True
) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the word shingles of each text in order, and where each text's begin.

    A text of fewer words gives its whole sequence as one shingle, a text without words none.
    """
    data, ends = utf8(texts)
    if lower:
        data = _LOWER[data]
    start, end, first = word_spans(data, ends)
    word = span_hash(prefix_hash(data), start, end)
    count = np.diff(first)
    out = np.where(count == 0, 0, np.maximum(count - width + 1, 1))
    begin = np.concatenate(([0], np.cumsum(out)))
    at = np.arange(begin[-1]) - np.repeat(begin[:-1] - first[:-1], out)
    length = np.repeat(np.minimum(count, width), out)
    value = length.astype(np.uint64)
    for k in range(width):
        there = k < length
        step = word[np.minimum(at + k, max(len(word) - 1, 0))] if len(word) else value
        value = np.where(there, value * _MULT + step, value)
    return mixed(value), begin


def letters_in(texts: pa.Array) -> np.ndarray:
    found = pc.match_substring_regex(pc.fill_null(texts, ""), r"\p{L}")
    return found.to_numpy(zero_copy_only=False)


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


PYTHON_WORDS = re.compile(r"[^\x20\x09-\x0D]+")
