"""What the operators share: input columns, durable intermediate tables, text as arrays."""

from __future__ import annotations

import ctypes
import functools
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: the characters between words are U+0020 and U+0009 to U+000D.
WORD = r"[^\x20\x09-\x0D]+"


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, found by exact name, whatever other columns are called.

    Of columns with the same name the first counts.
    """
    at: dict[str, int] = {}
    for i, name in enumerate(df.columns):
        at.setdefault(name, i)
    missing = [n for n in names if n not in at]
    if missing:
        raise ValueError(f"missing columns {missing}; there are {df.columns}")
    numbered = df.toDF(*[f"_c{i}" for i in range(len(df.columns))])
    return numbered.select(*[F.col(f"_c{at[n]}").alias(n) for n in names])


def shared_dir(spark: SparkSession) -> str:
    """A new path in the folder that the driver and all executors share.

    The cluster names it in spark.checkpoint.dir. Only a local session, where driver
    and executors are one process, gets a folder of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="millrace-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/millrace-{uuid.uuid4().hex}"


def durable(df: DataFrame) -> DataFrame:
    """df, written to the shared folder and read again, so that a lost executor costs no rerun."""
    path = shared_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@functools.cache
def _trim() -> Callable[[int], int]:
    """The C library's malloc_trim; nothing where it has none."""
    return getattr(ctypes.CDLL(None), "malloc_trim", lambda _: 0)


def release() -> None:
    """Memory that this process has freed goes back to the system.

    A worker that goes on to other rows, or waits for the next stage, would otherwise keep it
    beside what the executor's JVM takes by then.
    """
    pa.default_memory_pool().release_unused()
    _trim()(0)


def chunks(
    batches: Iterable[pa.RecordBatch], text: str, most_chars: int
) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """The rows of batches in pieces of about most_chars characters; a longer row comes alone.

    Gives each piece with the list of its texts, null as the empty text.
    """
    # What earlier tasks of this worker have freed goes back first: it adds to what is held here.
    release()
    for batch in batches:
        column, texts, start, chars = batch.column(text), [], 0, 0
        # A few texts at a time: the whole batch as Python texts would take as much again.
        for at in range(0, len(column), 500):
            for i, t in enumerate(column.slice(at, 500).to_pylist(), at):
                t = "" if t is None else t
                if i > start and chars + len(t) > most_chars:
                    yield batch.slice(start, i - start), texts
                    texts, start, chars = [], i, 0
                texts.append(t)
                chars += len(t)
        if texts:
            yield batch.slice(start), texts
    column = texts = batch = None
    release()


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All code points of the texts in one array, and where each text starts (and the end)."""
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    starts = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) for t in texts], out=starts[1:])
    return points, starts


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (the multipliers are the fixed values of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def spans_of(inside: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First positions and ends of the runs where inside holds; runs end where a text ends."""
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    cut = starts[(starts > 0) & (starts < len(inside))]
    begin[cut] = inside[cut]
    end = inside.copy()
    end[:-1] &= ~inside[1:]
    end[cut - 1] = inside[cut - 1]
    return np.flatnonzero(begin), np.flatnonzero(end) + 1


def run_hashes(points: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the code points of each run; equal runs hash alike at any place."""
    if not len(first):
        return np.zeros(0, np.uint64)
    length = end - first
    # Each code point is mixed with its place in the run; a run's hash is the sum of these.
    offsets = np.cumsum(length) - length
    place = np.arange(int(length.sum()), dtype=np.int64)
    at = np.repeat(first - offsets, length)
    at += place
    term = points[at].astype(np.uint64)
    del at
    place -= np.repeat(offsets, length)
    place <<= 21
    term += place.view(np.uint64)
    del place
    term = mix(term)
    return mix(np.add.reduceat(term, offsets) + length.astype(np.uint64))


# Unicode has no letters or digits from here on.
LAST_WORD_POINT = 0x32400


@functools.cache
def word_tables() -> tuple[np.ndarray, np.ndarray]:
    """By code point: whether it belongs to a word, and its lower-case form where that is one."""
    points = [chr(i) for i in range(LAST_WORD_POINT)]
    word = np.zeros(0x110000, bool)
    word[:LAST_WORD_POINT] = [c.isalnum() for c in points]
    lower = np.arange(0x110000, dtype=np.uint32)
    for i, c in enumerate(points):
        low = c.lower()
        if low != c and len(low) == 1:
            lower[i] = ord(low)
    return word, lower
