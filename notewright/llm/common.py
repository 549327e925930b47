"""Helpers shared by the operators: scratch tables, hashing and word splitting."""

from __future__ import annotations

import ctypes
import functools
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

#: Bytes that belong to a word after A-Z are lower-cased: 0-9, a-z and all of non-ASCII.
_WORD_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared scratch folder; a temporary one only on a single machine where none is configured (tests)."""
    found = spark.conf.get(CHECKPOINT_CONF, None)
    if not found:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError(f"{CHECKPOINT_CONF} must name a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.conf.set(CHECKPOINT_CONF, found)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def table(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slices(batches: Iterable[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut small, so that few texts at a time are Python objects."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def keep_freed_memory() -> None:
    """Let this Python worker keep up to 512 MB of freed memory for its next arrays.

    The C library gives large arrays back to the system as they are freed, so each new one faults all its pages in
    again: about half the time of array work.  Does nothing where the library has no such setting.
    """
    mallopt = getattr(ctypes.CDLL(None), "mallopt", None)
    if mallopt:
        mallopt(-1, 512 << 20)  # M_TRIM_THRESHOLD
        mallopt(-3, 32 << 20)  # M_MMAP_THRESHOLD


#: What operators keep in this Python worker for their next task in it, by operator.
_KEPT: dict[str, dict] = {}


def kept(owner: str) -> dict:
    """What ``owner`` keeps in this Python worker.  What other operators kept goes: workers serve one operator after the
    other, and would hold the caches of all beside the executor's memory."""
    for other in [o for o in _KEPT if o != owner]:
        del _KEPT[other]
    return _KEPT.setdefault(owner, {})


def tidy(owner: str) -> Callable:
    """For functions over Arrow batches: begins without what other operators kept, and at the end gives memory back to the system,
    where the library can."""

    def wrap(run):
        @functools.wraps(run)
        def whole(batches):
            kept(owner)
            yield from run(batches)
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim:
                trim(0)

        return whole

    return wrap


def ascii_words(text: str | None) -> list[bytes]:
    """The words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of a text with A-Z lower-cased, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").translate(_WORD_TABLE).split() if text else []


_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_POWERS = {"p": np.ones(1, np.uint64)}


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser over an unsigned array."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS["p"]) < n:
        size = max(n, 2 * len(_POWERS["p"]))
        inverse = pow(int(_MULTIPLIER), -1, 1 << 64)
        with np.errstate(over="ignore"):
            p = np.full(size, _MULTIPLIER, np.uint64)
            q = np.full(size, inverse, np.uint64)
            p[0] = q[0] = 1
            _POWERS["p"], _POWERS["q"] = np.cumprod(p), np.cumprod(q)
    return _POWERS["p"], _POWERS["q"]


def shingle_sets(texts: list[str | None], width: int = 5) -> list[np.ndarray]:
    """The sorted distinct 64-bit hashes of each text's ``width``-word shingles.

    A text of fewer words, but not none, has one shingle: all its words.
    A null text, or one with no words, has an empty set.
    """
    return list(_shingles(texts, width))


def _shingles(texts, width):
    group, size = [], 0
    for t in texts:
        raw = t.encode("utf-8", "surrogatepass") if t else b""
        group.append(raw)
        size += len(raw) + 1
        if size > 300_000:
            yield from _shingle_group(group, width)
            group, size = [], 0
    if group:
        yield from _shingle_group(group, width)


def _shingle_group(raws: list[bytes], width: int):
    joined = b" ".join(raws).translate(_WORD_TABLE) + b" "
    buf = np.frombuffer(joined, np.uint8)
    edges = np.flatnonzero(np.diff(np.concatenate(([0], (buf != 32).view(np.int8)))))
    starts, ends = edges[0::2], edges[1::2]
    bounds = np.cumsum([len(r) + 1 for r in raws])
    doc = np.searchsorted(bounds, starts, side="right")
    with np.errstate(over="ignore"):
        p, q = _powers(len(buf) + 1)
        prefix = np.zeros(len(buf) + 1, np.uint64)
        np.cumsum(mix64(buf.astype(np.uint64) + np.uint64(1)) * p[: len(buf)], out=prefix[1:])
        words = mix64((prefix[ends] - prefix[starts]) * q[starts] + (ends - starts).astype(np.uint64))
        n = len(words)
        first = np.searchsorted(doc, np.arange(len(raws)), side="left")
        last = np.searchsorted(doc, np.arange(len(raws)), side="right")
        grams = np.zeros(max(n - width + 1, 0), np.uint64)
        for j in range(width):
            grams = mix64(grams * _MULTIPLIER + words[j : j + len(grams)])
        for a, b in zip(first, last):
            if b - a >= width:
                yield np.unique(grams[a : b - width + 1])
            elif b > a:
                one = np.zeros(1, np.uint64)
                for j in range(a, b):
                    one = mix64(one * _MULTIPLIER + words[j : j + 1])
                yield mix64(one + np.uint64(b - a))
            else:
                yield np.zeros(0, np.uint64)
