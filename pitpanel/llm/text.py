"""Words and hashes of whole Arrow text columns with NumPy, and helpers for stored intermediate tables.

The functions work on slices of a column (about ``SLICE`` bytes, or one longer text), so a task's memory follows
the longest text, never the number of rows.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

SLICE = 1 << 20
U64 = np.uint64
_BASE = U64(0x9E3779B97F4A7C15 | 1)
_BASE_INV = U64(pow(int(_BASE), -1, 1 << 64))
_GRAM = U64(0xD6E8FEB86659FD93)

WHITE = bytes([0x20, *range(0x09, 0x0E)])


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    h = h ^ (h >> U64(33))
    h = h * U64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> U64(33))
    h = h * U64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> U64(33))


_BYTES = mix(np.arange(1, 257, dtype=U64) * U64(0xA0761D6478BD642F))
_LOWER = np.arange(256)
_LOWER[65:91] += 32
_POWERS = [np.ones(1, U64), np.ones(1, U64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        n = max(n, SLICE + 1)
        for k, base in enumerate((_BASE, _BASE_INV)):
            steps = np.full(n, base, U64)
            steps[0] = 1
            _POWERS[k] = np.cumprod(steps, dtype=U64)
    return _POWERS[0], _POWERS[1]


def white_space_words() -> np.ndarray:
    """Byte table of words ``[^\\x20\\x09-\\x0D]+``."""
    table = np.ones(256, bool)
    table[list(WHITE)] = False
    return table


def alphanumeric_words() -> np.ndarray:
    """Byte table of words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of a text whose A-Z are lower-cased."""
    table = np.zeros(256, bool)
    table[0x30:0x3A] = table[0x41:0x5B] = table[0x61:0x7B] = table[0x80:] = True
    return table


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offs[0] : offs[-1]], offs - offs[0]


def slices(offs: np.ndarray, most: int = SLICE) -> Iterator[tuple[int, int]]:
    """Ranges of rows with at most ``most`` bytes, or one row."""
    i, n = 0, len(offs) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + most, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


class Words:
    """The words of rows i..j of a text column: byte spans, row of each word, 64-bit hash of each word."""

    def __init__(self, data: np.ndarray, offs: np.ndarray, i: int, j: int, table: np.ndarray, lower: bool):
        self.offs = offs[i : j + 1] - offs[i]
        self.data = data = data[offs[i] : offs[j]]
        self.rows = j - i
        inside = table[data]
        if not len(data):
            self.starts = self.ends = self.row = np.zeros(0, np.int64)
            self.hash = np.zeros(0, U64)
        else:
            first, last = inside.copy(), inside.copy()
            first[1:] &= ~inside[:-1]
            last[:-1] &= ~inside[1:]
            edges = self.offs[(self.offs > 0) & (self.offs < len(data))]
            first[edges] = inside[edges]
            last[edges - 1] = inside[edges - 1]
            self.starts, self.ends = np.flatnonzero(first), np.flatnonzero(last) + 1
            self.row = np.searchsorted(self.offs, self.starts, "right") - 1
            power, inverse = _powers(len(data) + 1)
            total = np.zeros(len(data) + 1, U64)
            values = _BYTES[_LOWER] if lower else _BYTES
            np.cumsum(values[data] * power[: len(data)], out=total[1:])
            self.hash = mix((total[self.ends] - total[self.starts]) * inverse[self.starts] + (self.ends - self.starts).astype(U64))
        self.per_row = np.bincount(self.row, minlength=self.rows)
        self.first = np.concatenate([[0], np.cumsum(self.per_row)])  # first word of each row, and the end

    def words(self, row: int) -> list[bytes]:
        raw = self.data.tobytes()
        return [raw[a:b] for a, b in zip(self.starts[self.first[row] : self.first[row + 1]], self.ends[self.first[row] : self.first[row + 1]], strict=True)]


def grams(h: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of every k consecutive numbers."""
    if len(h) < k:
        return np.zeros(0, U64)
    out, size, power, rest, base, done = None, 1, h, k, _GRAM, 0
    while rest:  # lengths 1, 2, 4 ... of which k is the sum
        if rest & 1:
            piece = power[done : done + len(h) - k + 1]
            out = piece.copy() if out is None else out * base + piece
            done += size
        rest >>= 1
        if rest:
            power = power[:-size] * base + power[size:]
            base, size = U64(int(base) ** 2 % (1 << 64)), size * 2
    return mix(out)


def sliding_min(values: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Smallest of every ``width`` consecutive numbers and its (first) place."""
    low, at, have = values, np.arange(len(values)), 1
    while have < width and len(low):
        step = min(have, width - have)
        left, right = low[:-step], low[step:]
        first = left <= right
        low, at = np.where(first, left, right), np.where(first, at[:-step], at[step:])
        have += step
    return low, at


#: What operators keep in a Python worker from task to task.
_KEPT: list[dict] = []


def worker_cache() -> dict:
    """A dictionary for what an operator keeps in a worker from task to task, until a task of an ``alone`` step comes."""
    _KEPT.append({})
    return _KEPT[-1]


def forget() -> None:
    """Drops what operators have kept in this worker, and gives Arrow's unused memory back."""
    if any(_KEPT):
        for cache in _KEPT:
            cache.clear()
        pa.default_memory_pool().release_unused()


def alone(step: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """``step`` of mapInArrow without the caches of others: workers live on from stage to stage, and would hold them on top."""

    def run(batches):
        forget()
        yield from step(batches)

    return run


def stored(df: DataFrame, name: str) -> DataFrame:
    """The same rows from a Parquet table in the shared folder: lineage ends there, and losing an executor loses nothing."""
    folder = fresh_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``; a local one only where it is unset and the master is local."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = context.getCheckpointDir() or f"file://{tempfile.mkdtemp(prefix='pitpanel-checkpoint-')}"
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the Python workers, unless their path has it (PYTHONPATH, or the folder a local master runs in)."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    _SHIPPED.add(context.applicationId)
    package = Path(__file__).resolve().parent.parent
    known = [Path(p).resolve() for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    if context.master.startswith("local") and not context.master.startswith("local-cluster"):
        known.append(Path.cwd())
    if package.parent in known:
        return
    archive = Path(tempfile.mkdtemp(prefix="pitpanel-")) / f"{package.name}.zip"  # Spark fetches it from the driver
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))


def fresh_folder(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex}"


def file_system(uri: str):
    """File system and path of a URI; paths without a scheme are local."""
    from pyarrow import fs

    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri("file://" + uri[5:] if uri.startswith("file:/") and not uri.startswith("file://") else uri)
